"""Sum-of-squares online packing of token sequences into windows of one size.

Each task packs the documents of its own input split, so no row is shuffled. A document's ids
fill whole windows first; what is left goes, as one piece, to the fill level whose choice makes
the sum of squared counts of partially filled windows least. The counts per level stand in an
array. When a task ends, its partially filled windows are emptied in order of falling level
into full ones, cutting pieces where a window ends, so that at most one window per task is
padded.

Nulls: a null text is empty (its only id is the end id); a null doc_id is carried through.
Repeated rows are packed as often as they occur. An empty table gives no rows. Columns other
than the two named are not read. Memory per task: one batch of texts and the open windows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import RowWriter
from .tokens import encoder

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
#: Sequence numbers of one task; its partition number stands above them.
TASK_BITS = 40


class SumOfSquares:
    """Windows of `capacity`; put() returns the windows that it filled."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The fill level to add a piece of `size` to; 0 opens a window.

        Moving a window from level h to h + size changes the sum of squares by
        2 (n[h + size] - n[h] + 1); a full window is no longer counted, so that filling one
        changes it by 1 - 2 n[h], and opening one by 2 n[size] + 1. Ties: the fullest level.
        """
        counts, top = self.counts, self.capacity - size
        level, cost = 0, 2 * int(counts[size]) + 1
        if top:
            used = np.flatnonzero(counts[1 : top + 1]) + 1
            if used.size:
                change = 2 * (counts[used + size] - counts[used] + 1)
                if used[-1] == top:
                    change[-1] = 1 - 2 * counts[top]
                last = used.size - 1 - int(np.argmin(change[::-1]))
                if change[last] <= cost:
                    level = int(used[last])
        return level

    def put(self, piece, size: int) -> list | None:
        """Places a piece shorter than the capacity; the pieces of a window that is now full."""
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.counts[level + size] += 1
        self.open[level + size].append(window)
        return None

    def rest(self):
        """Pieces of the partially filled windows, fullest window first."""
        for level in sorted(self.open, reverse=True):
            for window in self.open[level]:
                yield from window


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, with a checksum.

    sequence_id is unique over the run; offset is the piece's place in the sequence, gapless
    from 0; doc_tokens counts all ids of the document with the end id.
    """
    schema = pa.schema([pa.field(n.split()[0], pa.int64()) for n in SCHEMA.split(", ")])
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encode = encoder(tokenizer).encode
        packing, out = SumOfSquares(capacity), RowWriter(schema)
        sequence = TaskContext.get().partitionId() << TASK_BITS

        def emit(pieces):
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                length = len(ids) // 4
                out.add(doc, start, length, zlib.crc32(ids), total, sequence, offset)
                offset += length
            sequence += 1

        for batch in batches:
            for doc, string in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(string.as_py()) + end
                total, start = len(ids) // 4, 0
                while total - start >= capacity:
                    emit([(doc, start, ids[4 * start : 4 * (start + capacity)], total)])
                    start += capacity
                if start < total:
                    full = packing.put((doc, start, ids[4 * start :], total), total - start)
                    if full:
                        emit(full)
                if out.full():
                    yield out.take()
        window, filled = [], 0
        for doc, start, ids, total in packing.rest():
            while ids:
                part = ids[: 4 * (capacity - filled)]
                window.append((doc, start, part, total))
                start, filled, ids = start + len(part) // 4, filled + len(part) // 4, ids[len(part) :]
                if filled == capacity:
                    emit(window)
                    window, filled = [], 0
                    if out.full():
                        yield out.take()
        if window:
            emit(window)
        yield out.take()

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, SCHEMA)
