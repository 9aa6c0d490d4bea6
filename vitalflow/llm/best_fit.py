"""Best-fit decreasing packing of token sequences into windows of one size.

Documents are tokenised by one task each and cut only where they are longer than a window. Then the
pieces of the whole table are packed together, the longest first, each into the open window with
the least room that still holds it.

Pieces of one length are alike to this rule. So Spark counts the pieces of each length, at most
`capacity` numbers, and the windows are planned from these counts: a segment tree over the
remaining capacities holds how many windows are open at each, and finds the tightest that fits in
logarithmic time. Windows that have had the same pieces are numbered in a row and move as one
interval; a length splits at most two and opens at most two, so the plan is bounded by the capacity
whatever the number of documents, and is what packing one document after the other gives. Pieces
are then numbered within their length by ranges (ordering.positions) and look their window up in
the plan. No task or driver holds more than a batch of pieces and the plan.

Nulls: a null text is empty (its only id is the end id); a null doc_id is carried through. Repeated
rows are packed as often as they occur. An empty table gives no rows. Columns other than the two
named are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RowWriter, materialise
from .ordering import positions
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
#: A piece's length stands above its position within that length in one 64-bit key.
_POSITION_BITS = 44


def _fields(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([pa.field(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


class OpenWindows:
    """A segment tree over remaining capacities 0 to `capacity`, counting open windows."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.width)

    def add(self, room: int, windows: int) -> None:
        node = self.width + room
        while node:
            self.tree[node] += windows
            node //= 2

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of at least `size` that has an open window."""
        node = self.width + size
        if self.tree[node]:
            return size
        # up to the first ancestor with windows in the subtree to the right, then down its left edge
        while node > 1 and (node & 1 or not self.tree[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.width:
            node *= 2
            node += not self.tree[node]
        return node - self.width


def plan(counts: Iterable[tuple[int, int]], capacity: int) -> np.ndarray:
    """Where the pieces of each length go, from how many there are of each.

    Rows (length, first, each, window, offset), in order of the first two: the pieces of that
    length from number `first` on go `each` to a window, to windows from number `window` on, from
    `offset` on within them.
    """
    tree, open_at, moves, windows = OpenWindows(capacity), defaultdict(list), [], 0

    def keep(room: int, first: int, number: int) -> None:
        if room and number:
            open_at[room].append((first, number))
            tree.add(room, number)

    for size, left in sorted(counts, reverse=True):
        done = 0
        while left:
            room = tree.tightest(size)
            if room is None:
                room = capacity
                first, number = windows, -(-left // (room // size))
                windows += number
            else:
                first, number = open_at[room].pop()
                tree.add(room, -number)
            # what is left in a window after a piece is tighter than any other that holds one more
            each = room // size
            full, rest = min(number, left // each), 0
            if full < number:
                rest = left - full * each
            moves.append((size, done, each, first, capacity - room))
            keep(room - each * size, first, full)
            if rest:
                keep(room - rest * size, first + full, 1)
            unused = number - full - (rest > 0)
            keep(room, first + number - unused, unused)
            done, left = done + full * each + rest, left - full * each - rest
    return np.array(sorted(moves), np.int64).reshape(-1, 5)


def tokenise(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of each document, with the checksum of their ids."""
    schema = _fields(PIECES)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encode, out = encoder(tokenizer).encode, RowWriter(schema)
        for batch in batches:
            for doc, string in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(string.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.add(doc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                if out.full():
                    yield out.take()
        yield out.take()

    return docs.mapInArrow(run, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, with a checksum.

    sequence_id counts the sequences from 0; offset is the piece's place there, gapless from 0.
    """
    chosen = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    pieces = materialise(tokenise(chosen, tokenizer, capacity, end_id), "pieces")
    counts = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    moves = plan([tuple(r) for r in counts], capacity)
    keys = (moves[:, 0] << _POSITION_BITS) + moves[:, 1]
    schema = _fields(PLACED)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, at = (batch.column(i).to_numpy() for i in (3, 5))
            move = moves[np.searchsorted(keys, (length << _POSITION_BITS) + at, "right") - 1]
            window, nth = np.divmod(at - move[:, 1], move[:, 2])
            found = [pa.array(move[:, 3] + window), pa.array(move[:, 4] + nth * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], schema=schema)

    order = ["doc_id", "piece", "ids_crc32"]
    numbered = positions(pieces, "length", order, "at", "size", "pieces-order")
    return numbered.select(*[F.col(c.split()[0]) for c in PIECES.split(", ")], "at").mapInArrow(place, PLACED)
