"""Runs of repeated words, found with string synchronising sets at dyadic scales.

A run is a stretch of words with smallest period q, at least `exponent` times q long, that no
neighbouring word extends. A text is searched scale by scale, w = 4, 8, 16, ... words:

- Each window of w words has a 64-bit hash, built from the two halves' hashes. Windows that have
  a period of at most w / 4 are left out; they are just those inside runs found before.
- A position belongs to the synchronising set if, of the w + 1 windows that start there and
  after, the first or the last has the least hash. Membership follows from the next 2 w words
  alone, so equal passages are cut at equal places.
- Equal contexts of 2 w words at consecutive members, q words apart with w <= q < 2 w, propose
  the period q, which is checked word by word and extended both ways.

Why no run is lost: in a run with smallest period q, w <= q < 2 w, the windows at 2 w neighbouring
positions can't all have a period of w / 4 or less, or the run had a smaller period itself. So of
each w positions one is a member, and one period on is another with the same context; a run of 4 q
words holds both, and no equal context lies between them. The sets leave out regions of small
period, which is why periods of 1 to 3 words are found apart, by comparing words at that distance.
A hash is only ever a proposal: equal texts have equal hashes, and unequal ones fail the check.

Work per word is the square of the logarithm of the longest text; long texts alone are searched at
long scales. A text lies whole in one task's memory (some 100 bytes a word); texts are joined
in groups of about GROUP_WORDS words to spare calls. No row is shuffled.

Nulls: a null text has no words and no runs, its collapsed text is empty. Repeated rows and null
ids give a row each. An empty table gives no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

LEAST_LENGTH, EXPONENT = 6, 4
#: Periods below this are found by comparing words directly; the first scale.
FIRST_SCALE = 4
GROUP_WORDS = 100_000
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_NONE = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _doubled(windows: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows of twice the width."""
    return _mixed(windows[:-width] * np.uint64(0x9E3779B97F4A7C15) + _mixed(windows[width:]))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` (a power of two) neighbouring values."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _synchronising_set(windows: np.ndarray, width: int, periodic: np.ndarray) -> np.ndarray:
    """Positions whose first or last window has the least hash of width + 1 windows."""
    kept = np.where(periodic, _NONE, windows)
    if len(kept) <= width:
        return np.empty(0, np.int64)
    first, last = kept[:-width], kept[width:]
    least = np.minimum(_least(kept, width)[: len(last)], last)
    return np.flatnonzero((least != _NONE) & ((first == least) | (last == least)))


def _same_from(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from `at` on (step 1) or back (step -1) equal the one a period later."""
    total, chunk, limit = 0, 32, len(words) - period - at if step > 0 else at + 1
    while total < limit:
        n = min(chunk, limit - total)
        low = at + total if step > 0 else at - total - n + 1
        differ = words[low : low + n] != words[low + period : low + period + n]
        if differ.any():
            return total + int((differ if step > 0 else differ[::-1]).argmax())
        total, chunk = total + n, chunk * 4
    return total


class _Found:
    """Runs as start, end and period; of one stretch the smallest period, which comes first."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        if end - start >= EXPONENT * period:
            self.period.setdefault((start, end), period)

    def windows_inside(self, width: int, positions: int) -> np.ndarray:
        """Whether a window of that width has a period of at most a quarter of it."""
        rows = [(a, b) for (a, b), p in self.period.items() if EXPONENT * p <= width <= b - a and a < positions]
        edges = np.zeros(positions + 1, np.int64)
        if rows:
            a, b = np.array(rows).T
            np.add.at(edges, a, 1)
            np.add.at(edges, np.minimum(b - width + 1, positions), -1)
        return np.cumsum(edges[:-1]) > 0


def _direct(words: np.ndarray, period: int, found: _Found) -> None:
    """Runs of one small period: stretches of words that equal the one a period later."""
    same = np.zeros(max(0, len(words) - period) + 2, np.int8)
    same[1:-1] = words[: len(words) - period] == words[period:] if len(words) > period else 0
    edges = np.diff(same)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= (EXPONENT - 1) * period
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        found.add(start, end + period, period)


def _proposed(contexts: np.ndarray, members: np.ndarray, scale: int) -> np.ndarray:
    """(period, position) from consecutive members with equal contexts, in ascending order."""
    order = np.argsort(contexts, kind="stable")
    here, following = members[order[:-1]], members[order[1:]]
    distance = following - here
    equal = contexts[order[:-1]] == contexts[order[1:]]
    near = equal & (distance >= scale) & (distance < 2 * scale)
    pairs = np.stack([distance[near], here[near]], axis=1)
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of every run of 4 periods or more in each sequence of numbers.

    The numbers must be 0 or more; runs are in order of start, then period.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    # a separator that occurs once stands behind each text, so that no run spans two
    parts = [np.append(np.asarray(texts[i], np.int64), -1 - k) for k, i in enumerate(order)]
    words = np.concatenate(parts) if parts else np.empty(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    found = _Found()
    for period in range(1, FIRST_SCALE):
        _direct(words, period, found)
    scale, windows = 1, _mixed(words.view(np.uint64))
    while lengths.size and EXPONENT * scale <= lengths[0]:
        if scale >= FIRST_SCALE:
            # texts shorter than four periods of this scale lie behind the others
            words = words[: starts[np.count_nonzero(lengths >= EXPONENT * scale)]]
            windows = windows[: len(words) - scale + 1]
            members = _synchronising_set(windows, scale, found.windows_inside(scale, len(windows)))
        contexts = _doubled(windows, scale)
        if scale >= FIRST_SCALE and members.size:
            last = (0, 0, 0)
            for period, at in _proposed(contexts[members], members, scale).tolist():
                if last[0] == period and last[1] <= at and at + period < last[2]:
                    continue
                ahead = _same_from(words, at, period, 1)
                if ahead < 2 * scale:
                    continue
                start = at - _same_from(words, at - 1, period, -1)
                last = (period, start, at + ahead + period)
                found.add(start, last[2], period)
        scale, windows = 2 * scale, contexts
    out: list[list] = [[] for _ in texts]
    for (start, end), period in sorted(found.period.items()):
        k = int(np.searchsorted(starts, start, "right")) - 1
        out[order[k]].append((start - int(starts[k]), end - start, period))
    return out


def detect(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    exponent: int = EXPONENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs (in order of start, then period) and collapsed, per row.

    collapsed is the text's words joined by one space without those that a run repeats: all of
    a run's words after its first period.
    """
    if exponent < EXPONENT:
        raise ValueError(f"an exponent of at least {EXPONENT} is needed")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
    )
    split = re.compile(WORD).findall

    def finish(ids, texts):
        number = defaultdict(count().__next__)
        found = runs_of([np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts])
        runs, collapsed = [], []
        for words, rows in zip(texts, found):
            rows = [r for r in rows if r[1] >= max(least_length, exponent * r[2])]
            if rows:
                kept = np.ones(len(words), bool)
                for start, length, period in rows:
                    kept[start + period : start + length] = False
                words = [words[i] for i in np.flatnonzero(kept).tolist()]
            runs.append([dict(zip(("start", "length", "period"), r)) for r in rows])
            collapsed.append(" ".join(words))
        columns = [ids, [len(t) for t in texts], runs, collapsed]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, string in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = split(string.as_py() or "")
                ids.append(doc)
                texts.append(words)
                size += len(words)
                if size >= GROUP_WORDS:
                    yield finish(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield finish(ids, texts)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where about a tenth of the texts end in a run.

    For h = crc32(doc_id as text), h % 10 = 0, every word i >= a becomes the word a + (i - a) % p
    of the same text; a and p follow from h and the number of words. A null id leaves the text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "text", h.alias("h"))
    chosen = F.col("h") % 10 == 0
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    sized = marked.select("*", words.alias("words")).withColumn("n", F.size("words").cast("long"))
    g = F.floor(F.col("h") / 10)
    cut = sized.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    period = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + g % 8))
    placed = cut.withColumn("p", F.when(F.col("n") > 0, period))

    def source(i: Column) -> Column:
        a, p = F.col("a"), F.col("p")
        return F.when(i < a, i).otherwise(a + (i - a) % p)

    planted = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
        lambda i: F.get("words", source(i).cast("int")),
    )
    text = F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per row the number of runs, the longest run (ties: smallest start, then period) and checksums."""
    # ordered so that the greatest is the longest, then first, then of smallest period
    ranked = F.transform(
        "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    )
    best = found.withColumn("best", F.array_max(ranked))
    lines = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    length, period = F.col("best.length"), -F.col("best.p")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
