"""SimHash near-duplicates: a self-join of the fingerprints in a binary trie.

A fingerprint has 64 bits. Two fingerprints are linked at `budget` or fewer differing bits; the
result is the component of each document, so equal fingerprints are one node from the start and
copies are never paired.

The trie's bits are cut into budget + 1 runs. Linked fingerprints agree on one run at least, so
for each run a trie that starts with it finds, below each of its nodes of that depth, all links
that agree on the run. That is the unit of work: a node pair (one node with itself at first) and
the budget left to it. In a task, node pairs are walked together: both nodes are split at the
next bit, the pair of unequal children costs one of the budget and is dropped when nothing is
left; pairs of single fingerprints are compared at once. The walk holds its frontier in arrays,
in chunks of bounded size, deepest first. Found links go into a union-find and only a spanning
forest leaves the task, fewer rows than fingerprints.

A unit with more than `most` fingerprints is not given to a task: it is walked down by SPLIT
bits for all its fingerprints as a DataFrame step, which makes smaller units, until none is
left above or the bits are used up (at most 2 ** 0 = 1 fingerprint a node then). Nothing is
capped.

Nulls: a null text has no words and the fingerprint zero, as has an empty one. A null doc_id is
carried; it is never the name of a component unless the component has no other. Repeated rows
are kept. An empty table gives no rows. Other columns are kept aside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise
from .components import components

BUDGET, SHINGLE, SEED = 2, 3, 42
#: Fingerprints of a unit of work that one task takes.
UNIT = 8_192
SPLIT = 4
FRONTIER = 200_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a whole text; shingles count as often as they occur."""
    from xxhash import xxh64_intdigest

    words = re.findall(WORD, (text or "").translate(_LOWER))
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxh64_intdigest(s, seed) for s in shingles], ">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash (of the text's bytes, to tell rows apart), fp (signed 64 bits)."""
    schema = "doc_id long, text_hash long, fp long"

    def run(batches):
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text")
    ).mapInArrow(run, schema)


def _runs(budget: int) -> list[int]:
    """Where each run of bits starts; the last number is 64."""
    return [64 * i // (budget + 1) for i in range(budget + 2)]


def _rotate(fp: np.ndarray, by: int) -> np.ndarray:
    return fp if by == 0 else (fp << np.uint64(by)) | (fp >> np.uint64(64 - by))


class _Forest:
    """Union-find over positions; join() takes arrays of links and keeps those that connect."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label, kept = self.label, []
        for k in np.flatnonzero(label[i] != label[j]).tolist():
            x, y = i[k], j[k]
            while label[x] != x:
                x = label[x]
            while label[y] != y:
                y = label[y]
            if x != y:
                label[max(x, y)] = min(x, y)
                kept.append(k)
        if kept:
            while (label != (up := label[label])).any():
                label = up
            self.label = label
        return i[kept], j[kept]


def walk(keys: np.ndarray, units: list[tuple[int, int, int, int, int, int]], budget: int = BUDGET):
    """Links among sorted unsigned keys: yields arrays (i, j) of positions.

    units: (a_low, a_high, b_low, b_high, depth, budget): position ranges of two nodes at depth,
    equal for a node with itself.
    """
    stack = [np.array(units, np.int64).reshape(-1, 6)] if units else []
    while stack:
        now = stack.pop()
        if len(now) > FRONTIER:
            stack += [now[FRONTIER:]]
            now = now[:FRONTIER]
        a0, a1, b0, b1, depth, left = now.T
        same = a0 == b0
        single = (a1 - a0 == 1) & (b1 - b0 == 1) & ~same
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if near.any():
                yield i[near], j[near]
        go = ~single & (depth < 64) & ~(same & (a1 - a0 < 2))
        if not go.any():
            continue
        a0, a1, b0, b1, depth, left, same = (x[go] for x in (a0, a1, b0, b1, depth, left, same))
        am = _split(keys, a0, a1, depth)
        bm = np.where(same, am, _split(keys, b0, b1, depth))
        made = [
            (a0, am, b0, bm, left, same | True),
            (am, a1, bm, b1, left, same | True),
            (a0, am, bm, b1, left - 1, same | True),
            (am, a1, b0, bm, left - 1, ~same),  # the mirror image in a node's pair with itself
        ]
        parts = []
        for x0, x1, y0, y1, over, wanted in made:
            keep = wanted & (x1 > x0) & (y1 > y0) & (over >= 0)
            parts.append(np.stack([x0, x1, y0, y1, depth + 1, over], 1)[keep])
        stack.append(np.concatenate(parts))


def _split(keys: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the keys of each node (a range of positions) get a one at bit `depth`."""
    shift = (63 - depth).astype(np.uint64)
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():  # all nodes are searched together
        middle = (low + high) // 2
        probe = np.minimum(middle, len(keys) - 1)
        one = (keys[probe] >> shift) & np.uint64(1) == 1
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)
    return low


UNIT_COLUMNS = ("run", "depth", "first", "second")


def _forests(budget: int):
    """Walks every unit of a partition whose rows are sorted by unit; yields its forest."""
    starts = _runs(budget)

    def forest(run, depth, left, side, fp):
        keys = _rotate(fp.view(np.uint64), starts[run])
        order = np.lexsort((keys, side))
        keys, fp, n = keys[order], fp[order], len(fp)
        cut = n - int(side.sum())
        if cut == 0 or n < 2:
            return
        node = (0, n, 0, n) if cut == n else (0, cut, cut, n)
        trees, found = _Forest(n), []
        for i, j in walk(keys, [(*node, depth, left)], budget):
            i, j = trees.join(i, j)
            if len(i):
                found.append((fp[i], fp[j]))
        if found:
            i, j = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)], ["a", "b"])

    def units(held, last):
        """Whole units at the front of the held rows; the last one only at the end."""
        change = np.zeros(max(len(held["fp"]) - 1, 0), bool)
        for name in UNIT_COLUMNS:
            change |= held[name][1:] != held[name][:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist()]
        if last:
            edges.append(len(held["fp"]))
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                one = {n: x[a:b] for n, x in held.items()}
                yield from forest(int(one["run"][0]), int(one["depth"][0]), int(one["left"][0]), one["side"], one["fp"])
        if not last:
            held.update({n: x[edges[-1] :] for n, x in held.items()})

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            parts.append({n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(batch.schema.names)})
            size += batch.num_rows
            if size >= UNIT:
                held = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
                yield from units(held, last=False)
                parts, size = [held], 0
        if parts:
            yield from units({n: np.concatenate([p[n] for p in parts]) for n in parts[0]}, last=True)

    return run


def _shift_right(column, by):
    return F.call_function("shiftrightunsigned", column, by if not isinstance(by, int) else F.lit(by))


def _first_units(prints: DataFrame, budget: int) -> DataFrame:
    """Each fingerprint below the node of its run's value, in the trie of each run."""
    starts, runs = _runs(budget), []
    for run, (begin, end) in enumerate(zip(starts, starts[1:])):
        node = _shift_right(F.col("fp"), 64 - end).bitwiseAND(F.lit((1 << (end - begin)) - 1))
        runs.append(
            F.struct(
                F.lit(run).alias("run"),
                F.lit(end - begin).alias("depth"),
                node.cast("long").alias("first"),
                node.cast("long").alias("second"),
                F.lit(budget).alias("left"),
                F.lit(0).alias("side"),
            )
        )
    return prints.select("fp", F.explode(F.array(*runs)).alias("u")).select("fp", "u.*")


def _split_units(rows: DataFrame, budget: int) -> DataFrame:
    """The same walk, SPLIT bits down, for all fingerprints of the given units."""
    begin = F.element_at(F.array(*map(F.lit, _runs(budget)[:-1])), F.col("run") + 1)
    # the key is the fingerprint rotated left, so that its run comes first
    key = F.call_function("shiftleft", F.col("fp"), begin).bitwiseOR(
        F.when(begin > 0, _shift_right(F.col("fp"), 64 - begin)).otherwise(F.lit(0).cast("long"))
    )
    own = _shift_right(key, 64 - SPLIT - F.col("depth")).bitwiseAND(F.lit((1 << SPLIT) - 1))
    masks = F.array(*[F.lit(m) for m in range(1 << SPLIT) if m.bit_count() <= budget])
    crossed = (
        rows.select("*", own.alias("own"), F.explode(masks).alias("mask"))
        .withColumn("left", F.col("left") - F.bit_count("mask"))
        .filter("left >= 0")
    )
    other = F.col("own").bitwiseXOR(F.col("mask"))
    itself = F.col("first") == F.col("second")
    side = F.when(itself, (other < F.col("own")).cast("int")).otherwise(F.col("side"))
    low = F.when(side == 0, F.col("own")).otherwise(other)
    high = F.when(side == 0, other).otherwise(F.col("own"))

    def down(node, bits):
        return F.call_function("shiftleft", F.col(node), F.lit(SPLIT)).bitwiseOR(bits.cast("long"))

    return crossed.select(
        "fp",
        "run",
        (F.col("depth") + SPLIT).alias("depth"),
        down("first", low).alias("first"),
        down("second", high).alias("second"),
        "left",
        side.alias("side"),
    )


def links(prints: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """prints: fp, distinct. Edges a, b: of each unit of work a spanning forest of its links."""
    spark = prints.sparkSession
    rows, ready = _first_units(prints, budget), []
    while True:
        sizes = rows.groupBy(*UNIT_COLUMNS).agg(
            F.count(F.lit(1)).alias("n"), F.sum("side").alias("seconds")
        )
        # a node with itself needs two rows, a pair of nodes rows of either
        useful = sizes.filter(
            F.when(F.col("first") == F.col("second"), F.col("n") > 1).otherwise(
                (F.col("seconds") > 0) & (F.col("seconds") < F.col("n"))
            )
        )
        large = materialise(useful.filter((F.col("n") > unit) & (F.col("depth") + SPLIT <= 64)), "units")
        if not large.take(1):
            ready.append(rows)
            break
        kept = rows.join(useful.select(*UNIT_COLUMNS, "n"), list(UNIT_COLUMNS))
        ready.append(kept.filter((F.col("n") <= unit) | (F.col("depth") + SPLIT > 64)).drop("n"))
        rows = materialise(
            _split_units(rows.join(large.select(*UNIT_COLUMNS), list(UNIT_COLUMNS), "left_semi"), budget), "units"
        )
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    order = ["run", "depth", "first", "second", "left", "side", "fp"]
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = every.select(*order).repartition(parallel, *UNIT_COLUMNS).sortWithinPartitions(*UNIT_COLUMNS)
    return dealt.mapInArrow(_forests(budget), "a long, b long")


def near_duplicates(prints: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """prints of with_fingerprints(), stored. Adds root (a fingerprint) and component_id."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(nodes.select("fp"), budget, unit))
    rooted = materialise(
        nodes.join(found, nodes["fp"] == found["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    # grouped by fewer columns than joined on, so that a very large component can be split
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.max(F.xxhash64("root")).alias("also"))
    named = rooted.withColumn("also", F.xxhash64("root")).join(names, ["root", "also"])
    return prints.join(named.select("fp", "root", "component_id"), "fp")


def hex_digits(fp) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The document with the smallest doc_id of each component, once; all columns of docs.

    A row is known by its doc_id and a hash of its text. Rows equal in both are one document.
    """
    columns = columns or docs.columns
    prints = materialise(with_fingerprints(docs), "prints")
    grouped = near_duplicates(prints)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))
    chosen = grouped.groupBy("root").agg(best.alias("best")).select("best.doc_id", "best.text_hash")
    return rows_of(docs, chosen, columns)


def rows_of(docs: DataFrame, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of chosen (doc_id, text_hash), each once."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("text_hash"),
        F.struct(*[docs[c] for c in columns]).alias("row"),
    )
    kept = rows.join(
        chosen.withColumnsRenamed({"doc_id": "chosen_id", "text_hash": "chosen_hash"}),
        rows["doc_id"].eqNullSafe(F.col("chosen_id")) & (rows["text_hash"] == F.col("chosen_hash")),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
