"""Near-duplicates by exact likeness: Jaccard >= LIKENESS over distinct shingles of five words.

Words are those of the SimHash module, in lower case for ASCII; a text of fewer than five words
is one shingle, and texts without words are equal. The result is one document of each component
of pairs that are alike.

Candidates come from two sources. SimHash fingerprints of the shingles are joined in the binary trie
of the SimHash module with a budget of BITS; this finds the closest copies by few pairs, but at 0.8
a pair differs in 10 bits of 64 on average and in up to 20, and so wide a join compares nearly
everything. So MinHash in BANDS bands of ROWS values finds the others: a pair at the limit of 0.8
shares no band with probability (1 - 0.8 ** 4) ** 26, about one in a million, and more alike pairs
less often. Every link is confirmed by the Jaccard of the whole texts.

Texts of equal shingles are one node, which keeps the sorted 64-bit hashes of its shingles. Links
are looked for in two rounds. First the trie's links are confirmed, and each node is compared with
the least node of its fingerprint and with the smallest and the largest of its buckets, which joins a large group of copies by a number of pairs that grows with its
size only. Then the buckets that still hold several components are searched whole: a large bucket is
cut into chunks by hash, and pairs of chunks are dealt to tasks, each row with its hashes. A task
goes through its unit node by node, the most agreeing MinHash values first, and compares a node only
with nodes that are not connected to it yet, so it gives a spanning forest, fewer links than it has
rows. Compared are those whose BANDS * ROWS MinHash values agree in AGREE or more; a pair at the limit
fails that about three times in a million. Nothing is capped: a large bucket whose nodes are all
alike in less than the limit, but not much less, is compared pair by pair inside its tasks.

Nulls: a null text has no words. A null doc_id stays only where the component has no other.
Repeated rows are one document. An empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise
from .components import components
from .simhash import _LOWER, rows_of
from .simhash import links as trie_links

LIKENESS, SHINGLE, SEED = 0.8, 5, 42
BANDS, ROWS, AGREE = 26, 4, 64
#: Differing bits of SimHash fingerprints that make a candidate.
BITS = 3
#: Nodes of a bucket in one chunk.
CHUNK = 1_024
_DRAW = np.random.default_rng(SEED)
_FACTORS = _DRAW.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _DRAW.integers(0, 2**63, BANDS * ROWS, np.uint64)
_WORDS = re.compile(WORD).findall


def shingles(text: str | None) -> set[str]:
    words = _WORDS((text or "").translate(_LOWER))
    if len(words) < SHINGLE:
        return {" ".join(words)} if words else set()
    return set(map(" ".join, zip(*(words[i:] for i in range(SHINGLE)))))


def hashed(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    from xxhash import xxh64_intdigest

    return np.array(sorted(xxh64_intdigest(s, SEED) for s in shingles(text)), np.uint64)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets of hashes have a Jaccard of LIKENESS or more."""
    if len(a) > len(b):
        a, b = b, a
    if 5 * len(a) < 4 * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return 5 * both >= 4 * (len(a) + len(b) - both)  # LIKENESS in whole numbers


def describe(text: str | None) -> tuple[int, int, list[int], bytes]:
    """Key of the set of shingles, SimHash, a value for each band, and a byte of each MinHash value."""
    from xxhash import xxh64_intdigest

    hashes = hashed(text)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 1024):  # bounds the memory of a long text
        part = _FACTORS[:, None] * hashes[at : at + 1024] + _TERMS[:, None]
        np.minimum(least, part.min(1), out=least)
    ones = np.zeros(64, np.uint64)
    for at in range(0, len(hashes), 1024):
        ones += np.unpackbits(hashes[at : at + 1024].view(np.uint8).reshape(-1, 8), axis=1).sum(0)
    print_ = int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")
    signed = [xxh64_intdigest(hashes.tobytes(), SEED), print_]
    signed += [xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(BANDS, ROWS))]
    key, fp, *bands = np.array(signed, np.uint64).view(np.int64).tolist()
    return key, fp, bands, (least >> np.uint64(56)).astype(np.uint8).tobytes()


def with_bands(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, text_hash long, node long, fp long, bands array<long>, marks binary"

    def run(batches):
        for batch in batches:
            found = [describe(t.as_py()) for t in batch.column(2)]
            node, fp, bands, marks = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(node, pa.int64()), pa.array(fp, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "text_hash", "node", "fp", "bands", "marks"],
            )

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"].alias("text")
    ).mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """node, hashes: the sorted hashes of each node's shingles."""

    def run(batches):
        for batch in batches:
            hashes = [hashed(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], ["node", "hashes"])

    return texts.mapInArrow(run, "node long, hashes binary")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b of nodes whose texts are alike."""

    def run(batches):
        for batch in batches:
            sides = ([np.frombuffer(x.as_py(), np.uint64) for x in batch.column(k)] for k in (2, 3))
            kept = pa.array([i for i, (a, b) in enumerate(zip(*sides)) if alike(a, b)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(kept) for k in (0, 1)], ["a", "b"])

    first = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    second = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "hashes_a", "hashes_b")
    return both.mapInArrow(run, "a long, b long")


def forest(two_chunks: bool, rows: list[tuple]) -> list[tuple[int, int]]:
    """Links of alike nodes of one unit that connect what is connected, with no cycle.

    Rows: node, root, chunk, marks, hashes. Rows of one root are connected already; in a unit of
    two chunks only pairs across them count, the others are another unit's.
    """
    node, root, chunk = (np.array(c) for c in list(zip(*rows))[:3])
    marks = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    group, links = np.unique(root, return_inverse=True)[1], []
    for i in range(len(rows) - 1):
        agree = (marks[i + 1 :] == marks[i]).sum(1)
        near = (agree >= AGREE) & (group[i + 1 :] != group[i])
        if two_chunks:
            near &= chunk[i + 1 :] != chunk[i]
        at = np.flatnonzero(near)
        for j in at[np.argsort(-agree[at], kind="stable")] + i + 1:
            if group[j] != group[i] and alike(sets[i], sets[j]):
                links.append((min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))))
                group[group == group[j]] = group[i]
    return links


def _across(batches):
    """Links of all units; the rows of a partition are sorted by unit."""
    now, rows = None, []

    def done():
        links = forest(now[1] != now[2], rows) if len(rows) > 1 else []
        columns = [pa.array(c, pa.int64()) for c in zip(*links)] or [pa.array([], pa.int64())] * 2
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        for value, low, high, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (value, low, high) != now:
                if now is not None:
                    yield done()
                now, rows = (value, low, high), []
            rows.append(row)
    if now is not None:
        yield done()


def links_across(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """members: value, node, marks. Links that connect components in the buckets of several."""
    rooted = members.join(labels.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialise(rooted, "rooted")
    mixed = rooted.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.filter("low < high").select("value", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    units = rooted.join(mixed, "value").withColumn("chunk", chunk).join(sets, "node")
    units = units.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "value", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "node", "root", "chunk", "marks",
        "hashes",
    )
    parallel = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parallel, "value", "low", "high").sortWithinPartitions("value", "low", "high", "node")
    return dealt.mapInArrow(_across, "a long, b long")


def _close(nodes: DataFrame) -> DataFrame:
    """Candidates end, node by fingerprint: the trie's links, and equal ones with the least node."""
    prints = materialise(nodes.groupBy("fp").agg(F.min("node").alias("least")), "prints")
    equal = nodes.join(prints, "fp").filter("node <> least").select(F.col("least").alias("end"), "node")
    found = trie_links(prints.select("fp"), BITS)
    ends = found.join(prints.select(F.col("fp").alias("a"), F.col("least").alias("end")), "a")
    both = ends.join(prints.select(F.col("fp").alias("b"), F.col("least").alias("node")), "b")
    return equal.union(both.select("end", "node"))


def keep_one(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The document with the smallest doc_id of each component, once; all columns of docs."""
    described = materialise(with_bands(docs), "bands")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("best")
    nodes = materialise(
        described.groupBy("node").agg(
            best, F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("marks").alias("marks")
        ),
        "nodes",
    )
    every = nodes.select("node", F.explode("bands").alias("value"))
    buckets = every.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
    members = materialise(every.join(buckets.filter("n > 1").drop("n"), "value"), "members")
    ends = members.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    first = ends.select(F.explode(F.array("low", "high")).alias("end"), "node").filter("end <> node")
    pairs = first.union(_close(nodes)).select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b"))
    pairs = materialise(pairs.distinct(), "pairs")
    # the texts of nodes that share a bucket or fingerprint bits with others
    asked = ends.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    known = nodes.join(asked, "node", "left_semi").select("node", "best.doc_id", "best.text_hash")
    rows = docs.select(docs["doc_id"].cast("long").alias("own"), F.xxhash64(docs["text"]).alias("hash"), docs["text"].alias("text"))
    same = rows["own"].eqNullSafe(known["doc_id"]) & (rows["hash"] == known["text_hash"])
    # a text that two rows hold gives its set twice
    once = rows.join(known, same).select("node", "text")
    sets = materialise(_sets(once).dropDuplicates(["node"]), "sets")
    links = materialise(_confirm(pairs, sets), "links")
    labels = components(links)
    marked = members.select("value", "node").join(nodes.select("node", "marks"), "node")
    more = materialise(links_across(marked, labels, sets), "links")
    if more.take(1):
        labels = components(links.union(more))
    rooted = nodes.select("node", "best").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    chosen = rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.text_hash")
    return rows_of(docs, chosen, columns or docs.columns)
