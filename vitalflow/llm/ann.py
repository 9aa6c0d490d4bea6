"""Approximate nearest neighbours by inner product, over balanced posting lists.

Vectors are lifted to one length M, the largest of the table, by one more coordinate, so that
the largest inner product is the smallest distance. Centroids are fitted by k-means with a
penalty for large clusters on a sample of at most SAMPLE vectors. Every vector is posted to its
nearest list and, if it lies near a boundary, to up to REPLICAS lists whose distance is within a
ratio of the nearest. A query finds near centroids by best-first search in a graph of their
neighbours, which every task holds in memory (at most MAX_LISTS nodes), and reads the lists
within a ratio of the nearest centroid's distance, and further ones until they hold enough
vectors to fill its result. The nearest lists are read first; what the others have below a
query's k-th score there can't be in its result and is not sent on.

A list has no cap: lists and their queries are cut into chunks by hash, and each task meets one
chunk of vectors with one chunk of queries, whatever the list's size. The product of a block
only preselects; scores are summed in double precision, coordinate by coordinate in order, so
that equal vectors have equal scores everywhere and ties go to the smaller vec_id.

Nulls: a vector that is null, empty, zero, or holds null or non-finite components takes no part,
nor does one whose vec_id is null or whose length is not the most usual (ties: the smaller).
Repeated rows: a vec_id is returned once for a query, with its best score; a query never
returns its own vec_id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, materialise

SAMPLE, MAX_LISTS = 20_000, 4096
REPLICAS, POST_RATIO = 4, 1.02
PROBE_RATIO, BEAM, DEGREE = 1.3, 96, 16
CHUNK, QUERY_CHUNK = 2048, 1024
_KINDS = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
RESULT = "query_id long, vec_id long, score double, bound double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array of double) of the rows that take part."""
    vector = F.col("vector")
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("vector")
    ).filter(
        F.col("vec_id").isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vector, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(vector) == (usual["n"] if usual else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def balanced_centroids(points: np.ndarray, lists: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    """k-means whose assignment pays for the size that a cluster had in the round before."""
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:lists]].copy()
    sizes = np.full(len(centres), len(points) / len(centres))
    squares = (points**2).sum(1)
    for _ in range(rounds):
        gaps = (centres**2).sum(1) - 2 * points @ centres.T
        scale = max(float(np.mean(squares + gaps.min(1))), 1e-12)
        own = np.argmin(gaps + 0.25 * scale * sizes * len(centres) / len(points), 1)
        sizes = np.bincount(own, minlength=len(centres)).astype(float)
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        filled = sizes > 0
        centres[filled] = total[filled] / sizes[filled, None]
        empty = np.flatnonzero(~filled)
        if len(empty):  # restart at points far from their centre
            far = np.argsort(-(squares + gaps[np.arange(len(points)), own]))[: len(empty)]
            centres[empty] = points[far]
    return np.unique(centres, axis=0)


class Index:
    """Centroids, their graph, and how many vectors have each as their nearest list."""

    def __init__(self, centres: np.ndarray, length: float, degree: int = DEGREE, seed: int = 5):
        self.centres, self.length = centres, length
        self.squares = (centres**2).sum(1)
        self.sizes = np.zeros(len(centres), np.int64)
        n = len(centres)
        near = []
        for begin in range(0, n, 1024):  # rows of distances, not the whole square at once
            gaps = self.squares - 2 * centres[begin : begin + 1024] @ centres.T
            near.append(np.argsort(gaps, 1)[:, 1 : degree + 1])
        links = [set() for _ in range(n)]
        for i, row in enumerate(np.concatenate(near)):
            for j in row.tolist():
                links[i].add(j)
                links[j].add(i)
        ring = np.random.default_rng(seed).permutation(n).tolist()  # keeps the graph in one part
        for i, j in zip(ring, ring[1:] + ring[:1]):
            if i != j:
                links[i].add(j)
                links[j].add(i)
        self.links = [np.array(sorted(x), np.int64) for x in links]
        self.entry = int(np.argmin(((centres - centres.mean(0)) ** 2).sum(1)))

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.length**2 - (vectors**2).sum(1), 0))
        return np.concatenate([vectors, rest[:, None]], 1)

    def lift_queries(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors * (self.length / np.sqrt((vectors**2).sum(1)))[:, None]
        return np.concatenate([scaled, np.zeros((len(vectors), 1))], 1)

    def post(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, whether it is the row's nearest) of every posting."""
        points = self.lift(vectors)
        gaps = np.maximum((points**2).sum(1)[:, None] + self.squares - 2 * points @ self.centres.T, 0)
        order = np.argsort(gaps, 1, kind="stable")[:, :REPLICAS]
        found = np.take_along_axis(gaps, order, 1)
        keep = found <= found[:, :1] * POST_RATIO**2
        keep[:, 0] = True
        rows, places = np.nonzero(keep)
        return rows, order[rows, places], places == 0

    def near(self, query: np.ndarray, beam: int) -> list[tuple[float, int]]:
        """Best-first search: squared distance and number of about `beam` nearest centroids."""

        def gap(nodes):
            return ((self.centres[nodes] - query) ** 2).sum(1)

        first = float(gap(np.array([self.entry]))[0])
        seen = np.zeros(len(self.centres), bool)
        seen[self.entry] = True
        todo, best = [(first, self.entry)], [(-first, self.entry)]
        while todo:
            distance, node = heapq.heappop(todo)
            if len(best) >= beam and distance > -best[0][0]:
                break
            fresh = self.links[node][~seen[self.links[node]]]
            seen[fresh] = True
            for d, j in zip(gap(fresh).tolist(), fresh.tolist()):
                if len(best) < beam or d < -best[0][0]:
                    heapq.heappush(todo, (d, j))
                    heapq.heappush(best, (-d, j))
                    if len(best) > beam:
                        heapq.heappop(best)
        return sorted((-d, j) for d, j in best)

    def probes(self, query: np.ndarray, wanted: int) -> tuple[list[int], int]:
        """Lists within the ratio of the nearest centroid, and more until they hold enough.

        With them, how many of the first hold enough already.
        """
        beam = min(BEAM, len(self.centres))
        while True:
            out, held, first = [], 0, 0
            found = self.near(query, beam)
            limit = found[0][0] * PROBE_RATIO**2
            for distance, number in found:
                if distance > limit and held >= wanted:
                    return out, first
                first += held < wanted
                out.append(number)
                held += int(self.sizes[number])
            # all that the beam found is wanted: look further
            if beam >= len(self.centres):
                return out, first
            beam = min(2 * beam, len(self.centres))


def build(vectors: DataFrame, lists: int | None = None) -> tuple[Index, DataFrame] | None:
    """The index and its postings (list, nearest, vec_id, vector), stored; None without vectors."""
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    whole = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square")).first()
    if not whole["n"]:
        return None
    length = float(np.sqrt(whole["square"])) * (1 + 1e-12)
    sample = bounded_sample(vectors, F.col("vec_id"), SAMPLE).toArrow().sort_by("vec_id")
    points = _matrix(sample["vector"])
    lists = lists or min(MAX_LISTS, max(1, round(1.5 * np.sqrt(whole["n"]))))
    lifted = Index(np.zeros((1, points.shape[1] + 1)), length).lift(points)
    index = Index(balanced_centroids(lifted, min(lists, len(lifted))), length)

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, numbers, nearest = index.post(_matrix(batch.column(1)))
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers.astype(np.int32)), pa.array(nearest), taken.column(0), taken.column(1)],
                ["list", "nearest", "vec_id", "vector"],
            )

    postings = materialise(
        vectors.mapInArrow(post, "list int, nearest boolean, vec_id long, vector array<double>"), "postings"
    )
    for row in postings.filter("nearest").groupBy("list").count().collect():  # one row per list
        index.sizes[row["list"]] = row["count"]
    return index, postings


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r["list"]: r["count"] for r in rows.groupBy("list").count().collect()}


def _chunk_of(number: Column, counts: dict[int, int], size: int) -> tuple[Column, Column]:
    """How many chunks the list has, as a column, and the chunk of a row by its vec_id."""
    several = {k: -(-n // size) for k, n in counts.items() if n > size}
    chunks = F.lit(1)
    if several:
        table = F.create_map(*[F.lit(x) for pair in sorted(several.items()) for x in pair])
        chunks = F.coalesce(F.try_element_at(table, number), F.lit(1))
    return chunks, F.pmod(F.xxhash64("vec_id"), chunks).cast("int")


def _best(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The k best of the block for each query, ties to the smaller vec_id.

    Scores below a query's bound are left out. bound: the k-th score, if there are so many.
    """
    q, v = _matrix(queries["vector"]), _matrix(vectors["vector"])
    q_ids, v_ids = queries["vec_id"].to_numpy(), vectors["vec_id"].to_numpy()
    if not len(q) or not len(v):
        return pa.table({n: pa.array([], t) for n, t in zip(("query_id", "vec_id", "score", "bound"), _KINDS)})
    rough = q @ v.T
    rough[q_ids[:, None] == v_ids[None, :]] = -np.inf
    # a repeated vec_id may take several places: look that much deeper
    deep = min(len(v), k + len(v_ids) - len(np.unique(v_ids)))
    last = np.partition(rough, len(v) - deep, 1)[:, len(v) - deep]
    last = np.maximum(last, queries["bound"].to_numpy())
    slack = 1e-9 * np.abs(q).sum(1) * (np.abs(v).max() + 1e-300)
    i, j = np.nonzero((rough >= (last - slack)[:, None]) & (rough > -np.inf))
    score = np.zeros(len(i))
    for d in range(q.shape[1]):
        score += q[i, d] * v[j, d]
    order = np.lexsort((v_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    # the first row of each (query, vec_id), then the first k of each query
    pairs = i * (len(v_ids) + 1) + np.unique(v_ids, return_inverse=True)[1][j]
    first = np.zeros(len(i), bool)
    first[np.unique(pairs, return_index=True)[1]] = True
    i, j, score = i[first], j[first], score[first]
    place = np.arange(len(i)) - np.searchsorted(i, i, "left")
    bound = np.full(len(q), -np.inf)
    bound[i[place == k - 1]] = score[place == k - 1]
    keep = place < k
    i, j, score = i[keep], j[keep], score[keep]
    return pa.table({"query_id": q_ids[i], "vec_id": v_ids[j], "score": score, "bound": bound[i]})


def _meet(postings: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Blocks of vectors and queries (list, vec_id, vector, bound) of the same list."""
    vector_chunks, vector_chunk = _chunk_of(F.col("list"), _counts(postings), CHUNK)
    query_chunks, query_chunk = _chunk_of(F.col("list"), _counts(probes), QUERY_CHUNK)

    def blocks(rows: DataFrame, own: Column, own_name: str, others: Column, other_name: str, *more: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), others - 1)).alias(other_name)
        return rows.select("list", own.alias(own_name), every, "vec_id", "vector", *more)

    key = ["list", "vector_chunk", "query_chunk"]
    left = blocks(postings, vector_chunk, "vector_chunk", query_chunks, "query_chunk")
    left = left.join(probes.select("list").distinct(), "list", "left_semi")  # lists that are read
    right = blocks(probes, query_chunk, "query_chunk", vector_chunks, "vector_chunk", "bound")

    def meet(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        return _best(asked, vectors, k)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, RESULT)


def search(index: Index, postings: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row of queries."""

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = [index.probes(x, k + 1) for x in index.lift_queries(_matrix(batch.column(1)))]
            rows = np.repeat(np.arange(len(lists)), [len(x) for x, _ in lists])
            near = np.concatenate([np.arange(len(x)) < n for x, n in lists])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x for x, _ in lists]).astype(np.int32)),
                    pa.array(near),
                    taken.column(0),
                    taken.column(1),
                ],
                ["list", "near", "vec_id", "vector"],
            )

    schema = "list int, near boolean, vec_id long, vector array<double>"
    probes = materialise(queries.mapInArrow(probe, schema), "probes")
    nothing = F.lit(float("-inf"))
    near = materialise(_meet(postings, probes.filter("near").withColumn("bound", nothing), k), "near")
    bounds = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("bound").alias("bound"))
    others = probes.filter("not near").join(bounds, "vec_id", "left")
    far = _meet(postings, materialise(others.withColumn("bound", F.coalesce("bound", nothing)), "probes"), k)
    once = near.unionByName(far).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """vectors: vec_id, embedding. The k nearest other rows of each row that is a query."""
    spark = vectors.sparkSession
    part = materialise(usable(vectors), "vectors")
    built = build(part)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(*built, part.filter(is_query), k)
