"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled are a sample of all training
documents, whatever they are. With the class prior p the risk of a scorer is

    p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives))

(R+ and R-: mean logistic loss for the label 1 and 0). Where the second term falls below zero,
the step goes the other way, which keeps a flexible scorer from fitting it below what it can be.
The prior is the share of toxic rows among the labelled training rows, or less where the
unlabelled show it: labelled rows may be chosen for being toxic.

A scorer is linear in the distinct words of a text: each word brings itself and its beginnings
and its ends of 3 to 6 letters as hashed features, so that a word form not met in training still counts by
its parts; a feature that two, or three, distinct words share counts as further features. Kept are features that are found in positives more often than chance allows
over all features tested (Chernoff's bound) and whose holders are toxic to MIN_SHARE at least by
the prior: prior * share among positives / share among unlabelled. MODELS scorers are trained,
each in a task of its own on its own part of the unlabelled and on all positives of the sample,
and their probabilities are averaged.

The sample is bounded: about POSITIVES positives and UNLABELLED unlabelled documents, chosen by
hashes of doc_id. Scores use whole texts.

Nulls: a null text is empty and gets the score of no words. Rows with a null doc_id are scored
but never train. A document with several labels is toxic if one is. Without positives or
without unlabelled rows every score is 0. Repeated rows are kept. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, hash_share
from .langid import held_out

MODELS, POSITIVES, UNLABELLED = 4, 3000, 16000
SPACE = 1 << 20
LEVELS = 3
PARTS = range(3, 7)
MIN_SHARE, MARGIN = 0.7, 2.0
THRESHOLD = 0.3
CACHE_WORDS = 300_000
_WORDS = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> set[int]:
    """Hashed features of a lower-case word."""
    names = {f"={word}"}
    for n in PARTS:
        if n < len(word):
            names |= {f"<{word[:n]}", f">{word[-n:]}"}
    return {zlib.crc32(name.encode("utf-8", "surrogatepass")) % SPACE for name in names}


def text_features(text: str | None) -> np.ndarray:
    """The features of all distinct words, and further ones for features of several words."""
    out: list[int] = []
    for word in set(_WORDS((text or "").lower())):
        out += word_features(word)
    features, words = np.unique(np.array(out, np.int32), return_counts=True)
    levels = [features[words > k] + k * SPACE for k in range(LEVELS)]
    return np.concatenate(levels).astype(np.int32)


def fit(
    positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = 200, rate: float = 0.1, decay: float = 1e-4
) -> tuple[np.ndarray, np.ndarray, float]:
    """The features kept, their weights and the bias."""
    docs = positives + unlabelled
    known = len(positives)
    rows = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) for d in docs])
    features = np.concatenate(docs) if docs else np.zeros(0, np.int32)
    size = LEVELS * SPACE
    of_positive = rows < known
    with_p = np.bincount(features[of_positive], minlength=size)
    with_u = np.bincount(features[~of_positive], minlength=size)
    share_p, share_u = with_p / known, with_u / len(unlabelled)
    n_with = with_p + with_u
    usual = known / len(docs)
    share = np.clip(with_p / np.maximum(n_with, 1), 1e-9, 1 - 1e-9)
    surprise = n_with * (share * np.log(share / usual) + (1 - share) * np.log((1 - share) / (1 - usual)))
    chosen = (share > usual) & (surprise >= np.log((n_with > 0).sum() + 1) + MARGIN)
    chosen &= prior * share_p >= MIN_SHARE * share_u
    place = np.full(size, -1)
    place[chosen] = np.arange(chosen.sum())
    keep = chosen[features]
    rows, columns = rows[keep], place[features[keep]]
    n = int(chosen.sum())
    w = np.zeros(n + 1)
    # toxic documents among the unlabelled can't be more than those that any kept feature marks,
    # for as many as it misses among the positives; labelled rows may hold a larger share
    marked = np.bincount(rows, minlength=len(docs)) > 0
    if marked[:known].any():
        prior = min(prior, max(marked[known:].mean() / marked[:known].mean(), 1e-3))
    w[n] = np.log(prior / (1 - prior))
    moment, square = np.zeros(n + 1), np.zeros(n + 1)
    positive = np.arange(len(docs)) < known

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def slopes(weights):
        """Gradient of the weighted sum of document scores."""
        out = np.empty(n + 1)
        out[:n] = np.bincount(columns, weights=weights[rows], minlength=n)
        out[n] = weights.sum()
        return out

    for epoch in range(1, epochs + 1):
        z = np.bincount(rows, weights=w[columns], minlength=len(docs)) + w[n]
        p = sigmoid(z)
        as_one = np.where(positive, prior * (p - 1) / known, 0.0)
        as_zero = np.where(positive, -prior * p / known, p / len(unlabelled))
        loss = np.logaddexp(0, z)
        negative_risk = loss[~positive].mean() - prior * loss[positive].mean()
        slope = slopes(as_one + as_zero) if negative_risk >= 0 else slopes(-as_zero)
        slope[:n] += decay * w[:n]
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        step = rate * (moment / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
        w -= step * (1 - epoch / (epochs + 1))
    return np.flatnonzero(chosen), w[:n], float(w[n])


class Scorers:
    """Averages the probabilities of several linear scorers."""

    def __init__(self, models: list[tuple[np.ndarray, np.ndarray, float]]):
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *(f for f, _, _ in models)]))
        self.places = {int(f): i for i, f in enumerate(used)}
        self.known = {int(f) % SPACE for f in used}
        self.weights = np.zeros((len(models), len(used)))
        for row, (features, weights, _) in zip(self.weights, models):
            row[np.searchsorted(used, features)] = weights
        self.bias = np.array([b for _, _, b in models])

    def scorer(self):
        words: dict[str, tuple[int, ...]] = {}
        places, known = self.places, self.known

        def score(text: str | None) -> float:
            if not len(self.bias):
                return 0.0
            if len(words) > CACHE_WORDS:
                words.clear()
            counts: dict[int, int] = {}
            for word in set(_WORDS((text or "").lower())):
                features = words.get(word)
                if features is None:
                    features = words[word] = tuple(word_features(word) & known)
                for f in features:
                    counts[f] = counts.get(f, 0) + 1
            found = [
                places[f + k * SPACE]
                for f, n in counts.items()
                for k in range(min(n, LEVELS))
                if f + k * SPACE in places
            ]
            z = self.bias + self.weights[:, sorted(found)].sum(1)
            return float((1 / (1 + np.exp(-np.clip(z, -30, 30)))).mean())

        return score


def train(docs: DataFrame, labels: DataFrame) -> Scorers:
    """docs: doc_id, text; labels: doc_id, toxic; both of training rows only."""
    marked = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    share = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not share["toxic"] or not share["n"]:
        return Scorers([])
    prior = min(max(share["toxic"] / share["n"], 1e-3), 0.9)
    toxic = bounded_sample(marked.filter("toxic = 1").select("doc_id"), F.col("doc_id"), POSITIVES)
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    rows = docs.count()
    near = F.lit(1.0) if not rows else F.lit(UNLABELLED / rows)
    # at most POSITIVES ids are broadcast
    known = docs.join(F.broadcast(toxic.withColumn("positive", F.lit(1))), "doc_id", "left")
    part = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(MODELS)).cast("int")
    positive, drawn = F.col("positive").isNotNull(), hash_share(F.col("doc_id"), near)
    sample = known.filter(positive | drawn).select(
        F.when(drawn, part).otherwise(F.lit(-1)).alias("part"), positive.cast("int").alias("positive"), "doc_id", "text"
    )

    def describe(batches):
        for batch in batches:
            features = [text_features(t.as_py()).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(features, pa.binary())],
                ["part", "positive", "doc_id", "features"],
            )

    # a positive goes to every scorer as one and, if it is drawn, to one as unlabelled too
    described = sample.mapInArrow(describe, "part int, positive int, doc_id long, features binary")
    uses = [F.struct(F.lit(m).alias("model"), F.lit(1).alias("as_positive")) for m in range(MODELS)]
    own = F.struct(F.col("part").alias("model"), F.lit(0).alias("as_positive"))
    use = F.explode(F.when(F.col("positive") == 1, F.array(own, *uses)).otherwise(F.array(own)))
    described = described.select(use.alias("use"), "doc_id", "features").select("use.*", "doc_id", "features")
    described = described.filter("model >= 0")

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("as_positive", "ascending")])  # runs agree
        data = [np.frombuffer(b.as_py(), np.int32) for b in group["features"]]
        marks = group["as_positive"].to_pylist()
        positives = [d for d, m in zip(data, marks) if m]
        others = [d for d, m in zip(data, marks) if not m]
        found = [fit(positives, others, prior)] if positives and others else []
        return pa.table(
            {
                "features": pa.array([f.astype("<i8").tobytes() for f, _, _ in found], pa.binary()),
                "weights": pa.array([w.astype("<f8").tobytes() for _, w, _ in found], pa.binary()),
                "bias": pa.array([b for _, _, b in found], pa.float64()),
            }
        )

    models = described.groupBy("model").applyInArrow(learn, "features binary, weights binary, bias double").collect()
    read = [(np.frombuffer(bytes(m[0]), "<i8"), np.frombuffer(bytes(m[1]), "<f8"), m[2]) for m in models]
    return Scorers(sorted(read, key=lambda m: m[2]))


def score(docs: DataFrame, scorers: Scorers) -> DataFrame:
    """doc_id, score for every row of docs."""

    def run(batches):
        of = scorers.scorer()
        for batch in batches:
            scores = [of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def teachers(df: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of doc_id as text leaves another remainder than 2 by 4."""
    return df.filter(~held_out(df["doc_id"], 4, 2))
