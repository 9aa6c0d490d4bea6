"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent 1- to 3-grams of letters of a language, with word ends as a
character. A document's own most frequent n-grams are ranked the same way, and the distance to
a profile is the sum of how far each is out of its place there; an n-gram that the profile
lacks counts as far out as the profile is long. The nearest profile names the language, ties
going to the smaller name.

Profiles are learned from about `sample` documents per language: those whose hash of doc_id
falls in the share of all hashes that holds so many (all, if there are fewer). n-grams are
counted in the tasks, summed by a shuffle of counts, and only the profiles reach the driver.

Nulls: a null text or one without letters is `und` with score 0, and so is every text when
nothing could be learned. Rows without a language teach nothing. Long texts are counted in
slices of bounded size. Repeated rows are kept. An empty table gives no rows. Columns other than
doc_id, text and (for learning) lang are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_share, worker_state

SAMPLE, PROFILE, DOCUMENT = 4000, 600, 400
UNKNOWN = "und"
SLICE = 1 << 20
EDGE = 1  # stands for everything between words
BITS = 21


def _letters() -> np.ndarray:
    state = worker_state()
    if "letters" not in state:
        state["letters"] = np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])
    return state["letters"]


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all 1- to 3-grams of the whole text, ascending, and how often each occurs."""
    letters, text = _letters(), text or ""
    total: dict[int, int] = {}
    carry = np.array([EDGE], np.int64)
    found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(text), SLICE):
        points = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        points = np.where(letters[points], points, EDGE).astype(np.int64)
        ends = [EDGE] if at + SLICE >= len(text) else []
        chain = np.concatenate([carry, points, ends]).astype(np.int64)
        edge = chain == EDGE
        chain = chain[~(edge & np.concatenate([[False], edge[:-1]]))]
        new = len(carry)
        one = chain[new:]
        two = (chain[new - 1 : -1] << BITS) | chain[new:]
        first = max(new, 2)
        middle = chain[first - 1 : -1]
        three = (chain[first - 2 : -2] << 2 * BITS) | (middle << BITS) | chain[first:]
        found = np.unique(np.concatenate([one[one != EDGE], two, three[middle != EDGE]]), return_counts=True)
        carry = chain[-2:]
        if len(text) > SLICE:
            for code, n in zip(found[0].tolist(), found[1].tolist()):
                total[code] = total.get(code, 0) + n
    if total:
        codes = np.array(sorted(total), np.int64)
        found = codes, np.array([total[c] for c in codes.tolist()], np.int64)
    return found


class Profiles:
    """Profiles of all languages as one table: n-gram -> place in each, or -1."""

    def __init__(self, profiles: dict[str, list[int]], size: int, document: int):
        self.names = sorted(profiles)
        self.size, self.document = size, document
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.places = np.full((len(self.names), len(self.codes)), -1, np.int64)
        for i, name in enumerate(self.names):
            self.places[i, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text)
        if not len(codes) or not self.names or not (codes < 1 << BITS).any():
            return UNKNOWN, 0.0
        order = np.argsort(-counts, kind="stable")[: self.document]
        codes = codes[order]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        places = np.where(self.codes[at] == codes, self.places[:, at], -1)
        out = np.where(places < 0, self.size, np.abs(places - np.arange(len(codes))))
        distance = np.minimum(out, self.size).sum(1)
        best = int(np.argmin(distance))
        return self.names[best], 1.0 - float(distance[best]) / (self.size * len(codes))


def learn(docs: DataFrame, sample: int = SAMPLE, size: int = PROFILE, document: int = DOCUMENT) -> Profiles:
    """docs: doc_id, text, lang of the documents that may teach."""
    known = docs.filter("lang is not null").select("lang", "text", "doc_id")
    # a number per language, as the profiles below; no text is dealt out by language
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles({}, size, document)
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, sample / n)])
    chosen = known.filter(hash_share(F.col("doc_id"), shares[F.col("lang")])).select("lang", "text")

    def count(batches):
        held: dict[tuple[str, int], int] = {}

        def take():
            rows = [list(x) for x in zip(*((*k, n) for k, n in held.items()))] or [[], [], []]
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds)], ["lang", "code", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for code, n in zip(*(x.tolist() for x in gram_counts(text.as_py()))):
                    held[lang, code] = held.get((lang, code), 0) + n
                if len(held) > 500_000:
                    yield take()
                    held = {}
        yield take()

    counted = chosen.mapInArrow(count, "lang string, code long, n long")
    counts = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["code"])
    return Profiles(profiles, size, document)


def identify(docs: DataFrame, profiles: Profiles, keep: list[str] | None = None) -> DataFrame:
    """The kept columns as struct `row`, lang_pred, score for every row of docs."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["text"].alias("text"))
    fields = rows.schema["row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["row", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"row {fields}, lang_pred string, score double")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of doc_id as text leaves this remainder; a null doc_id counts as empty."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part
