"""A training-data pipeline over the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's rows
to the shared folder and reads them again for the next. All but the last return the columns of
documents. Stages:

1. quality rules: documents that fail a base rule or whose lines are mostly boilerplate go
2. language: documents without a known language, or far from every profile, go
3. near-duplicates: of each component of documents alike in 0.8 or more of their five-word
   shingles, the smallest doc_id stays; candidates from the SimHash trie and from MinHash, links
   by exact Jaccard
4. mixing: documents are taken 0 to 3 times, so that sources come near their target weights
5. packing: the pieces of all documents in sequences of at most 2048 tokens

Nulls, empty tables and repeated rows follow the operators' own definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalflow.llm import langid, line_quality, mixing, near_dup, packing, queries
from vitalflow.llm.common import materialise, table

#: Stages with trained models, hashes of text and a tokenizer have no SQL form.
ORACLE_SQL = None
#: Least likeness to the nearest language profile; ordinary texts have 0.6 and more.
MIN_LANGUAGE_SCORE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge(docs, field).filter("kept").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    profiles = langid.learn(docs.select("doc_id", "text", "lang"))
    found = langid.identify(docs, profiles)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.filter(known).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return near_dup.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # measured once; the mix reads the sizes in many places
    return mixing.emit(mixing.mix(materialise(mixing.measure(docs), "measured")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return packing.pack(docs, queries.tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing to target weights", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
