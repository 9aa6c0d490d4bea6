"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    best_fit,
    langid,
    line_quality,
    merkle,
    mixing,
    packing,
    page_diff,
    periodic_runs,
    simhash,
    token_store,
    toxicity,
    warc,
)
from .common import materialise, table, work_dir

#: Records of one batch for Python workers: bounds a worker's memory with long texts.
BATCH_ROWS = "1000"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = materialise(mixing.measure(docs, keep=["doc_id"]), "mixing")
    return mixing.mix(measured).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_store.write(docs, tokenizer_path("word_bpe_49k.json"), work_dir(spark, "tokens"))
    return token_store.read(spark, files)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), work_dir(spark, "warc"))
    return warc.read(spark, archives).drop("url")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = materialise(simhash.with_fingerprints(table(spark, sf_dir, "documents")), "prints")
    return simhash.near_duplicates(prints).select(
        "doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id"
    )


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.held_out(docs["doc_id"], 5, 0)
    profiles = langid.learn(docs.filter(~held_out).select("doc_id", "text", "lang"))
    held_out = langid.held_out(F.col("row.doc_id"), 5, 0)
    return langid.identify(docs, profiles, ["doc_id"]).select(
        "row.doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge(docs, field, ["doc_id"]).select("row.*", "*").drop("row")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorers = toxicity.train(toxicity.teachers(docs), toxicity.teachers(labels))
    return toxicity.score(docs, scorers).select(
        "doc_id",
        langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = merkle.tampered_documents(docs)
    found = merkle.manifest(docs, merkle.DOCUMENT_COLUMNS, "source", "doc_id", changed)
    return found.withColumnRenamed("id", "doc_id").drop("grp")


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.detect(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_ann": op10_ann,
    "op9_page_diff": op9_page_diff,
    "op3_toxicity": op3_toxicity,
    "op2_line_quality": op2_line_quality,
    "op4_langid": op4_langid,
    "op8_simhash": op8_simhash,
    "op1_warc": op1_warc,
    "op5_packing": op5_packing,
    "op6_mixing": op6_mixing,
    "op7_token_store": op7_token_store,
    "op11_merkle": op11_merkle,
    "op12_best_fit": op12_best_fit,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {"op1_warc": warc.ORACLE, "op6_mixing": mixing.ORACLE, "op11_merkle": merkle.ORACLE}


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
