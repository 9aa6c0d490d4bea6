"""Helpers that several operators share: shared folders, bounded samples, worker state."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a session on one machine (tests) may leave the setting out.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="vitalflow-llm-"))
        found = context.getCheckpointDir()
    return found


def work_dir(spark: SparkSession, name: str) -> str:
    """A new place of its own in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder; lost executors don't recompute them."""
    place = work_dir(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def hash_share(key: Column, share: Column | float) -> Column:
    """Whether the hash of key falls in the lowest share (0 to 1) of all hashes."""
    return (F.xxhash64(key).cast("double") / F.lit(2.0**64) + 0.5) < share


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """At most `most` rows, those with hashes of key in the share that holds about so many."""
    rows = df.count()
    return df.filter(hash_share(key, most / max(rows, 1))).limit(most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_state() -> dict:
    """A dictionary that lives as long as the worker process, for loaded models and caches."""
    name = "_vitalflow_llm_worker"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


class RowWriter:
    """Collects rows into record batches of a fixed schema."""

    def __init__(self, schema: pa.Schema, size: int = 4096):
        self.schema, self.size, self.rows = schema, size, []

    def add(self, *row) -> None:
        self.rows.append(row)

    def full(self) -> bool:
        return len(self.rows) >= self.size

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in self.schema]
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, self.schema)]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)
