"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans. Cluster sizing (memory, cores, shuffle
# partitions) stays with the submitter.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "vitalflow", master: str | None = None, **conf: str) -> SparkSession:
    """Create or fetch a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A local temporary folder is used only when the session names none, which is
    the case in tests on one machine. On a cluster the setting must be present.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if named:
        if not current.isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="vitalflow-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def write_through(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to a new place in the shared folder and read from there.

    Later jobs read only the columns they need, and lost executors don't recompute the rows.
    """
    place = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
