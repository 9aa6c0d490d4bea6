"""An inverted index of the three-letter parts of patient names, for searches without a full scan.

Postings are rows (SLICE, GRAM, PATIENT_ID): a gram is three neighbouring characters of the name in
upper case, and the slice is a hash of the gram. Stored by slice and sorted by gram, a search reads only
the row groups of its own grams. Names that hold all grams of the text are then checked themselves, so
results are those of a scan. A text of fewer than three characters has no gram and is scanned for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .state import NAME_LIMIT, patients_by_name

GRAM, SLICES = 3, 32


def _slice(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SLICES)).cast("int")


def postings(patients: DataFrame) -> DataFrame:
    """SLICE, GRAM and PATIENT_ID of all names; a name counts a gram once."""
    name = F.upper("FULL_NAME")
    starts = F.sequence(F.lit(1), F.length(name) - (GRAM - 1))
    grams = F.when(F.length(name) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substr(name, i, F.lit(GRAM)))))
    rows = patients.select("PATIENT_ID", F.explode(grams).alias("GRAM"))
    return rows.select(_slice(F.col("GRAM")).alias("SLICE"), "GRAM", "PATIENT_ID")


def write_postings(patients: DataFrame, path: str) -> None:
    """Store the index. A frequent gram is cut into several files of its slice."""
    rows = postings(patients).hint("rebalance", "SLICE", "GRAM").sortWithinPartitions("SLICE", "GRAM", "PATIENT_ID")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("SLICE").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("GRAM string, PATIENT_ID string, SLICE int").parquet(path)


def search(patients: DataFrame, index: DataFrame, text: str, limit: int = NAME_LIMIT) -> DataFrame:
    """The patients whose name holds the text, without regard to case, first by name."""
    sought = text.upper()
    grams = sorted({sought[i : i + GRAM] for i in range(len(sought) - GRAM + 1)})
    if not grams:
        return patients_by_name(patients, text, limit)
    # slices as numbers, so that the scan is pruned to their folders
    slices = [r[0] for r in patients.sparkSession.createDataFrame([(g,) for g in grams], "g string").select(_slice(F.col("g"))).collect()]
    listed = index.filter(F.col("SLICE").isin(sorted(set(slices))) & F.col("GRAM").isin(grams))
    held = listed.groupBy("PATIENT_ID").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams))
    return patients_by_name(patients.join(held, "PATIENT_ID", "left_semi"), text, limit)
