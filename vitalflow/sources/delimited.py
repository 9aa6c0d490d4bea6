"""CSV intake: declared schema, blank as NULL, bad rows set aside instead of failing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def load_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read with one extra column `_corrupt`, which holds the text of a malformed line.

    Quotes are optional; compressed files are read as they are. Files are split by Spark,
    which needs one record per line.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return (
        spark.read.schema(wide)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker column, and the malformed lines.

    Two filters over the scan; write each on its own or persist `df` first.
    """
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("LINE"))
    return good, bad
