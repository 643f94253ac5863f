"""Lists of ids, one per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """``id`` per line; ``#`` starts a comment anywhere, blank lines are skipped."""
    id_ = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(id_.alias("id")).where("id != ''")
