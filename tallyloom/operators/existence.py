"""Which expected artifacts exist, and what is therefore pending."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_exists(df: DataFrame, listing: DataFrame, key: str = "id", out: str = "pred_isfile"):
    """Flag rows whose key is listed; one listing scan instead of a probe per row."""
    listed = listing.select(F.col(key).alias("_listed")).distinct()
    return df.join(listed, F.col(key) == F.col("_listed"), "left").select(
        *df.columns, F.col("_listed").isNotNull().alias(out)
    )


def pending(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not yet done."""
    return df.join(done.select(key), key, "left_anti")


def finished(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is done."""
    return df.join(done.select(key), key, "left_semi")


def union_ids(*frames: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of all frames."""
    ids = frames[0].select(key)
    for other in frames[1:]:
        ids = ids.unionByName(other.select(key))
    return ids.distinct()


def required(df: DataFrame, lookup: DataFrame, key: str = "id") -> DataFrame:
    """Rows joined to the lookup they need; ``found`` is false where it has no such key.

    The lookup holds one row per key.
    """
    marked = lookup.withColumn("found", F.lit(True))
    joined = df.join(marked, key, "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def accepted(df: DataFrame, check: Column) -> DataFrame:
    """Rows that pass a check."""
    return df.where(check)


def quarantined(df: DataFrame, check: Column) -> DataFrame:
    """The other rows: those that fail it, and those it cannot tell."""
    return df.where(~F.coalesce(check, F.lit(False)))
