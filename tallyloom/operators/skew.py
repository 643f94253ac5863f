"""Finding hot keys and joining through them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows of one key that a single task is given to sort or join.
HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, with their count ``_n``; None if there are none.

    Only key columns are read and counts combine map-side. The result has at
    most ``rows / hot_rows`` entries, which is what makes it safe to collect
    and broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    found = counts.toArrow()
    if not found.num_rows:
        return None
    return df.sparkSession.createDataFrame(found, counts.schema)


def total(hot: DataFrame) -> int:
    """Rows under all hot keys."""
    return hot.agg(F.sum("_n")).first()[0]


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]):
    """Null-safe equality of all keys."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows under ordinary keys and rows under hot keys."""
    small = F.broadcast(hot.select(*keys))
    condition = same_keys(df, small, keys)
    return df.join(small, condition, "left_anti"), df.join(small, condition, "left_semi")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join many rows to a lookup with one row per key, salting hot keys.

    Rows of a hot key are spread by a hash of ``spread`` (columns that differ
    between them) over enough salts to stay under ``hot_rows``; only the
    matching lookup rows are repeated, once per salt.
    """
    return salted_join(left, right, key, spread, hot_keys(left, [key], hot_rows), how, hot_rows)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: list[str],
    hot: DataFrame | None,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`lookup_join` with the hot keys that :func:`hot_keys` found."""
    if hot is None:
        return left.join(right, key, how)
    salts = F.broadcast(
        hot.select(
            F.col(key).alias("_hot"), F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")
        )
    )
    same = F.col(key).eqNullSafe(F.col("_hot"))
    spread_salt = F.coalesce(F.pmod(F.xxhash64(*spread), "_salts").cast("int"), F.lit(0))
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_left = left.join(salts, same, "left").withColumn("_salt", spread_salt)
    salted_right = right.join(salts, same, "left").withColumn("_salt", F.explode(repeats))
    return (
        salted_left.drop("_hot", "_salts")
        .join(salted_right.drop("_hot", "_salts"), [key, "_salt"], how)
        .drop("_salt")
    )
