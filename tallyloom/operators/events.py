"""Operators over ordered lines and samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import previous_value, running_sum
from tallyloom.operators.skew import HOT_ROWS


def segments(
    df: DataFrame,
    by: list[str],
    order: list[str],
    captures: list[str],
    done: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Runs of rows that end at a row with ``done``, each with its last captures.

    ``closed`` is false for the rows after a group's last ``done``. Rows without
    any capture change nothing; drop them beforehand where that is cheap to tell.
    """
    captures = [*captures, done]
    is_done = F.col(done).isNotNull().cast("bigint")
    needed = df.select(*by, *order, *captures)
    numbered = running_sum(needed, is_done, order, "_segment", by, False, hot_rows)
    place = F.struct(*order)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in captures]
    return (
        numbered.groupBy(*by, F.col("_segment").alias("segment"))
        .agg(*last)
        .withColumn("closed", F.col(done).isNotNull())
    )


def assemble_events(
    df: DataFrame,
    by: list[str],
    order: list[str],
    captures: list[str],
    done: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One event per ``done`` row with the last captures since the ``done`` before.

    ``complete`` tells whether every capture was seen; unfinished tails are dropped.
    """
    whole = F.lit(True)
    for c in captures:
        whole = whole & F.col(c).isNotNull()
    runs = segments(df, by, order, captures, done, hot_rows)
    return runs.where("closed").drop("closed").withColumn("complete", whole)


def changes_only(
    df: DataFrame, value: str, by: list[str], order: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose ``value`` differs from the row before in their group; first rows stay."""
    boxed = previous_value(df, value, order, by, "_previous", hot_rows)
    changed = F.col("_previous").isNull() | ~F.col("_previous.value").eqNullSafe(F.col(value))
    return boxed.where(changed).drop("_previous")


def first_wins(df: DataFrame, key: str, position: str, out: str = "written") -> DataFrame:
    """Flag the first row of each key by ``position``, which is unique over the table.

    The minimum per key combines map-side and comes back joined on the unique
    position, so a popular key never gathers in one task.
    """
    firsts = df.groupBy(key).agg(F.min(position).alias("_first")).select("_first")
    return df.join(firsts, F.col(position) == F.col("_first"), "left").select(
        *df.columns, F.col("_first").isNotNull().alias(out)
    )
