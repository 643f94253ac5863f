"""Operators that depend on row order, without handing a whole group to one task.

A group of ordinary size goes through a plain window. A larger one, or a table
ordered as a whole, is range-partitioned into slices: each slice is worked on
by itself, and what it needs from the slices before it comes from a table of
per-slice totals.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.skew import HOT_ROWS, hot_keys, split_hot, total
from tallyloom.session import written

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def slices(
    df: DataFrame, order: list[str], slice_rows: int = HOT_ROWS, rows: int | None = None
) -> DataFrame:
    """Rows tagged with ``_slice``; slices follow each other in ``order``.

    Written once, because range bounds come from a sample and every later use
    must see the same ones. ``rows`` saves a count where it is known.
    """
    rows = df.count() if rows is None else rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-rows // slice_rows))
    ranged = df.repartitionByRange(parts, *order)
    return written(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def _sliced_sum(df, value, order, by, out, frame, slice_rows, rows=None, total=None):
    sliced = slices(df, [*by, *order], slice_rows, rows)
    totals = sliced.groupBy(*by, "_slice").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(*_BEFORE)
    starts = totals.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_total").over(Window.partitionBy(*by)).alias("_whole"),
    )
    match = F.col("_slice") == F.col("_at")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    whole = [F.col("_whole").alias(total)] if total else []
    local = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(*frame)
    return (
        sliced.withColumn(out, F.coalesce(F.sum(value).over(local), F.lit(0)))
        .join(starts, match)
        .select(*df.columns, (F.col("_start") + F.col(out)).alias(out), *whole)
    )


def running_sum(
    df: DataFrame,
    value: Column,
    order: list[str],
    out: str,
    by: list[str] | None = None,
    inclusive: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running sum of ``value`` in ``order``, for the whole table or per ``by`` key.

    ``order`` must be total inside a group.
    """
    frame = _UP_TO if inclusive else _BEFORE
    by = by or []
    if not by:
        return _sliced_sum(df, value, order, by, out, frame, hot_rows)
    hot = hot_keys(df, by, hot_rows)
    cold_rows, hot_part = (df, None) if hot is None else split_hot(df, by, hot)
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(*frame)
    cold = cold_rows.withColumn(out, F.coalesce(F.sum(value).over(window), F.lit(0)))
    if hot_part is None:
        return cold
    warm = _sliced_sum(hot_part, value, order, by, out, frame, hot_rows, total(hot))
    return cold.unionByName(warm)


def previous_value(
    df: DataFrame,
    value: str,
    order: list[str],
    by: list[str],
    out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``out`` is a struct with the previous row's ``value``; NULL on a group's first row."""
    boxed = F.struct(F.col(value).alias("value"))
    hot = hot_keys(df, by, hot_rows)
    cold_rows, hot_part = (df, None) if hot is None else split_hot(df, by, hot)
    cold = cold_rows.withColumn(out, F.lag(boxed).over(Window.partitionBy(*by).orderBy(*order)))
    if hot_part is None:
        return cold

    sliced = slices(hot_part, [*by, *order], hot_rows, total(hot))
    ends = sliced.groupBy(*by, "_slice").agg(F.max_by(boxed, F.struct(*order)).alias("_end"))
    carried = ends.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_slice").alias("_at"),
        F.lag("_end").over(Window.partitionBy(*by).orderBy("_slice")).alias("_carry"),
    )
    match = F.col("_slice") == F.col("_at")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    local = Window.partitionBy(*by, "_slice").orderBy(*order)
    warm = (
        sliced.withColumn(out, F.lag(boxed).over(local))
        .join(carried, match)
        .select(*df.columns, F.coalesce(out, "_carry").alias(out))
    )
    return cold.unionByName(warm)


@dataclass(frozen=True)
class SizeOrder:
    """Names of the columns that :func:`by_size` adds; a sum over all rows and the least weight
    only where they are named."""

    position: str = "pos"
    weight: str = "weight"
    running: str = "weight_cumsum"
    total: str | None = None
    least: str | None = None


#: Bits of a place that count rows within a slice; the others number the slice.
_PLACE_BITS = 33


def by_size(
    df: DataFrame,
    size: str,
    tie: str,
    weight: Column | None = None,
    names: SizeOrder = SizeOrder(),
    digits: int = 12,
    partitions: int | None = None,
) -> DataFrame:
    """0-based position in ``(size, tie)`` order and the exact running sum of ``weight``.

    ``weight`` is an expression over ``size`` alone, so equal sizes weigh the same; without
    it only the position is added. Weights are rounded to ``digits`` decimal places and summed
    as decimals, so sums are the same however rows are spread over slices. A null weight adds
    nothing.

    Rows are range-partitioned, sorted and written with their place; beyond the sample that
    the ranges come from, ``df`` is read once.
    Positions then need one row per slice, sums one row for each size in a slice: a size that
    spans several slices is summed up in each of them.
    """
    order = [size, tie]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    rows = written(placed, "size-order").withColumn("_slice", F.shiftright("_place", _PLACE_BITS))
    weighed = rows.groupBy("_slice", size).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    if weight is not None:
        exact = F.coalesce(F.col("_w").cast(f"decimal(24,{digits})"), F.lit(0).cast(f"decimal(24,{digits})"))
        weighed = weighed.withColumn("_w", weight).withColumn("_exact", exact)
        weighed = weighed.withColumn("_cost", F.col("_n").cast("decimal(13,0)") * F.col("_exact"))
    starts = _slice_starts(weighed, weight is not None)
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    position = (F.col("_rows") + place).alias(names.position)
    if weight is None:
        return rows.join(F.broadcast(starts), F.col("_slice") == F.col("_at")).select(*df.columns, position)

    def sum_of(column):
        return F.col(column).cast(f"decimal(36,{digits})")

    smaller = Window.partitionBy("_slice").orderBy(F.asc_nulls_first(size)).rowsBetween(*_BEFORE)
    within = F.coalesce(F.sum("_cost").over(smaller), F.lit(0))
    sizes = (
        weighed.withColumn("_within", within)
        .join(F.broadcast(starts), F.col("_slice") == F.col("_at"))
        .select(
            "_at", F.col(size).alias("_size"), "_first", "_w", "_exact", "_rows", "_all", "_least",
            (sum_of("_within") + sum_of("_before")).alias("_start"),
        )
    )
    same = (F.col("_slice") == F.col("_at")) & F.col(size).eqNullSafe(F.col("_size"))
    rank = (F.col("_place") - F.col("_first") + 1).cast("decimal(13,0)")
    more = [F.col(c).alias(n) for c, n in (("_all", names.total), ("_least", names.least)) if n]
    return (
        rows.join(sizes, same)
        .withColumn("_own", rank * F.col("_exact"))
        .select(
            *df.columns,
            position,
            F.col("_w").alias(names.weight),
            (sum_of("_start") + sum_of("_own")).alias(names.running),
            *more,
        )
    )


def _slice_starts(weighed: DataFrame, sums: bool) -> DataFrame:
    """One row for each slice: what comes before it, and the sum and least weight of all slices."""
    earlier = Window.orderBy("_slice").rowsBetween(*_BEFORE)
    added = [F.sum("_n").alias("_n")]
    found = {"_rows": F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint")}
    if sums:
        added += [F.sum("_cost").alias("_cost"), F.min("_w").alias("_least")]
        found |= {
            "_before": F.coalesce(F.sum("_cost").over(earlier), F.lit(0)),
            "_all": F.sum("_cost").over(Window.partitionBy()),
            "_least": F.min("_least").over(Window.partitionBy()),
        }
    slices_ = weighed.groupBy("_slice").agg(*added)
    return slices_.select(F.col("_slice").alias("_at"), *[c.alias(n) for n, c in found.items()])


def cost_share(df: DataFrame, key: str, cost: Column, digits: int = 12) -> DataFrame:
    """``key, before, cost, total``: summed ``cost`` of each key, of all lesser keys and of all
    rows, exact to ``digits`` decimal places. Costs combine map-side."""
    costs = df.groupBy(key).agg(F.sum(cost.cast(f"decimal(24,{digits})")).alias("cost"))
    # Ranges of keys, not of rows: no count is needed to keep them small.
    summed = _sliced_sum(costs, F.col("cost"), [key], [], "before", _BEFORE, HOT_ROWS, 0, total="total")
    return summed.select(key, "before", "cost", "total")
