"""Cutting pending work into batches of bounded cost or equal effort."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.costs import CostModel, Quadratic
from tallyloom.functions.names import batch_label
from tallyloom.operators.ordered import SizeOrder, by_size


def assign_batches(
    df: DataFrame,
    cost: CostModel = Quadratic(),
    hours: float = fixed.BATCH_HOURS,
    size: str = "tokens",
    tie: str = "id",
    **limits: int,
) -> DataFrame:
    """Add ``pos, weight, weight_cumsum, batch_id`` in size order.

    A batch holds the rows whose running cost, cut to whole hours, falls into
    the same multiple of ``hours``; ids may skip values where one row costs more.
    Running costs are exact sums, so batches don't depend on how rows are spread. A cost of 0
    or less is an error: no batch would be bounded by it.
    """
    hours_of = cost(F.col(size))
    wrong = F.raise_error(F.concat(F.lit("cost of 0 or less for size "), F.col(size).cast("string")))
    sized = by_size(df, size, tie, F.when(hours_of <= 0, wrong.cast("double")).otherwise(hours_of), **limits)
    whole = F.floor("weight_cumsum").cast("double")
    batch = F.floor(whole / F.lit(float(hours))).cast("bigint")
    return sized.withColumn("batch_id", batch).withColumn(
        "weight_cumsum", F.col("weight_cumsum").cast("double")
    )


def batch_summary(plan: DataFrame, prefix: str = "predictions") -> DataFrame:
    """Rows and predicted cost of each batch, with its label."""
    return (
        plan.groupBy("batch_id")
        .agg(F.count("*").alias("no_of_sequences"), F.sum("weight").alias("predicted_runtime"))
        .withColumn("label", batch_label(F.col("batch_id"), F.col("no_of_sequences"), prefix))
    )


def batch_members(plan: DataFrame, order: tuple[str, ...] = ("tokens", "id"), id_: str = "id"):
    """Ids of each batch as an ordered list.

    A batch is bounded by its cost, so the list is too: ``hours`` over the
    cheapest record's cost.
    """
    ranked = F.sort_array(F.collect_list(F.struct(*order, F.col(id_).alias("_member"))))
    return plan.groupBy("batch_id").agg(
        F.count("*").alias("no_of_sequences"),
        F.transform(ranked, lambda r: r["_member"].cast("string")).alias("members"),
    )


def member_chunks(assigned: DataFrame, rows: int = fixed.MEMBER_CHUNK, id_: str = "id") -> DataFrame:
    """Ids of each batch as ordered lists of at most ``rows``: ``batch_id, chunk, members``.

    Chunks are cut at the positions that ``assign_batches`` gives, so they follow each other
    through the batches, and no batch, however cheap its records, is brought together.
    """
    ranked = F.sort_array(F.collect_list(F.struct("pos", F.col(id_).alias("_member"))))
    return assigned.groupBy("batch_id", F.floor(F.col("pos") / rows).alias("chunk")).agg(
        F.count("*").alias("no_of_sequences"),
        F.transform(ranked, lambda r: r["_member"].cast("string")).alias("members"),
    )


def plan_head(plan: DataFrame, n: int, *order: str) -> DataFrame:
    return plan.orderBy(*order).limit(n)


def plan_tail(plan: DataFrame, n: int, *order: str) -> DataFrame:
    return plan.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def equal_effort(
    df: DataFrame,
    size: str = "tokens",
    tie: str = "id",
    splits: int = fixed.MAX_SPLITS,
    **limits: int,
) -> DataFrame:
    """Split by equal shares of squared size: adds ``share``, ``bin`` and ``batch_id``.

    The running share is cut into ``splits`` equal-width, right-closed bins
    between its least and greatest value; ``batch_id`` is the whole part of the
    bin's average rank over all rows. Bins may stay empty.
    """
    squared = F.col(size).cast("decimal(12,0)") * F.col(size).cast("decimal(12,0)")
    names = SizeOrder("_pos", "_weight", "_running", "_all", "_smallest")
    sized = by_size(df, size, tie, squared, names, digits=0, **limits)
    total = F.coalesce(F.nullif(F.col("_all").cast("double"), F.lit(0.0)), F.lit(1.0))
    low = F.coalesce(F.col("_smallest").cast("double"), F.lit(0.0)) / total
    width = (F.lit(1.0) - low) / F.lit(splits)
    width = F.when(width == 0, 1.0).otherwise(width)
    share = F.col("_running").cast("double") / total
    bin_ = F.greatest(F.ceil((share - low) / width) - 1, F.lit(0))
    binned = sized.withColumn("share", share).withColumn(
        "bin", F.least(bin_, F.lit(splits - 1)).cast("bigint")
    )
    # One row per bin.
    filled = binned.groupBy("bin").agg(F.count("*").alias("_n"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranks = filled.select(
        F.col("bin").alias("_bin"),
        F.floor(F.coalesce(F.sum("_n").over(below), F.lit(0)) + (F.col("_n") + 1) / 2)
        .cast("bigint")
        .alias("batch_id"),
    )
    return binned.join(F.broadcast(ranks), F.col("bin") == F.col("_bin")).select(
        *df.columns, "share", "bin", "batch_id"
    )


def in_size_order(plan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows laid out for output: neighbouring batches together, in order inside a partition."""
    keys = [F.col("batch_id")]
    ranged = plan.repartitionByRange(*([partitions] if partitions else []), *keys)
    return ranged.sortWithinPartitions("batch_id", "tokens", "id")
