"""Small fixed dimensions: hardware variants, size tiers, attempt ladders."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.session import small_table


def per_variant(df: DataFrame, variants: list[str] = fixed.VARIANTS, out: str = "variant"):
    """Every row under every variant, without a join."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(v) for v in variants])))


def per_row(df: DataFrame, small: DataFrame, out: str = "variant") -> DataFrame:
    """Every row under every row of a small table, a struct; the table is read as one array."""
    held = small.agg(F.collect_list(F.struct(*small.columns)).alias("held"))
    return df.withColumn(out, held.scalar()).withColumn(out, F.explode(out))


def tier_of(size: Column, tiers: list[dict], kind: Column | None = None) -> Column:
    """The fields of the first tier whose inclusive bounds hold ``size``; NULL if none does."""
    chosen = None
    for tier in tiers:
        fits = size >= tier["lo"]
        if tier["hi"] is not None:
            fits = fits & (size <= tier["hi"])
        if "kind" in tier:
            fits = fits & (kind == tier["kind"])
        fields = F.struct(
            *[F.lit(v).alias(k) for k, v in tier.items() if k not in ("lo", "hi", "kind")]
        )
        chosen = F.when(fits, fields) if chosen is None else chosen.when(fits, fields)
    return chosen


def ladder_table(spark, ladders: dict = fixed.LADDERS) -> DataFrame:
    """One row per step and 1-based attempt."""
    rows = [
        {"step": step, "attempt": n + 1, **{name: rungs[name][n] for name in rungs}}
        for step, rungs in ladders.items()
        for n in range(len(rungs["runtime"]))
    ]
    return small_table(
        spark,
        rows,
        "step string, attempt int, runtime string, mem_mb int, disk_mb int, gpu_mem string",
    )


def with_ladder(df: DataFrame, ladders: dict = fixed.LADDERS) -> DataFrame:
    """Resources of ``(step, attempt)``; ``exhausted`` where the attempt is past the last rung."""
    table = F.broadcast(ladder_table(df.sparkSession, ladders))
    return df.join(table, ["step", "attempt"], "left").withColumn(
        "exhausted", F.col("runtime").isNull()
    )
