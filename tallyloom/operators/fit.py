"""Least squares on centred and scaled sizes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.costs import Quadratic


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Coefficients ``c2, c1, c0`` and ``n`` of the least-squares parabola of ``y`` on ``x``.

    One scan finds the mean, spread and ends of ``x``; a second, in the same job, gathers the
    moments of the scaled ``z``, its square and ``y``, which stay well apart however far ``x``
    lies from 0. Both combine map-side. Coefficients are NULL with fewer than three distinct ``x``.
    """
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    place = pairs.agg(
        F.struct(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ).scalar()
    mean, spread = F.col("mean"), F.col("spread")
    placed = pairs.withColumn("_p", place).withColumns(
        {
            "mean": F.coalesce("_p.mean", F.lit(0.0)),
            "spread": F.coalesce(F.nullif("_p.spread", F.lit(0.0)), F.lit(1.0)),
            "third": (F.col("x") > F.col("_p.lo")) & (F.col("x") < F.col("_p.hi")),
        }
    )
    z = (F.col("x") - mean) / spread
    moments = placed.select("mean", "spread", "third", z.alias("a"), (z * z).alias("b"), "y").agg(
        F.count("*").alias("n"), F.max("third").alias("third"),
        F.max("mean").alias("mean"), F.max("spread").alias("spread"),
        F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.avg("y").alias("my"),
        F.var_pop("a").alias("aa"), F.var_pop("b").alias("bb"),
        F.covar_pop("a", "b").alias("ab"),
        F.covar_pop("a", "y").alias("ay"), F.covar_pop("b", "y").alias("by"),
    )
    det = F.expr("aa * bb - ab * ab")
    solvable = F.col("third") & (det > 0)
    shift = mean / spread
    return (
        moments.withColumn("d2", F.when(solvable, F.expr("by * aa - ay * ab") / det))
        .withColumn("d1", F.when(solvable, F.expr("ay * bb - by * ab") / det))
        .withColumn("d0", F.expr("my - d2 * mb - d1 * ma"))
        .select(
            (F.col("d2") / (spread * spread)).alias("c2"),
            ((F.col("d1") - 2 * shift * F.col("d2")) / spread).alias("c1"),
            (F.col("d0") - shift * F.col("d1") + shift * shift * F.col("d2")).alias("c0"),
            "n",
        )
    )


def fitted_cost(fit: DataFrame) -> Quadratic:
    """The cost model of a fit's single row."""
    row = fit.first()
    if row is None or row["c2"] is None:
        raise ValueError("a parabola needs three distinct sizes")
    return Quadratic(row["c2"], row["c1"], row["c0"])
