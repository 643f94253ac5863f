"""Counts, shares and stage funnels."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.sizes import in_window
from tallyloom.functions.text import percent, thousands


_LITERAL = re.compile("('(?:[^']|'')*')")


def flag(expression: str) -> Column:
    """A flag expression over columns; ``&``, ``|`` and ``~`` read as and, or, not, but not
    inside a string literal."""
    words = {"&": " and ", "|": " or ", "~": " not "}
    parts = _LITERAL.split(expression)
    parts[::2] = ["".join(words.get(c, c) for c in part) for part in parts[::2]]
    return F.expr("".join(parts))


def shares(df: DataFrame, queries: dict[str, str]) -> DataFrame:
    """For each named flag expression: matching rows, all rows, share and display text.

    One pass over ``df``; the share of an empty frame is NULL.
    """
    counted = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(flag(q)).alias(f"q{i}") for i, q in enumerate(queries.values())],
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("step"), F.col(f"q{i}").alias("n"))
            for i, name in enumerate(queries)
        ]
    )
    share = F.try_divide("n", "total")
    return (
        counted.select("total", F.inline(rows))
        .select("step", "n", "total", share.alias("share"))
        .withColumn(
            "text",
            F.concat(
                thousands(F.col("n")), F.lit(" of "), thousands(F.col("total")),
                F.coalesce(F.concat(F.lit(" "), percent(F.col("share"))), F.lit("")),
            ),
        )
    )


def stage_flags(artifacts: DataFrame, stages: list[str]) -> DataFrame:
    """One row per id with a boolean per stage, from ``artifacts(kind, id)``."""
    return artifacts.groupBy("id").agg(
        *[F.bool_or(F.col("kind") == s).alias(s) for s in stages]
    )


def funnel(flags: DataFrame, stages: list[str]) -> DataFrame:
    """Per stage: ids that reached it, and ids that reached the stage before but not it."""
    counts, before = [], None
    for s in stages:
        counts.append(F.count_if(F.col(s)).alias(f"n_{s}"))
        lost = F.lit(False) if before is None else F.col(before) & ~F.col(s)
        counts.append(F.count_if(lost).alias(f"lost_{s}"))
        before = s
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(s).alias("stage"),
                F.col(f"n_{s}").alias("n"), F.col(f"lost_{s}").alias("missing"),
            )
            for i, s in enumerate(stages)
        ]
    )
    return flags.agg(*counts).select(F.inline(rows))


def missing_between(flags: DataFrame, stages: list[str]) -> DataFrame:
    """The ids that stop before the last stage, with the first stage they lack."""
    lacking = F.coalesce(*[F.when(~F.col(s), F.lit(s)) for s in stages])
    return flags.select("id", lacking.alias("missing_stage")).where("missing_stage is not null")


def outcome(
    size: Column,
    done: Column,
    failed: Column,
    window: tuple[int, int] = fixed.BATCH_WINDOW,
) -> Column:
    """Why an id has no result: its size, a recorded failure, or not yet run."""
    lo, hi = window
    return (
        F.when(done, "done")
        .when(size <= lo, "too_small")
        .when(size > hi, "too_large")
        .when(in_window(size, window) & failed, "failed")
        .otherwise("pending")
    )
