"""Scorers see whole batches, are made once per task, and errors stay with their row."""

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyloom.functions.costs import Quadratic
from tallyloom.operators.batching import assign_batches, batch_members, in_size_order, member_chunks
from tallyloom.operators.scoring import _batches, run_each, score_all, score_batches

SCHEMA = "id bigint, batch_id bigint, made bigint, seen bigint"


def load():
    made = id(object())

    def score(batch):
        assert batch["tokens"].is_monotonic_increasing
        return batch.assign(made=made, seen=len(batch))[["id", "batch_id", "made", "seen"]]

    return score


def plan(spark):
    return spark.range(1000).select(
        "id", (F.col("id") % 97).alias("tokens"), F.floor(F.col("id") / 60).alias("batch_id")
    )


def test_score_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = score_batches(plan(spark), load, SCHEMA, partitions=3).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(found["id"]) == list(range(1000))
    assert (found["seen"] == found.groupby("batch_id")["id"].transform("size")).all()
    assert found.groupby("batch_id")["made"].nunique().max() == 1


def test_score_all(spark):
    found = score_all(plan(spark), load, SCHEMA, partitions=3).toPandas()
    assert sorted(found["id"]) == list(range(1000))


def test_scoring_keeps_its_tasks(spark):
    """Adaptive execution merges small shuffles, but not these."""
    for scored in (
        score_batches(plan(spark), load, SCHEMA, partitions=5),
        score_all(plan(spark), load, SCHEMA, partitions=5),
        run_each(plan(spark), lambda: lambda row: 1.0, partitions=5),
    ):
        assert scored.rdd.getNumPartitions() == 5


def test_tasks_have_like_costs(spark):
    """No task of eight has 1.3 times the mean hours, though sizes are skewed and one is popular."""
    cost = Quadratic()
    sizes = [17 + (n * n) % 5000 if n % 3 else 2500 for n in range(6000)]
    df = spark.createDataFrame([(n, s) for n, s in enumerate(sizes)], "id long, tokens long")
    schema = "id long, batch_id long, task int, tokens long"

    def numbered():
        task = TaskContext.get().partitionId()
        return lambda rows: rows.assign(task=task)[["id", "batch_id", "task", "tokens"]]

    for scored in (
        score_batches(assign_batches(df, cost, 0.5).select("id", "tokens", "batch_id"), numbered, schema, 8),
        score_all(df.withColumn("batch_id", F.lit(0)), numbered, schema, partitions=8),
    ):
        found = scored.toPandas()
        assert sorted(found["id"]) == list(range(6000)) and scored.rdd.getNumPartitions() == 8
        n = found["tokens"].astype(float)
        hours = ((cost.c2 * n + cost.c1) * n + cost.c0).groupby(found["task"]).sum()
        assert len(hours) == 8 and hours.max() < 1.3 * hours.mean()
        if found["batch_id"].max():
            assert (found.groupby("batch_id")["task"].nunique() == 1).all()


def test_chunks_regroup():
    frames = [pd.DataFrame({"b": b}) for b in ([0, 0], [0, 1], [1], [2, 3])]
    assert [f["b"].tolist() for f in _batches(iter(frames), "b")] == [[0, 0, 0], [1, 1], [2], [3]]


def test_run_each_keeps_errors(spark, rows):
    def load_step():
        return lambda row: 10.0 / row["x"]

    df = spark.createDataFrame([(1, 2), (2, 0)], "id int, x int")
    assert rows(run_each(df, load_step)) == [
        (1, 2, 5.0, None), (2, 0, None, "ZeroDivisionError: float division by zero"),
    ]


def test_member_chunks_follow_each_other(spark):
    cheap = Quadratic(0.0, 0.0, 0.001)
    assigned = assign_batches(spark.range(1000).select("id", F.lit(7).alias("tokens")), cheap, 1)
    chunks = sorted(tuple(r) for r in member_chunks(assigned, 64).collect())
    assert [c[:2] for c in chunks] == [(0, i) for i in range(16)]
    assert [m for c in chunks for m in c[3]] == [str(i) for i in range(1000)]


def test_costs_bound_batches(spark):
    free = assign_batches(spark.range(3).select("id", F.lit(7).alias("tokens")), Quadratic(0.0, 0.0, 0.0), 1)
    with pytest.raises(Exception, match="cost of 0 or less for size 7"):
        free.collect()


def test_members_and_layout(spark):
    small = spark.createDataFrame(
        [("b", 5, 0), ("a", 5, 0), ("c", 2, 0), ("d", 9, 3)], "id string, tokens int, batch_id bigint"
    )
    found = {r["batch_id"]: r["members"] for r in batch_members(small).collect()}
    assert found == {0: ["c", "a", "b"], 3: ["d"]}
    laid = in_size_order(small, 1).collect()
    assert [r["id"] for r in laid] == ["c", "a", "b", "d"]


def test_each_keeps_large_integers_beside_null(spark, rows):
    df = spark.createDataFrame([(2**53 + 1, 1), (None, 2)], "id long, k int")
    got = run_each(df, lambda: lambda row: float(row["k"]))
    assert rows(got) == [(2**53 + 1, 1, 1.0, None), (None, 2, 2.0, None)]
