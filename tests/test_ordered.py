"""Ordered operators agree with brute force, with and without hot groups."""

import itertools
import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import events
from tallyloom.operators.batching import assign_batches, batch_summary, equal_effort
from tallyloom.operators.ordered import by_size, cost_share, previous_value, running_sum, slices
from tallyloom.operators.skew import hot_keys, lookup_join

# One key holds a third of all rows.
HOT = 50


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(7)
    rows = []
    for n in range(900):
        key = 1 if n % 3 == 0 else (None if n % 7 == 0 else rng.randrange(2, 60))
        rows.append((key, n, rng.choice("abc"), rng.randrange(100)))
    rng.shuffle(rows)
    return rows


def frame(spark, samples):
    return spark.createDataFrame(samples, "key int, t int, state string, v bigint")


def by_key(samples):
    ordered = sorted(samples, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return itertools.groupby(ordered, key=lambda r: r[0])


@pytest.mark.parametrize("hot_rows", [HOT, 10_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sum_per_key(spark, samples, hot_rows, inclusive):
    expected = {}
    for _, group in by_key(samples):
        total = 0
        for _, t, _, v in group:
            expected[t] = total + v if inclusive else total
            total += v
    df = running_sum(
        frame(spark, samples), F.col("v"), ["t"], "s", ["key"], inclusive, hot_rows=hot_rows
    )
    assert {r["t"]: r["s"] for r in df.collect()} == expected


def test_running_sum_of_a_whole_table(spark, samples):
    df = running_sum(frame(spark, samples), F.col("v"), ["t"], "s", hot_rows=HOT)
    expected = dict(enumerate(itertools.accumulate(r[3] for r in sorted(samples, key=lambda r: r[1]))))
    assert {r["t"]: r["s"] for r in df.collect()} == expected


@pytest.mark.parametrize("hot_rows", [HOT, 10_000])
def test_previous_value(spark, samples, hot_rows):
    expected = {}
    for _, group in by_key(samples):
        last = None
        for _, t, state, _ in group:
            expected[t] = last
            last = state
    df = previous_value(frame(spark, samples), "state", ["t"], ["key"], "p", hot_rows)
    found = {r["t"]: r["p"] and r["p"]["value"] for r in df.collect()}
    assert found == expected


@pytest.mark.parametrize("hot_rows", [HOT, 10_000])
def test_changes_only(spark, samples, hot_rows):
    expected = set()
    for _, group in by_key(samples):
        last = object()
        for _, t, state, _ in group:
            if state != last:
                expected.add(t)
            last = state
    df = events.changes_only(frame(spark, samples), "state", ["key"], ["t"], hot_rows)
    assert {r["t"] for r in df.collect()} == expected


def test_changes_only_golden(spark, rows):
    """A null is a value like any other, and groups do not see each other."""
    df = spark.createDataFrame(
        [(1, 1, 0), (1, 2, 0), (1, 3, 5), (2, 1, 3), (2, 2, 3), (3, 1, None), (3, 2, None), (3, 3, 1)],
        "key int, t int, v int",
    )
    found = rows(events.changes_only(df, "v", ["key"], ["t"]))
    assert found == [(1, 1, 0), (1, 3, 5), (2, 1, 3), (3, 1, None), (3, 3, 1)]


def brute_events(lines):
    """Walk ordered lines; later captures overwrite, a done emits and clears."""
    seen, out = {}, []
    for size, runtime, done in lines:
        if size is not None:
            seen["size"] = size
        if runtime is not None:
            seen["runtime"] = runtime
        if done is not None:
            out.append((seen.get("size"), seen.get("runtime"), done))
            seen = {}
    return out


@pytest.mark.parametrize("hot_rows", [HOT, 10_000])
def test_assemble_events(spark, samples, rows, hot_rows):
    def captures(t, state, v):
        return (
            v if state == "a" else None, float(v) if state == "b" else None,
            f"d{t}" if state == "c" and v < 60 else None,
        )

    expected = []
    for key, group in by_key(samples):
        lines = [captures(t, state, v) for _, t, state, v in group]
        expected += [(key, *e) for e in brute_events(lines)]
    captured = spark.createDataFrame(
        [(key, t, *captures(t, state, v)) for key, t, state, v in samples],
        "key int, t int, size bigint, runtime double, done string",
    )
    df = events.assemble_events(captured, ["key"], ["t"], ["size", "runtime"], "done", hot_rows)
    assert rows(df, "key", "size", "runtime", "done") == sorted(expected, key=repr)
    for r in df.collect():
        assert r["complete"] == (r["size"] is not None and r["runtime"] is not None)


def test_slices_follow_each_other(spark, samples):
    df = slices(frame(spark, samples), ["t"], 100).groupBy("_slice").agg(
        F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("n")
    )
    found = sorted(df.collect(), key=lambda r: r["_slice"])
    assert len(found) >= 9 and sum(r["n"] for r in found) == 900
    for a, b in itertools.pairwise(found):
        assert a["hi"] < b["lo"]


SIZES = [17, 17, 17, 17, 17, 400, 409, 2000, 5999, 6000, 300, 300]


def sized(spark, sizes):
    return spark.createDataFrame([(f"p{n:03}", s) for n, s in enumerate(sizes)], "id string, tokens bigint")


@pytest.mark.parametrize("limits", [{}, {"partitions": 1}, {"partitions": 5}])
def test_by_size_is_the_sorted_order(spark, limits):
    df = by_size(sized(spark, SIZES), "tokens", "id", F.col("tokens") / 2, **limits)
    found = sorted(df.collect(), key=lambda r: r["pos"])
    expected = sorted((s, f"p{n:03}") for n, s in enumerate(SIZES))
    assert [(r["tokens"], r["id"]) for r in found] == expected
    assert [r["pos"] for r in found] == list(range(len(SIZES)))
    sums = np.cumsum([s / 2 for s, _ in expected])
    assert [float(r["weight_cumsum"]) for r in found] == sums.tolist()


def test_sums_are_exact_however_rows_are_spread(spark, rows):
    """No digit depends on the number of slices, nor on how many sizes there are."""
    rng = random.Random(9)
    sizes = [rng.choice([500, rng.randrange(17, 6001), rng.randrange(10**9)]) for _ in range(400)]
    df = sized(spark, [*sizes, None, None])
    found = [
        sorted((r["id"], r["pos"], r["weight_cumsum"]) for r in by_size(
            df, "tokens", "id", F.col("tokens") / 7, partitions=n).collect())
        for n in (1, 3, 7)
    ]
    assert found[0] == found[1] == found[2]
    exact, total = {}, Decimal(0)
    for n in sorted(range(402), key=lambda n: (n < 400, n < 400 and sizes[n], n)):
        total += Decimal(repr(sizes[n] / 7)).quantize(Decimal(10) ** -12, ROUND_HALF_UP) if n < 400 else 0
        exact[f"p{n:03}"] = total
    assert {i: s for i, _, s in found[0]} == exact
    plans = []
    for n in (1, 3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            plans.append(rows(assign_batches(df.where("tokens < 7000"))))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert plans[0] == plans[1] == plans[2]


def test_running_costs_on_the_edge_of_a_batch(spark):
    """Sixty rows of a tenth of an hour are six whole hours, two batches and one row over."""

    def tenth(size):
        return F.lit(0.1)

    plan = assign_batches(sized(spark, [100] * 60), cost=tenth, hours=3).orderBy("pos").collect()
    assert [r["batch_id"] for r in plan] == [0] * 29 + [1] * 30 + [2]
    assert plan[-1]["weight_cumsum"] == 6.0


def test_planning_reads_its_input_once(spark):
    """While the plan is built, jobs sample range bounds, shuffle by them and write the order;
    nothing is counted or collected."""
    counter = spark.sparkContext
    counter.setJobGroup("plan", "plan")
    try:
        plan = assign_batches(sized(spark, SIZES))
        jobs = len(counter.statusTracker().getJobIdsForGroup("plan"))
    finally:
        counter.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 and plan.count() == len(SIZES)


def test_a_share_of_cost(spark):
    df = spark.createDataFrame([(3, 0.25), (1, 0.5), (1, 0.5), (2, 1.0)], "k int, c double")
    found = cost_share(df, "k", F.col("c")).orderBy("k").collect()
    assert [(r.k, float(r.before), float(r.cost), float(r.total)) for r in found] == [
        (1, 0.0, 1.0, 2.25), (2, 1.0, 1.0, 2.25), (3, 2.0, 0.25, 2.25),
    ]


@pytest.mark.parametrize("limits", [{}, {"partitions": 9}])
@pytest.mark.parametrize("hours", [1, 3, 1.5])
def test_batches_keep_every_row_once_in_size_order(spark, limits, hours):
    rng = random.Random(3)
    sizes = [rng.choice([500, rng.randrange(17, 6001)]) for _ in range(600)]
    plan = assign_batches(sized(spark, sizes), hours=hours, **limits)
    found = sorted(plan.collect(), key=lambda r: r["pos"])
    assert sorted(r["id"] for r in found) == [f"p{n:03}" for n in range(600)]
    assert [r["tokens"] for r in found] == sorted(sizes)
    ids = [r["batch_id"] for r in found]
    assert ids == sorted(ids)
    assert ids == [int(int(r["weight_cumsum"]) // hours) for r in found]
    total = sum(r["predicted_runtime"] for r in batch_summary(plan).collect())
    assert total == pytest.approx(sum(r["weight"] for r in found))


def test_a_popular_size_changes_no_digit(spark, rows):
    rng = random.Random(4)
    df = sized(spark, [rng.choice([500, rng.randrange(17, 6001)]) for _ in range(500)])
    assert rows(assign_batches(df, partitions=20)) == rows(assign_batches(df))


def test_batch_ids_skip_where_one_row_costs_more(spark):
    plan = assign_batches(sized(spark, [6000] * 4), hours=1)
    assert [r["batch_id"] for r in plan.orderBy("pos").collect()] == [1, 2, 3, 5]


@pytest.mark.parametrize("limits", [{}, {"partitions": 11}])
@pytest.mark.parametrize("splits", [4, 20, 200])
def test_equal_effort_is_cut_and_rank(spark, splits, limits):
    rng = random.Random(5)
    sizes = sorted(int(rng.lognormvariate(6, 1)) + 1 for _ in range(500))
    weight = pd.Series(sizes) ** 2
    weight = weight / weight.sum()
    expected = pd.cut(weight.cumsum(), bins=splits, labels=False).rank().astype(int).tolist()
    df = equal_effort(sized(spark, sizes), splits=splits, **limits)
    found = [r["batch_id"] for r in df.orderBy("tokens", "id").collect()]
    assert found == expected


def test_hot_keys_and_salted_lookup(spark, samples, rows):
    left = frame(spark, samples)
    hot = hot_keys(left, ["key"], HOT)
    assert {(r["key"], r["_n"]) for r in hot.collect()} >= {(1, 300)}
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40)], "key int, name string")
    plain = rows(left.join(right, "key", "left"), "key", "t", "name")
    salted = lookup_join(left, right, "key", ["t"], hot_rows=HOT)
    assert rows(salted, "key", "t", "name") == plain
    inner = lookup_join(left, right, "key", ["t"], "inner", hot_rows=HOT)
    assert rows(inner, "key", "t", "name") == [r for r in plain if r[2] is not None]


def test_first_wins(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("a", 4)], "k string, pos int")
    assert rows(events.first_wins(df, "k", "pos")) == [
        ("a", 1, True), ("a", 3, False), ("a", 4, False), ("b", 2, True),
    ]
