"""Column functions against golden values and stated deviations."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import arrays, costs, names, sizes, text
from tallyloom.operators import dimensions, fit, progress


def column(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, c {type_}")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("c"))).collect()]


def test_jobname(spark):
    given = [" A5A624 ", "My_Prot 1", "x/y:z", "v1.2", "a\tb", " É½ⅷª\t", "", None]
    expected = ["a5a624", "my-prot-1", "xyz", "v1.2", "ab", "é½ⅷª", "", None]
    assert column(spark, given, names.jobname) == expected


def test_accession_header(spark):
    given = [">sp|P38013|AHP1 x", ">plain", "MK|LV"]
    assert column(spark, given, names.accession_header) == [">P38013", ">", "MK|LV"]


def test_paths(spark):
    assert column(spark, ["a"], lambda c: names.filled("p/{id}/{id}_m.gz", c)) == ["p/a/a_m.gz"]
    given = ["/x/T1050.fasta", "/x/a.b.fasta", "q", "https://h/p/825?page=2"]
    assert column(spark, given, names.record_name) == ["T1050", "a.b", "q", "825?page=2"]
    strip = lambda c: names.without_prefix(c, "run_")
    assert column(spark, ["run_v100", "v100", "xrun_"], strip) == ["v100", "v100", "xrun_"]


def test_id_is_valid(spark):
    given = ["a-b_c.1", "é", "a b", "a/b", ""]
    assert column(spark, given, names.id_is_valid) == [True, True, False, False, True]


def test_chain_letters_go_on_after_the_alphabet(spark):
    given = [0, 1, 24, 25, 50, 700, 701, 18_276, 18_277, -1, None]
    expected = ["B", "C", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ", "AAAA", None, None]
    assert column(spark, given, names.chain_letter, "int") == expected


def test_chain_ids_are_always_a_list(spark):
    given = ['"A"', '"AB"', '["A","B"]']
    found = column(spark, given, lambda c: sizes.chain_ids(F.parse_json(c)))
    assert found == [["A"], ["AB"], ["A", "B"]]


def test_window_is_half_open(spark):
    check = lambda c: sizes.in_window(c, fixed.BATCH_WINDOW)
    assert column(spark, [16, 17, 6000, 6001], check, "bigint") == [False, True, True, False]


def test_predicted_seconds(spark):
    given = [68, 381, 360, 741, 596, 17, 409, 6000]
    expected = [46.4765, 29.7615, 29.9972, 45.5342, 34.6780, 51.8817, 29.6454, 4544.5326]
    found = column(spark, given, costs.Quadratic().seconds, "bigint")
    assert found == pytest.approx(expected, abs=1e-4)
    assert column(spark, [6000], costs.Quadratic(), "bigint") == pytest.approx([1.262370], abs=1e-6)


def test_model_confidence(spark):
    df = spark.createDataFrame([(0.5, 1.0)], "iptm double, ptm double")
    assert df.select(costs.model_confidence(F.col("iptm"), F.col("ptm"))).first()[0] == (
        pytest.approx(0.6)
    )


LOG = [
    "w x y z Calculating bucket size for input with 100 tokens.",
    "Running model inference and extracting output structures for seeds (4,) took 12.5 seconds.",
    "Running model inference and extracting output structures for seeds (5,) took 12.5 seconds.",
    "Running model inference and extracting output structures for seeds (4,) took 1e1 seconds.",
    "Done processing fold input aa.",
    "Done processing fold input aa",
    "x Done processing fold input aa.",
]


def test_log_captures_take_whole_lines(spark):
    captures = ["n_tokens", "runtime_sec", "done_processing"]
    found = [column(spark, LOG, lambda c, k=k: text.log_captures(c)[k]) for k in captures]
    assert found[0] == [100, None, None, None, None, None, None]
    assert found[1] == [None, 12.5, None, 10.0, None, None, None]
    assert found[2] == [None, None, None, None, "aa", None, None]


def test_line_predicates(spark):
    assert column(spark, ["MKV", ">a", "M1", ""], text.is_residue_line) == [True, False, False, True]
    assert column(spark, ["Wall-clock: 1", "wall"], text.has_marker) == [True, False]


def test_display(spark):
    assert column(spark, [1234567, 12], text.thousands, "bigint") == ["1,234,567", "12"]
    assert column(spark, [0.12345, None], text.percent, "double") == ["(12.35%)", None]


def test_arrays(spark):
    cube = [[[1.0, 2.0], [3.0, 4.0]]]
    at = lambda *i: lambda c: arrays.at(c, *i)
    type_ = "array<array<array<double>>>"
    assert column(spark, [cube], at(0, 1, 0), type_) == [3.0]
    assert column(spark, [cube], at(0, 5), type_) == [None]
    ids = list(range(30))
    assert column(spark, [ids], lambda c: arrays.cut(c, 10, 1000), "array<int>") == [ids[10:1000]]
    assert column(spark, [ids], lambda c: arrays.cut(c, 40, 50), "array<int>") == [[]]


def tiers(spark, given, rules, kind=None):
    expression = lambda c: dimensions.tier_of(c, rules, kind)
    found = column(spark, given, expression, "bigint")
    return [r and (r["runtime"], r["gpu_mem"]) for r in found]


def test_tiers_a(spark):
    found = tiers(spark, [76, 199, 200, 779, 1246, 1499, 1500, 2499, 2500, 3499, 3500], fixed.TIERS_A)
    a, b, c, d, e = [
        ("04:00", "10240"), ("24:00", "20240"), ("24:00", "40000"), ("48:00", "80000"),
        ("120:00", "80000"),
    ]
    assert found == [a, a, b, b, b, b, c, c, d, d, e]


def test_tiers_b(spark):
    single = tiers(spark, [76, 500, 501, 779, 2500, 2501], fixed.TIERS_B, F.lit("monomer"))
    a, b, c = ("04:00:00", "11g"), ("24:00:00", "24g"), ("48:00:00", "40g")
    assert single == [a, a, b, b, b, c]
    many = tiers(spark, [999, 1000, 1246, 2500, 2501], fixed.TIERS_B, F.lit("multimer"))
    d, e = ("48:00:00", "24g"), ("120:00:00", "80g")
    assert many == [None, d, d, d, e]


def test_ladder_ends(spark):
    df = spark.createDataFrame(
        [("pipeline", 1), ("pipeline", 4), ("pipeline", 5), ("prediction", 5), ("multimer", 3),
         ("multimer", 4), ("other", 1)],
        "step string, attempt int",
    )
    found = {
        (r["step"], r["attempt"]): (r["runtime"], r["mem_mb"], r["gpu_mem"], r["exhausted"])
        for r in dimensions.with_ladder(df).collect()
    }
    assert found == {
        ("pipeline", 1): ("4h", 65536, None, False),
        ("pipeline", 4): ("1w", 262144, None, False),
        ("pipeline", 5): (None, None, None, True),
        ("prediction", 5): ("3d", 98304, "80g", False),
        ("multimer", 3): ("4h", 65536, "80g", False),
        ("multimer", 4): (None, None, None, True),
        ("other", 1): (None, None, None, True),
    }


def test_variants(spark, rows):
    df = dimensions.per_variant(spark.createDataFrame([("x",)], "id string"))
    assert len(rows(df)) == 8 and ("x", "v100") in rows(df)


def test_shares_in_one_pass(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True)], "a boolean, b boolean")
    queries = {"one": "a", "both": "a & b", "only": "a & ~b"}
    found = {r["step"]: (r["n"], r["total"], r["text"]) for r in progress.shares(df, queries).collect()}
    assert found["one"] == (2, 3, "2 of 3 (66.67%)")
    assert found["both"][0] == 1 and found["only"][0] == 1
    empty = progress.shares(df.where("false"), {"one": "a"}).first()
    assert (empty["n"], empty["share"], empty["text"]) == (0, None, "0 of 0")


def test_outcome(spark):
    df = spark.createDataFrame(
        [(10, False, True), (7000, False, False), (100, True, False), (100, False, True),
         (100, False, False)],
        "n bigint, done boolean, failed boolean",
    )
    why = progress.outcome(F.col("n"), F.col("done"), F.col("failed"))
    assert [r[0] for r in df.select(why).collect()] == [
        "too_small", "too_large", "done", "failed", "pending",
    ]


def test_fit_agrees_with_polyfit_and_the_normal_solver(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(1)
    x = rng.integers(17, 6000, 3000)
    y = 1.4e-4 * x**2 - 0.12 * x + 54 + rng.normal(0, 5, 3000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(x, y, strict=True)], "x bigint, y double")
    row = fit.quadratic_fit(df, "x", "y").first()
    assert row["n"] == 3000
    assert [row["c2"], row["c1"], row["c0"]] == pytest.approx(np.polyfit(x, y, 2), rel=1e-8)
    features = VectorAssembler(inputCols=["x", "xx"], outputCol="features").transform(
        df.withColumn("xx", F.col("x") * F.col("x"))
    )
    model = LinearRegression(solver="normal", labelCol="y").fit(features)
    assert [model.coefficients[1], model.coefficients[0], model.intercept] == pytest.approx(
        [row["c2"], row["c1"], row["c0"]], rel=1e-6
    )
    cost = fit.fitted_cost(fit.quadratic_fit(df, "x", "y"))
    assert math.isclose(cost.c2, row["c2"])


def test_fit_needs_three_sizes(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 3.0)], "x bigint, y double")
    assert fit.quadratic_fit(df, "x", "y").first()["c2"] is None
    with pytest.raises(ValueError):
        fit.fitted_cost(fit.quadratic_fit(df, "x", "y"))


def test_fit_far_from_zero(spark):
    import numpy as np

    from tallyloom.operators.fit import quadratic_fit

    for x in (np.arange(1e8, 1e8 + 1000), 1e6 + np.arange(5.0)):
        y = 1e-4 * (x - x[0]) ** 2 + 0.5 * (x - x[0]) + 3
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "x double, y double")
        got = quadratic_fit(df, "x", "y").first()
        assert abs(got.c2 - 1e-4) < 1e-10
    few = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (2.0, 4.0)], "x double, y double")
    assert quadratic_fit(few, "x", "y").first().c2 is None


def test_flags_leave_literals_alone(spark):
    from tallyloom.operators.progress import flag

    df = spark.createDataFrame([(True, "x&y"), (True, "xy")], "a boolean, s string")
    assert df.where(flag("a & ~(s = 'xy') & s = 'x&y'")).count() == 1
