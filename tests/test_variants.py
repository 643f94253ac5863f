"""Variants of the queries are the rows of the region table, whatever they are."""

from tallyloom.plans import load_all
from tallyloom.plans.registry import QUERIES


def test_variants_follow_the_region_table(spark, tmp_path, rows):
    load_all()
    spark.createDataFrame([(7, "ATLANTIS"), (0, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(1, 500.0), (2, 8000.0)], "s_suppkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    got = rows(QUERIES["variant_scores"](spark, str(tmp_path)))
    assert got == [("ASIA", 1, True, 500.0), ("ASIA", 2, True, 8000.0), ("ATLANTIS", 1, False, None), ("ATLANTIS", 2, True, 8000.0)]
    got = rows(QUERIES["variant_cross"](spark, str(tmp_path)))
    assert [r[:2] for r in got] == [(1, "ASIA"), (1, "ATLANTIS"), (2, "ASIA"), (2, "ATLANTIS")]
    spark.createDataFrame([], "r_regionkey int, r_name string").write.mode("overwrite").parquet(f"{tmp_path}/region.parquet")
    assert QUERIES["variant_cross"](spark, str(tmp_path)).count() == 0
