"""The chance that a pair at the threshold is lost, and filters that must lose none."""

from math import comb

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import components, minhash_join
from tallyloom.llm.minhash_join import COORDINATES, MATCHES, agreements, alike, differing, merged, signature, sketch


def test_no_more_links_are_lost_than_at_half_of_64():
    def missed(n, least):
        return sum(comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(least))

    assert missed(COORDINATES, MATCHES) < missed(64, 32)


def test_sketches_and_bitmaps_bound_what_they_stand_for(spark):
    rng = np.random.default_rng(5)
    rows, truth = [], []
    for size in (1, 3, 60, 700, 5000):
        for common in (0.0, 0.5, 0.8, 1.0):
            one = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            new = rng.integers(0, 1 << 64, size - int(common * size), dtype=np.uint64)
            other = np.unique(np.concatenate([one[: int(common * size)], new]))
            mine, theirs = signature(one), signature(other)
            rows.append((len(rows), sketch(mine, one), sketch(theirs, other)))
            truth.append((len(set(mine) & set(theirs)), len(np.setxor1d(one, other))))
    pairs = spark.createDataFrame(rows, "i int, x array<long>, y array<long>")
    for r in pairs.select("i", agreements("x", "y").alias("agree"), differing("x", "y").alias("apart")).collect():
        assert r.agree >= truth[r.i][0] and r.apart <= truth[r.i][1]


def test_a_list_of_unlike_documents_is_used_up_in_few_rounds(spark, monkeypatch):
    base = " ".join(f"common{i}" for i in range(255))
    texts = [f"{base} " + " ".join(f"own{d}x{i}" for i in range(45)) for d in range(120)]
    texts.append(f"{texts[7]} more")
    labels = []
    keep = minhash_join.written
    monkeypatch.setattr(minhash_join, "written", lambda df, label: (labels.append(label), keep(df, label))[1])
    got = minhash_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {**{d: d for d in range(120)}, 120: 7}
    assert labels.count("compared") <= 4  # twice as many leaders each round: 6


def test_lists_give_each_pair_once_and_lose_none(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    rows = []
    for place in range(1, 41):
        own = np.unique(np.concatenate([base[: rng.integers(200, 300)], rng.integers(0, 1 << 64, 30, dtype=np.uint64)]))
        bits = sketch(signature(own), own)
        rows += [(posting, 1000 + place, place % 17, len(own), bits, place) for posting in (3, 5, 8)]
    schema = "posting long, rep long, root long, n long, sketch array<long>, place int"
    rest = spark.createDataFrame(rows, schema).repartition(1)
    low = rest.where("place <= 9").select("posting", "rep", "root", "n", "sketch", "place")
    low = low.toDF("posting", "leader", "of", "ln", "ls", "lead")
    pairs = rest.join(low, "posting").where((F.col("root") != F.col("of")) & (F.col("lead") < F.col("place")) & alike(75))
    pairs = pairs.select("leader", "rep", agreements("sketch", "ls").alias("agree"))
    wanted = {tuple(r) for r in pairs.distinct().collect()}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # lists pass in several batches
    try:
        got = [tuple(r) for r in merged(rest, 9, 75).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(wanted) > 20 and set(got) == wanted
    assert len(got) < pairs.count()


def test_components_of_stars_need_one_round(spark, monkeypatch):
    made = []
    keep = components.written
    monkeypatch.setattr(components, "written", lambda df, label: (made.append(label), keep(df, label))[1])
    links = spark.createDataFrame([(1, n) for n in range(2, 9)], "a long, b long")
    assert {tuple(r) for r in components.contracted(links).collect()} == {(n, 1) for n in range(1, 9)}
    assert components.contracted(links.where("a > 1")).isEmpty()
    assert len(made) == 2  # the links of each call
