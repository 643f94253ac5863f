"""The class models against their formulas written out, and held-out accuracy."""

import zlib

import duckdb
import numpy as np
import pytest

from tallyloom.llm import toxicity
from tallyloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, score string, toxic int"
LABELS = "doc_id long, quality int, toxic int"


def test_models_equal_the_formulas(spark, monkeypatch):
    texts = [("you foul thing go", True), ("foul you go away", True), ("you go on and on", False), ("a b c you go", False)] * 30
    texts += [(f"x{i} y{i % 7} fine", False) for i in range(200)]
    texts += [(f"x{i} z{i % 5} x{i + 1}", False) for i in range(200)] + [(f"x{i} foul", True) for i in range(60)]
    model = toxicity.fitted(spark.createDataFrame(texts, "text string, toxic boolean").repartition(3))
    words = sorted({int(h) for t, _ in texts for h in toxicity.hashes(t)})
    kept_words = [w for w in words if sum((w in toxicity.hashes(t)) for t, _ in texts) >= 2]
    assert model.words.tolist() == kept_words
    size = len(kept_words) + 2
    mapped = [{}, {}]
    for text, toxic in texts:
        ids = toxicity.numbered(toxicity.hashes(text), np.array(kept_words))
        for pair in {*zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True)}:
            mapped[not toxic][pair] = mapped[not toxic].get(pair, 0) + 1
    types = [[sum(1 for _, w in mapped[c] if w == i) for i in range(size)] for c in (0, 1)]
    either = [sum(1 for p in {*mapped[0], *mapped[1]} if p[1] == i) for i in range(size)]
    shared = [(e + 1) / (sum(either) + size) for e in either]
    share = sum(types[0]) / (sum(types[0]) + sum(types[1]))
    single = [[], []]
    telling = [
        float(toxicity.evidence(np.array(types[0][i]), np.array(types[0][i] + types[1][i]), share)) >= toxicity.EVIDENCE
        for i in range(size)
    ]
    assert any(telling)
    for c in (0, 1):
        ones, twos = types[c].count(1), types[c].count(2)
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        total = sum(types[c])
        spared = d * sum(1 for t in types[c] if t) / total
        own = [max(t - d, 0) / total + spared * s for t, s in zip(types[c], shared, strict=True)]
        rest = (1 - sum(o for o, t in zip(own, telling, strict=True) if t)) / (1 - sum(s for s, t in zip(shared, telling, strict=True) if t))
        single[c] = [o if t else rest * s for o, s, t in zip(own, shared, telling, strict=True)]
        assert sum(single[c]) == pytest.approx(1)
    np.testing.assert_allclose(model.ratio, np.log(single[0]) - np.log(single[1]), rtol=1e-9, atol=1e-12)
    assert {divmod(p, size)[1] for p in model.pairs.tolist()} <= set(range(size))


def test_classes_may_change_places():
    """Ratios change their sign where the classes change places."""
    rng = np.random.default_rng(4)
    words, size = np.arange(10), 12
    table = rng.poisson(3, (2, size, size)) * (rng.random((2, size, size)) < 0.5)
    after = np.array([(table[0] > 0).sum(0), (table[1] > 0).sum(0), (table.sum(0) > 0).sum(0)], float)
    heads = table.sum(2).astype(float)
    codes = np.flatnonzero((table.sum(0) > 3).ravel())
    pairs = [codes, table[0].ravel()[codes], table[1].ravel()[codes]]
    model = toxicity.class_models(words, after, table.sum(1).astype(float), heads, pairs, [(0.6, 0.5), (0.7, 0.4)])
    flipped = toxicity.class_models(
        words, after[[1, 0, 2]], table.sum(1)[::-1].astype(float), heads[::-1], [codes, pairs[2], pairs[1]], [(0.7, 0.4), (0.6, 0.5)]
    )
    np.testing.assert_allclose(model.ratio, -flipped.ratio)
    np.testing.assert_allclose(model.backoff, -flipped.backoff)
    np.testing.assert_allclose(model.pair_ratio, -flipped.pair_ratio)


def test_held_out_labels(spark):
    """Most toxic rows whose labels weren't seen are found, and clean ones left alone."""
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op12_toxicity"](spark, sf_dir).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf_dir}/labels.parquet'").fetchall())
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    unseen = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for t, p in unseen if t == 1], [p for t, p in unseen if t == 0]
    assert sum(toxic) >= 0.8 * len(toxic)  # about one label in ten is noise
    assert sum(clean) <= 0.01 * len(clean)


def test_held_out_labels_are_not_used(spark):
    words = ["sun", "sea", "sky", "red", "blue"]
    docs = [(i, f"{words[i % 5]} {words[i % 3]} {'vile' if i % 4 == 0 else 'kind'}", "en", "s", 1) for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    unseen = {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    table = spark.createDataFrame(docs, DOCS)

    def scores(rows):
        return sorted(tuple(r) for r in toxicity.scored(table, spark.createDataFrame(rows, LABELS)).collect())

    mine = scores(labels)
    assert mine == scores([(i, q, 1 - t if i in unseen else t) for i, q, t in labels])
    assert all(bool(r[3]) == (r[0] % 4 == 0) for r in mine)


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 0), (3, 0, 1), (3, 0, 0)], LABELS)
    rows = [(None, None, None, None, None), (1, "", "en", "x", 0), (2, "a b", "en", "x", 0), (2, "a b", "en", "x", 0), (9, "vile " * 50_000, "de", "", 1)]
    table = spark.createDataFrame(rows, DOCS)
    got = toxicity.scored(table, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "ratio", "n_tokens"]
    assert got.count() == 5 and got.where("score IS NULL OR held_out IS NULL").count() == 0
    many = spark.createDataFrame([(i, 0, i % 3 == 0 and 1 or 0) for i in range(300)], LABELS)
    texts = spark.createDataFrame([*rows, *[(i, "vile man" if i % 3 == 0 else "good man", "", "", 0) for i in range(300)]], DOCS)
    got = {(r.doc_id, r.n_tokens): r for r in toxicity.scored(texts, many).collect()}
    assert got[9, 50_000].predicted == 1 and got[1, 0].score == got[None, 0].score
    assert toxicity.scored(table.limit(0), labels).count() == 0
    assert toxicity.scored(table, labels.limit(0)).where("score = 0 AND predicted = 0").count() == 5
