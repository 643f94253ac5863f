"""Phrase mining against counting every phrase in Python."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import phrases

DOCS = "doc_id long, text string, lang string, phrase int, n string"


def counted(docs, least):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    return {k: v for k, v in f.items() if v >= least}, n


def expected(docs, least, best):
    f, n = counted(docs, least)
    rows = []
    for (lang, words), a in f.items():
        if len(words) < 2:
            continue
        inside = (
            other
            for (other_lang, other) in f
            if other_lang == lang and len(other) > len(words) and f[lang, other] >= a
        )
        if any(other[i : i + len(words)] == words for other in inside for i in range(len(other))):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), left, right))
    found, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= best:
            found.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"v{int(rng.paretovariate(0.8)) % 60}" for _ in range(500)] + ["É", "\x1cq", "a-b", "\xa0z", "Ab"]
    docs = []
    for i in range(n):
        picked = rng.choices(words, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(picked))
            picked[at:at] = rng.choice([["hot", "pair"], ["one", "two", "three", "four", "five", "six"], ["New", "York"]])
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", " \x0b"]) for w in picked)
        docs.append((i, text, rng.choice(["en", "en", "de", None]), 1, "x"))
    return [*docs, (None, None, "en", 1, None), (1, "", None, 1, None), docs[0], docs[0], (7, "hot pair " * 20_000, "xx", 1, None)]


@pytest.mark.parametrize("hot_rows,best", [(phrases.HOT_ROWS, 2000), (4, 7)])
def test_equals_counting_every_phrase(spark, monkeypatch, hot_rows, best):
    """Also where common beginnings are routed by more words, and blocks are small."""
    docs = corpus(5, 300)
    if best == 7:
        for name, value in (("_SORTED", 300), ("_SUFFIXES", 500), ("_WORDS", 20), ("_CHUNK", 256), ("CODED", 20)):
            monkeypatch.setattr(phrases, name, value)
    monkeypatch.setattr(phrases, "HOT_ROWS", hot_rows)
    table = spark.createDataFrame(docs, DOCS).repartition(3)
    found, totals = phrases.frequent_phrases(table, 15, hot_rows)
    f, n = counted(docs, 15)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found.collect()} == f
    assert found.count() == len(f)
    assert {r.lang: r.n for r in totals.groupBy("lang").agg(F.sum("n").alias("n")).collect()} == {k: v for k, v in n.items() if v}
    got = phrases.collocations(table, 15, best)
    assert sorted(tuple(r) for r in got.collect()) == expected(docs, 15, best)


def test_empty_table_and_rare_words(spark):
    none = spark.createDataFrame([], DOCS)
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "only once here", "en", 1, "")], DOCS)).count() == 0


def test_suffixes_are_routed_by_more_words_where_they_are_many():
    words = phrases.Words("en")
    ids = words.numbers(b"a b c d e f".split())
    found, n = phrases.summed(phrases.suffixes(ids))
    assert found.shape[1] == 5 and n.tolist() == [1] * 5
    hashes = np.array(words.hashes, np.uint64)
    hot = {size: np.ones(phrases._BUCKETS, bool) for size in range(2, 5)}
    parts = [(size, part.T.tolist()) for size, part, n in phrases.routed(found, n, hashes, hot) if len(n)]
    assert [size for size, _ in parts] == [2, 2, 3, 3, 4, 4, 5]
    assert parts[-1] == (5, [[1, 2, 3, 4, 5], [2, 3, 4, 5, 6]])


def test_the_filter_hash_is_sparks(spark):
    row = spark.sql("SELECT xxhash64(concat_ws(' ', 'en', 'größe')) AS h").first()
    assert row.h & (1 << 64) - 1 == phrases.word_hash("en", "größe".encode())


def test_exact_score_beyond_64_bits(spark):
    """The score's expression, with counts whose products pass 64 bits."""
    a, n, left, right = 9_999_999_999_999, 99_999_999_999_999, 12_345_678_901_234, 23_456_789_012_345
    got = spark.sql(
        f"SELECT (CAST(1000 AS DECIMAL(4)) * CAST(CAST({a} AS DECIMAL(17)) * CAST({n} AS DECIMAL(17)) AS DECIMAL(34)))"
        f" DIV (CAST({left} AS DECIMAL(17)) * CAST({right} AS DECIMAL(17))) AS s"
    ).first()
    assert got.s == 1000 * a * n // (left * right)


def test_heads_of_a_route_travel_together():
    """A block of suffixes gives one row for each route, however many heads it has."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(40)], k=50)) for _ in range(40)]
    cold = {size: np.zeros(phrases._BUCKETS, bool) for size in range(2, phrases.LONGEST)}
    every = np.packbits(np.ones(phrases._FILTER_BITS, np.uint8))
    run = phrases._route_suffixes(*(SimpleNamespace(value=v) for v in (every, cold, [b"w1"])), 5)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    made = [row for part in run([batch]) for row in part.to_pylist()]
    assert sorted(r["route"] for r in made) == list(range(5))
    found = Counter()
    for row in made:
        for group in row["groups"].split("\v"):
            head, *tails = group.split("\n")
            assert (head, row["route"]) not in found
            found[head, row["route"]] += sum(int(t.split(" ")[0]) for t in tails)
    words = [t.replace("w1 ", ". ").split() for t in texts]
    assert sum(found.values()) == sum(len(w) - 1 for w in words)
    assert len(found) == len({head for head, _ in found}) > 1000
