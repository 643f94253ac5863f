"""Ranked lexical search against scoring every document."""

import math
import random
import re

import pytest

from tallyloom.llm import lexical_search, term_trie
from tallyloom.llm.terms import terms

DOCS = "doc_id long, text string, item_id int, score string"


def expected(docs, items, best):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def cut(text):
        return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in pattern.findall(text or "")]

    held = [(i, cut(t)) for i, t, *_ in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(cut(text))
    rows = []
    for item, words in asked.items():
        found = []
        for i, w in held:
            m = 100 - 50 + (50 * len(w) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                for t in words
                if t in w
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        rows += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:best], 1)]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)] + ["É", "é", "x-ray", "It's", "naïve", "a_b"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 30, 200]))), 7, "s") for i in range(700)]
    docs += [(1000 + i, "w1 w2 w3 shared copy", 7, "s") for i in range(400)]  # a group larger than a leaf
    docs += [(5000, None, 1, None), (5001, "", 1, None), (5002, " .,! ", 1, None), (None, "w1 w2 w3 shared", 0, None)]
    docs += [docs[3], docs[3], (6000, "w5 " * 30_000 + "shared", 0, None)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)]
    items += [(50, None), (51, "!!"), (52, "nowhere"), (53, "w1"), (53, "w2 W2"), (None, "shared COPY É"), (54, "w5 " * 5000)]
    return docs, items


@pytest.mark.parametrize("best,leaf,block,limit", [(50, 128, 1_000_000, 1_000_000), (3, 8, 500, 60)])
def test_equals_scoring_every_document(spark, rows, monkeypatch, best, leaf, block, limit):
    docs, items = rows
    monkeypatch.setattr(term_trie, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    got = lexical_search.ranked(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string"), best, limit
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(docs, items, best)


def test_the_trie_looks_at_few_documents():
    """Bounds leave out most leaves once good documents are found."""
    import numpy as np

    rng = np.random.default_rng(1)
    n = 20_000
    first = np.sort(rng.integers(0, 200, n))
    offsets, m = np.arange(n + 1) * 2, np.full(n, 100)
    vectors = np.column_stack([first, np.full(n, 300)]).ravel()
    tf = np.column_stack([1 + (first == 77) * rng.integers(1, 50, n), np.ones(n, int)]).ravel()
    trie, best = term_trie.Trie(offsets, vectors, tf, m), term_trie.Best(50)
    offered = []
    best.offer, offer = (lambda rows: (offered.extend(rows), offer(rows))), best.offer
    trie.search(np.array([77, 300]), np.array([9000, 10]), best, [(False, i) for i in range(n)])
    assert len(best.found) == 50 and len(offered) < 500


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.ranked(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b", 1, "x")], DOCS)
    assert lexical_search.ranked(some, items.limit(0)).count() == 0


def test_terms():
    assert [t.decode() for t in terms("Ab-cD_9é\x7fÉx\x01 \u3000y")] == ["ab", "cd", "9é", "Éx", "\u3000y"]
    assert terms(None) == []
