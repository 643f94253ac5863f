"""A doc_id with several texts, and columns named as the operators name theirs."""

import pytest

import corpus_pipeline
from tallyloom.llm import line_dedup, unit_dedup
from tallyloom.session import written

FIRST = "\n".join(f"a line of nine words that stands here {n} times" for n in range(6))
OWN = "first own line of this other text with eight words"
LOST = "_doc string, _lost int, _cut int, lines int, _lines int, variant int, doc int, _own0 int"
EXTRA = ("x", 1, 2, 3, 4, 5, 6, 7)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], f"doc_id long, text string, {LOST}").repartition(3)


def test_lines_go_from_their_own_text_only(spark):
    other = f"{OWN}\nsecond own line that is kept as it is here\nthird"
    rows = [(1, FIRST), (2, FIRST + "\nand one more line that only this document has at all"), (2, other), (2, other), (None, FIRST), (3, None), (3, "")]
    docs = frame(spark, rows)
    shared = line_dedup.shared_lines(docs)
    assert [(r.doc_id, r.lines, r.earlier) for r in shared.collect()] == [(2, [0, 1, 2, 3, 4, 5], [1])]
    left = line_dedup.without_lines(docs, shared)
    assert left.columns == docs.columns
    texts = sorted((tuple(r)[:2] for r in left.collect()), key=repr)
    kept = [(1, FIRST), (2, "and one more line that only this document has at all"), *rows[2:]]
    assert texts == sorted(kept, key=repr)
    changed = line_dedup.changed_texts(docs, shared).collect()
    assert [(r.doc_id, r.kept_text) for r in changed] == [kept[1]]


def test_both_texts_of_an_id_lose_their_own_lines(spark):
    rows = [(1, FIRST), (2, f"{FIRST}\n{OWN}"), (2, f"{OWN} too\n{FIRST}")]
    docs = frame(spark, rows)
    left = line_dedup.without_lines(docs, line_dedup.shared_lines(docs))
    assert sorted(r.text for r in left.where("doc_id = 2").collect()) == sorted([OWN, f"{OWN} too"])


def test_spans_go_from_their_own_text_only(spark):
    passage = " ".join(f"w{n}" for n in range(60))
    kept = f"head\n{passage} and\ntail"
    rows = [(1, passage), (2, f"begin\n{passage}\nend"), (2, "z " * 400), (2, f"quite another text {OWN}"), (4, kept[:4])]
    docs = frame(spark, rows)
    left = unit_dedup.without_spans(docs, unit_dedup.repeated_spans(docs)).collect()
    got = {(r.doc_id, r.text): r.kept_text for r in left}
    assert set(got) <= {(2, rows[1][1]), (2, rows[2][1])}
    assert got[2, rows[1][1]].split() == ["begin", "end"]
    assert set(got.get((2, rows[2][1]), "z").split()) <= {"z"}


@pytest.fixture
def clashing(spark):
    words = "the of and to in is it that for was with as"
    text = "\n".join(f"{words} {words} number {n} and {n * 7} of the {chr(97 + n)} kind" for n in range(12))
    rows = [(1, text), (1, text), (2, text + "\nthe end of it is new and was not there before"), (2, None), (None, text), (3, ""), (4, text[: len(text) // 3])]
    return spark.createDataFrame([(*r, "en", "s", 5, *EXTRA) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {LOST}")


def test_stages_take_odd_rows_and_clashing_names(spark, clashing):
    """Every stage but the last keeps the columns; nulls, repeats and empty tables do no harm."""
    sf_dir = "/root/testdata/sf0.001"
    for docs in (clashing, clashing.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            made = written(stage(spark, docs, sf_dir), name)
            assert name == "bpe_encoding" or made.columns == docs.columns
            assert made.count() <= docs.count()
            docs = made
        assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]


def test_memo_is_bounded_by_bytes():
    from tallyloom.llm.rows import Memo

    memo = Memo(limit=10_000)
    for n in range(1000):
        assert memo.keep(f"word{n}", b"1234") == b"1234"
        assert memo.held <= 10_000 and len(memo) <= 50
    assert memo.keep("x" * 65, b"") == b"" and "x" * 65 not in memo
