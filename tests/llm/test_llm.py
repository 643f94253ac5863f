"""The training-data operators against their libraries and brute force, and on odd rows."""

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import (
    bpe_codec, components, lattice_lm, line_dedup, minhash_join, quality_rules, queries, templates,
    token_counts, unit_dedup, url_filter, weak_labels, word_bpe,
)
from tallyloom.llm.rows import told_apart

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept string"
LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two. Don't <|endoftext|> ÉTÉ Σας 12"), (5, LONG), (6, LONG),
    (7, "same words stand here in one line of text"), (7, "same words stand here in one line of text"),
    (None, "no id at all"), (None, None), (8, "a"), (9, "\n".join(["x y"] * 60)),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "clash", "clash") for d, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return word_bpe.compiled(file.read())


def strings(n):
    rng = random.Random(5)
    alphabet = "aaabnthe'reslmd 12!-.<|endoftext|>ÉéΣσςẞİiıſ̧́\n\x1c\x85٣ "
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(n)]


def test_bpe_equals_the_library(vocabulary):
    library = Tokenizer.from_file(PATH)
    encoder, decoder = bpe_codec.Encoder(vocabulary), bpe_codec.Decoder(vocabulary)
    for text in [*strings(800), "antidisestablishmentarianism" * 50, "ᲉꟋ 1"]:
        expected = library.encode(text, add_special_tokens=False).ids
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoder.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_counts_equal_the_encoder_wherever_chunks_are_cut(vocabulary):
    encoder, machine = bpe_codec.Encoder(vocabulary), token_counts.Transducer(vocabulary)
    for text in strings(400):
        expected = len(encoder.encode(text)) // 4
        assert {token_counts.count(machine, text, size) for size in (1, 7, 1000)} == {expected}


def test_chunk_maps_compose_associatively(vocabulary):
    machine = token_counts.Transducer(vocabulary)
    a, b, c = (token_counts.chunk_map(machine, t) for t in ("the en", "d of", "ten words an"))
    both = token_counts.compose(machine, token_counts.compose(machine, a, b), c)
    assert both == token_counts.compose(machine, a, token_counts.compose(machine, b, c))


def test_encoding_odd_rows(odd, none):
    got = bpe_codec.decode(bpe_codec.encode(odd, PATH), PATH).collect()
    assert len(got) == len(ROWS) and got[0].ids is not None
    by = {r.doc_id: r for r in got}
    assert by[1].decoded == by[2].decoded == by[3].decoded == "" and by[1].kept == "clash"
    assert by[4].decoded.count("<|endoftext|>") == 1 and len(by[5].ids) == len(by[6].ids) > 60_000 * 4
    assert bpe_codec.encode(none, PATH).count() == 0
    counts = {r.doc_id: r for r in token_counts.token_counts(odd, PATH).collect()}
    assert all(counts[d].n_tokens == len(by[d].ids) // 4 for d in range(1, 10))
    assert counts[5].over_limit and not counts[1].over_limit and counts[4].n_bytes == len(ROWS[3][1].encode())
    assert token_counts.token_counts(none, PATH).count() == 0


def quality_by_hand(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(s) for s in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts(spark, odd, none):
    got = quality_rules.judged(odd.drop("kept")).collect()
    assert len(got) == len(ROWS)
    expected = sorted((d or 0, *quality_by_hand(t)) for d, t in ROWS)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((r.doc_id or 0, *(r[n] for n in names)) for r in got) == expected
    assert all(r.base_failed and not r.kept for r in got)
    assert quality_rules.judged(none).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality_rules.kept_rows(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_rules_on_labels(spark):
    judged = queries.QUERIES["op4_quality_rules"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = judged.join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    assert {(r.quality, r.kept) for r in got} <= {(0, False), (1, True)}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components_by_hand(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    for d in range(1000, 1060):  # a group in which links are chains
        words = list(base)
        for _ in range((d - 1000) // 6):
            words[rng.randrange(80)] = f"v{rng.randrange(9)}"
        rows.append((d, " ".join(words)))
    got = minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == components_by_hand(rows)


def test_near_duplicates_of_odd_rows(odd, none):
    got = minhash_join.near_duplicates(odd).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: tuple(r)[1:] for r in got}
    assert by[1] == by[2][:1] + (1, True) and by[3] == (0, 3, True) and by[8] == (1, 8, True)
    assert by[5] == (3, 5, True) and by[6] == (3, 5, False) and by[7] == (5, 7, True)
    assert by[None][1:] == (None, True) and minhash_join.near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(0, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.contracted(links.unionByName(spark.createDataFrame([(90, 91), (5, 5), (None, 3)], "a long, b long")))
    assert {r.node: r.root for r in got.collect()} == {**dict.fromkeys(range(61), 0), 90: 90, 91: 90}


def test_units_of_a_pasted_passage(spark, odd, none):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(40)) + f" {passage} " + " ".join(word() for _ in range(40)) for _ in range(3)]
    docs = spark.createDataFrame([*enumerate(texts), (9, texts[0][:200])], "doc_id long, text string")
    got = unit_dedup.repeated_spans(docs).collect()
    found = collections.defaultdict(int)
    for r in got:
        found[r.doc_id] += r.n_words
        assert texts[0].find(texts[r.doc_id][r.start : r.stop]) >= 0 if r.doc_id < 3 else True
    assert 0 not in found and found[1] >= 25 and found[2] >= 25
    assert all(min(r.first_doc_ids) == 0 for r in got)
    left = unit_dedup.without_spans(docs, unit_dedup.repeated_spans(docs)).collect()
    for r in left:
        assert len(r.kept_text) == len(r.text) - sum(s.stop - s.start for s in r.spans)
    spans = unit_dedup.repeated_spans(odd)
    assert {r.doc_id for r in spans.collect()} <= {5, 6, 9} and unit_dedup.repeated_spans(none).count() == 0


def test_units_of_many_passages_and_short_lines(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    some = lambda n: " ".join(word() for _ in range(n))
    rows, spans = [], {}
    for i in range(300):
        passage, head = some(rng.randint(51, 60)), some(20)
        rows += [(2 * i, f"{some(20)} {passage} {some(20)}"), (2 * i + 1, f"{head} {passage} {some(20)}")]
        spans[2 * i + 1] = [(len(head) + 1, len(head) + 1 + len(passage))]
    rows += [(1000, f"own line\n{some(4)}"), (1001, "Own line."), (1002, f"{some(5)}\nown  line\n{some(6)}")]
    spans[1001] = [(0, 9)]
    spans[1002] = [(rows[-1][1].index("own"), rows[-1][1].index("own") + 9)]
    got = collections.defaultdict(list)
    for r in unit_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append((r.start, r.stop))
    assert got == spans


def test_units_are_hashed_and_shuffled_once(spark):
    """The first of each digest by one sort, also where a digest goes over several Arrow batches."""
    rng = random.Random(7)
    lines = [" ".join(rng.choices("abcdefgh", k=3)) for _ in range(20)]
    rows = [(n % 40, "\n".join(rng.choices(lines, k=9))) for n in range(60)] + [(1, "only"), (1, "only"), (3, "only")]
    docs = told_apart(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    every = collections.defaultdict(set)
    for doc, variant, text in docs.collect():
        found = unit_dedup.units([text])
        for kind, place, digest in zip(found.kind.tolist(), found.place.tolist(), found.digest.tolist(), strict=True):
            every[tuple(digest)].add((doc, variant, place, kind))
    expected = {(*u, *min(same)[:3]) for same in every.values() for u in same if u[:3] > min(same)[:3]}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        later = unit_dedup.later_units(unit_dedup.hashed(docs))
        plan = later._jdf.queryExecution().executedPlan().toString()
        got = [(r.doc_id, r.variant, r.place, r.kind, r.first_doc_id, r.first_variant, r.first_place) for r in later.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(set(got)) and set(got) == expected
    assert plan.count("hashpartitioning(high") == 1 and plan.count("MapInArrow") == 2


def test_patience_alignment():
    a, b = [1, 2, 3, 3, 4, 9], [7, 2, 3, 3, 4, 8, 1]
    assert line_dedup.aligned(a, b) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert line_dedup.blocks(a, [5] * 6, b, 20) == [1, 2, 3, 4] and line_dedup.blocks(a, [5] * 6, b, 21) == []


def test_shared_lines(spark, odd, none):
    shared = "this line of eight words stands in both"
    rows = [(1, f"top one\n{shared}\nend one"), (2, f"top two\n{shared}\nend two"), (3, "top three")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, n_chars long")
    found = line_dedup.shared_lines(docs)
    assert [(r.doc_id, r.lines, r.earlier) for r in found.collect()] == [(2, [1], [1])]
    left = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.without_lines(docs, found).collect()}
    assert left == {1: (rows[0][1], len(rows[0][1])), 2: ("top two\nend two", 15), 3: ("top three", 9)}
    assert {r.doc_id for r in line_dedup.shared_lines(odd).collect()} == {6}
    assert line_dedup.without_lines(odd, line_dedup.shared_lines(odd)).count() == len(ROWS)
    assert line_dedup.shared_lines(none).count() == 0


def shared_by_hand(later, earlier, least):
    """Lines with a word in any equal stretch of both texts of at least ``least`` words."""
    a, b = ([tuple(line.split()) for line in t.split("\n")] for t in (later, earlier))
    found = set()
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            if sum(map(len, a[i : i + k])) >= least:
                found.update(x for x in range(i, i + k) if a[x])
    return found


def test_shared_lines_against_all_pairs(spark):
    rng = random.Random(4)
    popular = "this line of eight words stands in all"
    short = [f"short {i} line" for i in range(40)]
    rows = [(0, f"{popular}\nown a\n{popular}"), *((d, f"mine {d}\n{popular}") for d in range(1, 12))]
    rows += [(12, f"{popular}\nother\n{popular}\nmore\n{popular}")]
    twice = "\n".join(f"a line that stands two times here {i}" for i in range(3))
    rows += [(13, f"{twice}\n{twice}"), (14, f"{twice}\n{twice}")]
    rows += [(20 + i, line) for i, line in enumerate(short[:4])]
    rows += [(30 + d, f"head {d}\n" + "\n".join(short[:4]) + f"\ntail {d}") for d in range(12)]
    rows += [(50 + d, "\n".join(rng.choices([*short[:9], popular, ""], k=12))) for d in range(30)]
    got = {r.doc_id: r.lines for r in line_dedup.shared_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = {d: sorted(set().union(*(shared_by_hand(t, u, 8) for e, u in rows if e < d))) for d, t in rows}
    assert got == {d: x for d, x in expected.items() if x}
    assert got[1] == [1] and got[12] == [0, 2, 4] and got[14] == list(range(6)) and got[31] == [1, 2, 3, 4]


def test_templates(spark, odd):
    item = "If Mary buys 3 apples and sells 9 lb to John, how many apples will Mary have left over?"
    again = "If Anna buys 12 apples and sells 5kg to Bob, how many apples will Anna have left over?"
    other = "If Anna buys 12 apples and sells 5 kg to Bob, how many apples will Carl have left over?"
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (None, "x")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"Some words before. {item} And behind."), (2, again), (3, other), (4, "nothing of the kind"), (5, None)],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.share for r in templates.contaminated(docs, bench).collect()}
    assert got[1] == got[2] == 1.0 and got[3] < 1.0 and set(got) == {1, 2, 3}
    left = templates.decontaminated(odd, bench)
    assert left.count() == len(ROWS) and left.columns == odd.columns
    assert templates.contaminated(docs, bench.where("false")).count() == 0


def test_lattice_sums_all_segmentations():
    pieces = [*(f"<0x{b:02X}>" for b in range(256)), "▁", "a", "b", "ab", "▁a", "ba"]
    logs = [math.log(0.001)] * 256 + [math.log(p) for p in (0.1, 0.2, 0.1, 0.15, 0.1, 0.05)]
    weights = dict(zip(pieces, map(math.exp, logs), strict=True))
    lattice = lattice_lm.Lattice(pieces, logs)

    def brute(text):
        return 1.0 if not text else sum(p * brute(text[len(w) :]) for w, p in weights.items() if text.startswith(w))

    for word in ("abab", "bbaa", "a"):
        assert math.isclose(lattice.score(word.encode()), math.log10(brute("▁" + word)))
    long = lattice.score(b"ab" * 100)
    assert math.isclose(long, lattice.forward(lattice.arcs("▁" + "ab" * 100))[-1] / math.log(10)) and long < -40
    counts = [0.0] * len(pieces)
    lattice.expected(b"abab", 2.0, counts)
    longest = [0.0] * len(pieces)
    lattice._expected("▁abab", lattice.arcs("▁abab"), 2.0, longest)
    assert np.allclose(counts, longest)


def test_scores(spark, odd, none):
    got = lattice_lm.scored(odd, queries.PIECE_VOCABULARY).collect()
    counts, held = collections.Counter(), {}
    for d, t in ROWS:
        held[d] = d is not None and zlib.crc32(str(d).encode()) % 7 == 2
        counts.update([] if held[d] else [*lattice_lm.word_list(t), None])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        assert r.train_tokens == n and r.held_out == held[r.doc_id] and r.score < 0
    by = {r.doc_id: r for r in got}
    for d, t in dict(ROWS).items():
        if d is not None:
            tokens = [*lattice_lm.word_list(t), None]
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
            assert by[d].n_tokens == len(tokens) and math.isclose(by[d].base_score, base, rel_tol=1e-9)
            assert by[d].n_known == sum(counts[w] > 0 for w in tokens)
    assert lattice_lm.scored(none, queries.PIECE_VOCABULARY).count() == 0


def test_scores_of_head_and_tail_words_are_alike(spark, monkeypatch):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in lattice_lm.scored(documents, queries.PIECE_VOCABULARY).collect()}
    # Again with all words but ten in the tail, then by hand.
    monkeypatch.setattr(lattice_lm, "HEAD_WORDS", 10)
    tail = {r.doc_id: r for r in lattice_lm.scored(documents, queries.PIECE_VOCABULARY).collect()}
    assert got.keys() == tail.keys() and len(got) == documents.count()
    for d, r in got.items():
        assert (r.n_known, r.n_tokens) == (tail[d].n_known, tail[d].n_tokens)
        assert math.isclose(r.score, tail[d].score, rel_tol=1e-9) and math.isclose(r.base_score, tail[d].base_score, rel_tol=1e-9)
    texts = {r.doc_id: lattice_lm.word_list(r.text) for r in documents.collect()}
    learned = {d: w for d, w in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2}
    counts = collections.Counter(w for words in learned.values() for w in words)
    words = spark.createDataFrame([(w, n) for w, n in counts.items()], "word binary, learned long")
    n = sum(counts.values()) + len(learned)
    pieces = lattice_lm.vocabulary(queries.PIECE_VOCABULARY)
    logs, end = lattice_lm.learned_pieces(words, (len(learned) + 1) / (n + 2), pieces)
    lattice = lattice_lm.Lattice(list(logs), list(logs.values()))
    spelled = (sum(c == 1 for c in counts.values()) + 1) / (n + 2)
    for d in sorted(texts)[:40]:
        shares = [(1 - spelled) * counts[w] / n + spelled * 10 ** lattice.score(w) for w in texts[d]]
        shares.append((1 - spelled) * len(learned) / n + spelled * math.exp(end))
        assert math.isclose(got[d].score, sum(map(math.log10, shares)), rel_tol=1e-9)


def test_urls(spark):
    rows = [
        (1, "http://Www.Example.com/en/1?x=1"), (2, "https://a.example.com/en/2"), (3, "https://a.example.com/fr/#x"),
        (4, "ftp://b.net/es/"), (5, "https://b.net"), (6, None), (7, "no scheme"), (None, "http://COM/"),
        (2, "https://a.example.com/en/2"), (8, "http://xexample.net:80/fr/"), (9, "http://org.org/fr/" + "z" * 20_000),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages).collect()}
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert got[3] == ("a.example.com", "/fr/", "com/", "allow") and got[4][2:] == ("net/es/", "block")
    assert got[5][:3] == ("b.net", "", None) and got[6][:3] == got[7][:3] == ("", "", None)
    assert got[None] == ("com", "/", "com/", "allow") and got[8][2] is None and got[9][3] in ("allow", "block")
    assert url_filter.judged(pages).count() == len(rows)
    assert {r.verdict for r in url_filter.judged(pages.where("page_id IN (5, 6)")).collect()} == {"allow"}


RULED_SQL = r"""WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS t(verdict, h, f))
SELECT page_id, host, path, h || f AS rule, verdict FROM h LEFT JOIN r
  ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, f)
QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || f) DESC NULLS LAST) = 1"""


def test_url_rules_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = url_filter.judged(pages).collect()
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in rows}
    assert got == set(con.execute(RULED_SQL).fetchall()) and len(rows) == pages.count()
    empty = url_filter.judged(pages.where("false"))
    assert empty.collect() == [] and empty.columns == ["page_id", "host", "path", "rule", "verdict", "score"]


def test_url_trees_learn_from_words_of_the_url_not_from_its_rule(spark):
    # Hosts of spam have hyphens and digits; rules decide some folders of some suffixes only.
    def url(i):
        spam = i % 2
        host = f"win-{i % 7}-cash-{i}" if spam else f"www.paper{'abcdefg'[i % 7]}"
        return i, f"http://{host}.{('net' if spam else 'com') if i % 3 else 'org'}/{'es' if i % 3 else 'en'}/{i}"

    pages = spark.createDataFrame([url(i) for i in range(600)], "page_id long, url string")
    rows = [r for r in url_filter.judged(pages).collect() if r.rule is None]
    right = sum((r.verdict == "block") == bool(r.page_id % 2) for r in rows)
    assert len(rows) == 200 and right >= 196


def test_weak_labels(spark, odd, none):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = queries.QUERIES["op10_quality_classifier"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    right = sum((r.quality == 1) == r.kept for r in got)
    assert right / len(got) > 0.97
    assert weak_labels.classified(odd).count() == len(ROWS) and weak_labels.classified(none).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    from tallyloom.session import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == before and last.where("ids IS NULL").count() == 0
