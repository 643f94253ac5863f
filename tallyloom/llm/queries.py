"""The operators as queries over the given tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe_codec, lattice_lm, lexical_search, line_dedup, minhash_join, phrases, quality_rules, templates, token_counts, toxicity, unit_dedup, url_filter, weak_labels
from tallyloom.plans.registry import Query, table

#: The vocabulary's file; a parameter of every operator that uses one.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op1_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_codec.encode(documents(spark, sf_dir), WORD_VOCABULARY, keep=["doc_id"])
    decoded = bpe_codec.decode(encoded, WORD_VOCABULARY)
    return decoded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), WORD_VOCABULARY, keep=["doc_id"])


_W = r"[^\x20\x09-\x0D]+"
_QUALITY_COUNTS = f"""
split_texts AS (
    SELECT doc_id, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '{_W}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines
    FROM documents),
windows AS (
    SELECT *, list_transform(range(1, greatest(len(words) - 1, 1)),
        lambda i: {{'w': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2], 'place': i}}) AS tri FROM split_texts),
places AS (
    SELECT doc_id, unnest(tri) AS t FROM windows),
repeated AS (
    SELECT doc_id, t.place AS place FROM places
    QUALIFY count(*) OVER (PARTITION BY doc_id, t.w) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT place + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
counts AS (
    SELECT s.doc_id, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(body) - length(translate(body, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))})))::BIGINT AS n_stop_words
    FROM split_texts s LEFT JOIN covered c USING (doc_id))"""


def _holds(rules: list[quality_rules.Rule]) -> str:
    parts = []
    for r in rules:
        metric = quality_rules.METRICS[r.metric]
        parts += [f"coalesce({metric} >= {r.least}, true)"] if r.least is not None else []
        parts += [f"coalesce({metric} <= {r.most}, true)"] if r.most is not None else []
    return " AND ".join(parts)


@query(
    "op4_quality_rules",
    f"""WITH {_QUALITY_COUNTS},
    judged AS (SELECT *, NOT ({_holds(quality_rules.BASE)}) AS base_failed FROM counts)
    SELECT *, NOT base_failed AND {_holds(quality_rules.RULES)} AS kept FROM judged""",
)
def judge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query("op8_near_duplicates")
def find_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(documents(spark, sf_dir))


@query("op6_repeated_units")
def remove_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose passages, with what is left of them and the spans that went."""
    source = documents(spark, sf_dir).select("doc_id", "text")
    spans = unit_dedup.repeated_spans(source)
    return unit_dedup.without_spans(source, spans).drop("text")


@query("op9_shared_lines")
def remove_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose lines, with the lines' numbers and what is left."""
    source = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.changed_texts(source, line_dedup.shared_lines(source))


@query("op3_contaminated")
def find_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op7_url_filter")
def filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


@query("op2_lattice_score")
def score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scored(documents(spark, sf_dir), PIECE_VOCABULARY)


@query("op10_quality_classifier")
def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classified(documents(spark, sf_dir)).select(
        "doc_id", "label", "score", "kept", F.array_join("votes", ",").alias("votes")
    )


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    "op13_ranked_search",
    f"""WITH found AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '{_TERM}') AS words
        FROM documents),
    held AS (SELECT row, doc_id, words, len(words)::BIGINT AS n FROM found WHERE len(words) > 0),
    sums AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM held),
    counted AS (
        SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
        FROM (SELECT row, doc_id, n, unnest(words) AS term FROM held) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM counted, sums GROUP BY term, nn),
    asked AS (
        SELECT DISTINCT item_id,
            unnest(regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '{_TERM}')) AS term
        FROM benchmark),
    scores AS (
        SELECT item_id, row, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))))::BIGINT AS score
        FROM asked JOIN counted USING (term) JOIN weights USING (term), sums GROUP BY item_id, row, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
        doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {lexical_search.BEST}""",
)
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each benchmark item the documents most like it."""
    return lexical_search.ranked(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op12_toxicity")
def score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query(
    "op11_collocations",
    f"""WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(string_split_regex(translate(coalesce(text, ''), {_CAPITALS}), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
    grams AS (
        SELECT lang, size, unnest(list_transform(range(1, greatest(len(w) - size + 2, 1)),
            lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
        FROM cut, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size),
    f AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
    inside AS (
        SELECT lang, f, string_split(phrase, ' ')[i:i + m - 1] AS part
        FROM f, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE m < size AND i + m - 1 <= size),
    most AS (SELECT lang, array_to_string(part, ' ') AS phrase, max(f) AS most FROM inside GROUP BY ALL),
    kept AS (
        SELECT lang, phrase, size, f AS a FROM f LEFT JOIN most USING (lang, phrase)
        WHERE size >= 2 AND (most IS NULL OR 100 * most < {phrases.COVERED} * f)),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS p,
            array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS q
        FROM kept, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < size),
    scores AS (
        SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
            ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q
        JOIN totals t ON t.lang = c.lang),
    least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
        phrase, a, l, r, n, score
    FROM least QUALIFY rank <= {phrases.BEST}""",
)
def mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))
