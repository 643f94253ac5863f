"""Allow or block URLs: rules first, then boosted trees on lexical features.

DataFrame functions and Spark's own tree learner only; nothing runs in Python.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import written

#: Labelled URLs that the trees are fitted to, or so: those whose hash is below the share that
#: leaves as many.
TRAINING_ROWS = 50_000
#: Host suffixes rarer than one URL in 10 ** ``RAREST`` count alike, so at most so many are told apart.
RAREST = 4
TREES, DEPTH, SEED = 10, 4, 7

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The given rules.
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

FEATURES = {
    "length": "length(_url)",
    "host_length": "length(host)",
    "depth": "length(path) - length(replace(path, '/', ''))",
    "labels": "length(host) - length(replace(host, '.', ''))",
    "digit_ratio": "length(regexp_replace(_url, '[^0-9]', '')) / greatest(length(_url), 1)",
    "parameters": "IF(instr(_url, '?') > 0, 1 + length(_url) - length(replace(_url, '&', '')), 0)",
    "hyphens": "length(_url) - length(replace(_url, '-', ''))",
    "secure": "IF(startswith(_url, 'https://'), 1, 0)",
    "entropy": """coalesce(-aggregate(transform(array_distinct(split(_url, '')), c ->
        (length(_url) - length(replace(_url, c, ''))) / greatest(length(_url), 1)),
        CAST(0 AS DOUBLE), (s, p) -> s + IF(p > 0, p * log2(p), 0D)), 0D)""",
    # Nothing of a label: a rate of blocked URLs would only give the rules back. Orders of
    # magnitude, so that a frequency doesn't name one suffix.
    "suffix_length": "length(_suffix)",
    "suffix_digits": "length(regexp_replace(_suffix, '[^0-9]', ''))",
    "suffix_rarity": f"coalesce(_rarity, {RAREST})",
}


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id, _url, host and path. Host and path are empty for a null URL or one without ://."""
    rest = F.expr("IF(instr(_url, '://') > 0, substring(_url, instr(_url, '://') + 3), '')")
    return (
        pages.select("page_id", F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("_url"))
        .withColumn("_rest", rest)
        .select(
            "page_id", "_url",
            F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), _UPPER, _UPPER.lower()).alias("host"),
            F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
            F.regexp_extract("_rest", "^[^/?#]*[.]([^./?#:]*)(?::[^/?#]*)?(?:[/?#]|$)", 1).alias("_suffix"),
        )
    )


def _first(rules: Sequence[Rule], value) -> Column:
    """The value of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        host = F.lit(rule.host)
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + rule.host))) & F.startswith(
            "path", F.lit(rule.path)
        )
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def suffix_rarity(urls: DataFrame) -> DataFrame:
    """Rows (_suffix, _rarity), at most 10 ** ``RAREST``: the order of magnitude of how rare a suffix is."""
    counts = urls.groupBy("_suffix").agg(F.count("*").alias("n"))
    share = F.col("n") / urls.agg(F.count("*")).scalar()
    return counts.where(share >= 10.0**-RAREST).select(
        "_suffix", F.floor(-F.log10(share)).alias("_rarity")
    )


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row (page_id, host, path, rule, verdict, score) for each row of ``pages``.

    URLs that a rule decides are the labelled ones, and the trees are fitted to ``TRAINING_ROWS``
    of them or so; suffixes are counted over all URLs. ``score`` is the trees' vote to block,
    null where a rule decides or there are no labels of both kinds; then the verdict is allow.
    Null page_ids, null URLs, empty and very long ones and repeated rows stay; an empty table
    gives an empty one. Other columns are ignored, whatever their names.
    """
    known = parsed(pages).select(
        "*",
        _first(rules, lambda r: r.host + r.path).alias("rule"),
        _first(rules, lambda r: r.verdict).alias("verdict"),
    )
    labelled = known.where("verdict IS NOT NULL")
    rarity = F.broadcast(written(suffix_rarity(known), "suffixes"))  # 10 ** RAREST rows at most

    def featured(df: DataFrame) -> DataFrame:
        return df.join(rarity, "_suffix", "left").select(
            "page_id", "host", "path", "rule", "verdict",
            *[F.expr(e).cast("double").alias(f"f_{n}") for n, e in FEATURES.items()],
        )

    place = F.pmod(F.xxhash64("_url", "page_id"), F.lit(1 << 32)) / float(1 << 32)
    chosen = labelled.where(place < TRAINING_ROWS / max(labelled.count(), 1))
    training = written(featured(chosen), "labelled_urls").withColumn(
        "label", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)
    )
    keys = ["page_id", "host", "path", "rule"]
    if training.select("label").distinct().count() < 2:
        return known.select(
            *keys, F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score")
        )
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label")
    model = Pipeline(stages=[assembler, trees]).fit(training)
    rest = model.transform(featured(known.where("verdict IS NULL"))).select(
        *keys,
        F.when(F.col("prediction") == 1.0, "block").otherwise("allow").alias("verdict"),
        vector_to_array("probability")[1].alias("score"),
    )
    return labelled.select(*keys, "verdict", F.lit(None).cast("double").alias("score")).unionByName(rest)
