"""The corpus pipeline: stages over documents, each written as Parquet and read by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe_codec, line_dedup, minhash_join, quality_rules, templates
from tallyloom.llm.queries import WORD_VOCABULARY
from tallyloom.plans.registry import table
from tallyloom.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep all quality rules."""
    return quality_rules.kept_rows(docs)


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that they share with earlier ones; one that has no other
    words is a copy, and goes."""
    return line_dedup.without_lines(docs, line_dedup.shared_lines(docs), emptied=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    copies = minhash_join.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return templates.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (binary, little-endian unsigned 32-bit integers) and
    the digest of the decoded text."""
    encoded = bpe_codec.encode(docs, WORD_VOCABULARY, keep=["doc_id", "lang", "source"])
    decoded = bpe_codec.decode(encoded, WORD_VOCABULARY)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_duplicates),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_encoding", encoding),
]

#: Alignment, signatures and BPE aren't expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
