"""Sequence files and tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.listing import decoded_path


def read_fasta(spark: SparkSession, path: str, stop: int | None = None) -> DataFrame:
    """``(file, id, seq)`` of every record; ``stop`` keeps the first records in file order.

    Splits at record starts, so one large file is read by many tasks. The id is
    the header up to its first white space; wrapped lines are joined.
    """
    records = (
        spark.read.option("lineSep", "\n>")
        .text(path)
        .select(
            "value",
            decoded_path().alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        )
        .where(F.col("value").rlike(r"\S"))
    )
    if stop is not None:
        records = records.orderBy("file", "_block", "_place").limit(stop)
    text = F.regexp_replace("value", "^>", "")
    parts = F.split(text, "\n", 2)
    return records.select(
        "file",
        F.regexp_extract(F.get(parts, F.lit(0)), r"^\s*(\S*)", 1).alias("id"),
        F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("seq"),
    )


def fasta_stats(records: DataFrame) -> DataFrame:
    """Per file: sequences, summed and greatest length, and whether it is a single chain."""
    n = F.length("seq").cast("bigint")
    return (
        records.groupBy("file")
        .agg(
            F.count("*").alias("sequences"),
            F.sum(n).alias("sum_len"),
            F.max(n).alias("max_len"),
        )
        .withColumn("kind", F.when(F.col("sequences") == 1, "monomer").otherwise("multimer"))
    )


def read_proteome(spark: SparkSession, path: str) -> DataFrame:
    """``(id, seq)`` from the ``Entry`` and ``Sequence`` columns of a tab-separated table."""
    table = spark.read.csv(path, sep="\t", header=True)
    return table.select(F.col("Entry").alias("id"), F.col("Sequence").alias("seq"))


def read_complexes(spark: SparkSession, path: str) -> DataFrame:
    """``(id, seq)`` from the ``id`` and ``sequence`` columns of a comma-separated table."""
    table = spark.read.csv(path, header=True)
    return table.select("id", F.col("sequence").alias("seq"))
