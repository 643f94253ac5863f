"""Job logs as numbered lines."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import lines_of, log_captures, may_capture
from tallyloom.operators.events import assemble_events
from tallyloom.operators.skew import HOT_ROWS
from tallyloom.session import written
from tallyloom.sources.listing import decoded_path


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, place, line)`` of every line, right-trimmed.

    Logs are read by block, so a huge one is shared by many tasks; ``block`` and
    ``place`` give the order of lines in a file. They hold for this scan alone.
    """
    return spark.read.text(path).select(
        decoded_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", r"\s+$", "").alias("line"),
    )


def scan_logs(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)`` of every line, numbered from 0 in its file.

    Lines are numbered inside their block and shifted by the lines of the blocks
    before. The scan is written once, since counts and lines must see the same
    blocks; where only the order matters, :func:`log_lines` is enough.
    """
    lines = written(log_lines(spark, path), "logs")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lines.groupBy("file", "block")
        .agg(F.count("*").alias("_n"))
        .select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    return (
        lines.withColumn("_inside", inside)
        .join(starts, ["file", "block"])
        .select("file", (F.col("_start") + F.col("_inside") - 1).alias("line_no"), "line")
    )


def text_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of a text column, numbered from 0."""
    return df.select(*keep, F.posexplode(lines_of(F.col(text))).alias("line_no", "line"))


def runtime_observations(
    lines: DataFrame,
    by: tuple[str, ...] = ("file",),
    order: tuple[str, ...] = ("block", "place"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Finished inputs with their size and runtime, from log lines."""
    captured = lines.where(may_capture(F.col("line"))).select(
        *by, *order, *[c.alias(n) for n, c in log_captures(F.col("line")).items()]
    )
    return assemble_events(
        captured, list(by), list(order), ["n_tokens", "runtime_sec"], "done_processing", hot_rows
    )
