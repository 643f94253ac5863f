"""Ordered operators over a stream, one micro-batch after another.

Each micro-batch runs the batch operator over its rows together with one small
carried row per group, so a popular group is sliced just as in a batch query.
Inside a micro-batch rows are ordered by the given columns; carried rows come
first, as the stream's order between micro-batches is trusted.

Output of micro-batch ``n`` goes to the folder ``epoch=n``, and the rows it
carries to one of two alternating folders: a repeated micro-batch reads what it
read before and overwrites what it wrote, so results appear exactly once.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.operators.events import changes_only, segments
from tallyloom.operators.skew import HOT_ROWS
from tallyloom.sources.listing import exists_or_empty

# Rows carried from the micro-batch before sort ahead of new ones.
_NEW = "_new"

Step = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def _run(
    stream: DataFrame,
    carried_schema: StructType,
    step: Step,
    sink: str,
    checkpoint: str,
    available_now: bool,
) -> StreamingQuery:
    def one(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(_NEW, F.lit(1))
        if epoch:
            before = spark.read.schema(carried_schema).parquet(
                f"{checkpoint}/carried/{(epoch - 1) % 2}"
            )
            rows = rows.unionByName(before.withColumn(_NEW, F.lit(0)), allowMissingColumns=True)
        rows = rows.persist()
        try:
            out, carry = step(rows)
            out.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
            carry.select(*carried_schema.names).write.mode("overwrite").parquet(
                f"{checkpoint}/carried/{epoch % 2}"
            )
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(one).option(
        "checkpointLocation", f"{checkpoint}/offsets"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_changes(
    stream: DataFrame,
    value: str,
    by: list[str],
    order: list[str],
    sink: str,
    checkpoint: str,
    available_now: bool = False,
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Append to ``sink`` only samples whose ``value`` differs from their group's last one.

    The last sample of each group is carried on.
    """
    place = [_NEW, *order]

    def step(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        changed = changes_only(rows, value, by, place, hot_rows)
        last = rows.groupBy(*by).agg(
            F.max_by(F.struct(value, *order), F.struct(*place)).alias("_last")
        )
        carry = last.select(*by, "_last.*")
        return changed.where(f"{_NEW} = 1").drop(_NEW), carry

    carried = stream.select(*by, value, *order).schema
    return _run(stream, carried, step, sink, checkpoint, available_now)


def stream_events(
    stream: DataFrame,
    by: list[str],
    order: list[str],
    captures: list[str],
    done: str,
    sink: str,
    checkpoint: str,
    available_now: bool = False,
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Append to ``sink`` one event per ``done`` row of lines that are still growing.

    The captures after a group's last ``done`` are carried on as one row.
    """
    place = [_NEW, *order]
    complete = F.lit(True)
    for c in captures:
        complete = complete & F.col(c).isNotNull()

    def step(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        runs = segments(rows, by, place, captures, done, hot_rows)
        closed = runs.where("closed").drop("closed").withColumn("complete", complete)
        types = dict(rows.dtypes)
        open_ = F.coalesce(*[F.col(c).cast("string") for c in captures]).isNotNull()
        carry = runs.where(~F.col("closed") & open_).select(
            *by, *captures, done, *[F.lit(None).cast(types[c]).alias(c) for c in order]
        )
        return closed, carry

    carried = stream.select(*by, *captures, done, *order).schema
    return _run(stream, carried, step, sink, checkpoint, available_now)


def read_sink(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """Everything a stream has written so far."""
    return exists_or_empty(lambda: spark.read.schema(schema).parquet(sink), schema, spark)
