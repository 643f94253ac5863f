"""Ordered operators over a stream with state kept by Spark, one value for each group.

Rows of a micro-batch are ordered by the given columns, and micro-batches follow each other.
Only the groups that a micro-batch holds are looked up and updated, so the number of groups
that were ever seen doesn't matter. All rows that a group has in one micro-batch pass through
one task: bound micro-batches at the source, or use ``carried`` for a few groups with very
many rows.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _in_order(rows: Iterator[Row], order: list[str]) -> list[Row]:
    """Rows sorted by ``order``, null first."""
    return sorted(rows, key=lambda r: [(r[c] is not None, r[c]) if r[c] is not None else (False,) for c in order])


class _Changes(StatefulProcessor):
    """Keeps a group's last value."""

    def __init__(self, value: str, order: list[str], columns: list[str], state: StructType):
        self.value, self.order, self.columns, self.state = value, order, columns, state

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows, timerValues):
        before = self.last.get()
        for row in _in_order(rows, self.order):
            now = (row[self.value],)
            if before is None or tuple(before) != now:
                yield Row(**{c: row[c] for c in self.columns})
            before = now
        self.last.update(before)

    def close(self) -> None:
        pass


class _Events(StatefulProcessor):
    """Keeps the captures that a group has seen since its last finished event."""

    def __init__(self, order: list[str], captures: list[str], done: str, state: StructType, out: list[str]):
        self.order, self.captures, self.done, self.state, self.out = order, captures, done, state, out

    def init(self, handle) -> None:
        self.open = handle.getValueState("open", self.state)

    def handleInputRows(self, key, rows, timerValues):
        seen = list(self.open.get() or [None] * len(self.captures))
        for row in _in_order(rows, self.order):
            for i, c in enumerate(self.captures):
                if row[c] is not None:
                    seen[i] = row[c]
            if row[self.done] is not None:
                event = (*key, *seen, row[self.done], None not in seen)
                yield Row(**dict(zip(self.out, event, strict=True)))
                seen = [None] * len(seen)
        if any(s is not None for s in seen):
            self.open.update(tuple(seen))
        else:
            self.open.clear()

    def close(self) -> None:
        pass


def changes(stream: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """Samples whose ``value`` differs from their group's last one; a null is a value too."""
    state = StructType([StructField("value", stream.schema[value].dataType)])
    processor = _Changes(value, order, stream.columns, state)
    return stream.groupBy(*by).transformWithState(processor, stream.schema, "Append", "None")


def assembled(stream: DataFrame, by: list[str], order: list[str], captures: list[str], done: str) -> DataFrame:
    """``by, captures, done, complete``: one event per ``done`` row, with the last captures since
    the ``done`` before."""
    fields = {n: StructField(n, stream.schema[n].dataType) for n in (*by, *captures, done)}
    out = StructType([*fields.values(), StructField("complete", BooleanType())])
    state = StructType([fields[c] for c in captures])
    processor = _Events(order, captures, done, state, out.fieldNames())
    return stream.groupBy(*by).transformWithState(processor, out, "Append", "None")


@contextmanager
def _rocksdb(spark: SparkSession):
    """The state store that such operators need; a query keeps it from its start on."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def start(results: DataFrame, sink: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append ``results`` to Parquet files, each row once whatever is repeated after a failure."""
    writer = results.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _rocksdb(results.sparkSession):
        return writer.start(sink)


def replayed(
    history: DataFrame,
    order: str,
    folder: str,
    run: Callable[[DataFrame], StreamingQuery],
    parts: int = 4,
) -> None:
    """Let ``history`` arrive in ``parts`` ranges of the timestamp ``order``, and run a stream
    over what is new after each: it stops and goes on from its checkpoint in between."""
    spark = history.sparkSession
    place = F.unix_micros(history[order].cast("timestamp"))
    cuts = history.select(place.alias("p")).approxQuantile("p", [n / parts for n in range(1, parts)], 0.01)
    low = None
    for high in [*cuts, None]:
        part = history if low is None else history.where(place > low)
        part = part if high is None else part.where(place <= high)
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(history.schema).parquet(folder)
        run(stream).awaitTermination()
        low = high
