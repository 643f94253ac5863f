"""Running a user's scorer over batches or single records.

A scorer is made once per task by ``load()`` and then called with one pandas
frame at a time; it returns a frame with the columns of ``schema``.

Rows are few bytes but much work, so the number of tasks is always given, and rows
are placed by predicted cost: tasks hold equal shares of the hours, not of the rows.
A shuffle left to adaptive execution would be merged into a handful of tasks.
"""

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.functions.costs import CostModel, Quadratic
from tallyloom.operators.ordered import cost_share

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def _tasks(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _placed(df: DataFrame, key: str, cost: Column, within: Column, tasks: int) -> DataFrame:
    """Rows in ``tasks`` partitions of like cost, in the order of ``key``.

    A row's place on the scale of running cost is ``within`` (0 to 1) of the way through its
    key's own cost.
    """
    shares = cost_share(df, key, cost).select(
        F.col(key).alias("_key"),
        *[F.col(c).cast("double").alias(f"_{c}") for c in ("before", "cost", "total")],
    )
    place = (F.col("_before") + within * F.col("_cost")) / F.col("_total") * tasks
    task = F.coalesce(F.least(F.floor(place).cast("int"), F.lit(tasks - 1)), F.lit(0))
    joined = df.join(shares, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_task", task)
    return joined.repartitionById(tasks, "_task").select(*df.columns)


def _typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Frames of Arrow-typed columns: integers beside nulls stay integers."""
    for batch in batches:
        yield batch.to_pandas(types_mapper=pd.ArrowDtype)


def _back(frame: pd.DataFrame, arrow: pa.Schema) -> list[pa.RecordBatch]:
    table = pa.Table.from_pandas(frame, schema=arrow, preserve_index=False)
    return table.combine_chunks().to_batches()


def _batches(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Regroup Arrow chunks of key-sorted rows into one frame per key."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for value, rows in frame.groupby(key, sort=False):
            if held and held[0][key].iloc[0] != value:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held, ignore_index=True)


def score_batches(
    plan: DataFrame,
    load: Callable[[], Scorer],
    schema: str,
    partitions: int | None = None,
    order: tuple[str, ...] = ("tokens", "id"),
    cost: CostModel = Quadratic(),
) -> DataFrame:
    """Score batch by batch: a batch never splits, and one scorer serves a task's batches.

    Each task gets neighbouring batches of about the same summed ``cost`` of ``order``'s first
    column, which must not be negative.
    """

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load()
        for batch in _batches(_typed(frames), "batch_id"):
            yield from _back(scorer(batch), arrow)

    placed = _placed(plan, "batch_id", cost(F.col(order[0])), F.lit(0.5), _tasks(plan, partitions))
    return placed.sortWithinPartitions("batch_id", *order).mapInArrow(run, schema)


def score_all(
    df: DataFrame,
    load: Callable[[], Scorer],
    schema: str,
    order: tuple[str, ...] = ("tokens", "id"),
    partitions: int | None = None,
    cost: CostModel = Quadratic(),
) -> DataFrame:
    """Score everything as one job: similar sizes share a task, one scorer per task.

    Tasks take ranges of ``order``'s first column of about the same summed ``cost``, which must
    not be negative. Rows of a size that is too much for one task are dealt out by hash.
    """

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load()
        for frame in _typed(frames):
            yield from _back(scorer(frame), arrow)

    dealt = F.pmod(F.xxhash64(*order[1:]), F.lit(1 << 30)) / F.lit(float(1 << 30))
    placed = _placed(df, order[0], cost(F.col(order[0])), dealt, _tasks(df, partitions))
    return placed.sortWithinPartitions(*order).mapInArrow(run, schema)


def run_each(
    df: DataFrame,
    load: Callable[[], Callable[[dict], object]],
    result: str = "double",
    partitions: int | None = None,
) -> DataFrame:
    """Apply a step to each row by itself; a row's error is kept in ``error``, the rest go on.

    Input columns pass through as they are; the step gets Python values.
    """
    added = T.StructType.fromDDL(f"result {result}, error string")
    kinds = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = load()
        for batch in batches:
            results, errors = [], []
            for row in batch.to_pylist():
                try:
                    results.append(step(row))
                    errors.append(None)
                except Exception as error:
                    results.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            made = [pa.array(results, kinds.field(0).type), pa.array(errors, pa.string())]
            fields = [*batch.schema, kinds.field(0), kinds.field(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema=pa.schema(fields))

    schema = T.StructType([*df.schema.fields, *added.fields])
    return df.repartition(_tasks(df, partitions)).mapInArrow(run, schema)
