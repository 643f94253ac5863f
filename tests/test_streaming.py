"""Streams over several micro-batches give what the batch operators give over all rows."""

import random

import pytest

from tallyloom.operators import events
from tallyloom.sources import tables
from tallyloom.streaming import stateful
from tallyloom.streaming.carried import read_sink, stream_changes, stream_events

SCHEMA = "key int, t bigint, state string, v bigint"


def make(seed, n):
    rng = random.Random(seed)
    return [
        (1 if t % 3 == 0 else rng.randrange(2, 9), t, rng.choice("aab"), rng.randrange(100))
        for t in range(n)
    ]


@pytest.fixture
def arriving(spark, tmp_path):
    """Rows in time order over four files, read one file per micro-batch."""
    rows = make(11, 400)
    folder = tmp_path / "in"
    for n in range(4):
        part = rows[n * 100 : (n + 1) * 100]
        random.Random(n).shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return spark.createDataFrame(rows, SCHEMA), stream


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_stream_changes(spark, tmp_path, rows, arriving, hot_rows):
    batch, stream = arriving
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    query = stream_changes(
        stream, "state", ["key"], ["t"], sink, checkpoint, available_now=True, hot_rows=hot_rows
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 3
    expected = rows(events.changes_only(batch, "state", ["key"], ["t"]), "key", "t", "state", "v")
    assert rows(read_sink(spark, sink, SCHEMA), "key", "t", "state", "v") == expected


def captured(df):
    return df.selectExpr(
        "key", "t", "if(state = 'a', v, null) size",
        "if(state = 'b' and v < 50, t, null) done",
    )


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_stream_events_resume(spark, tmp_path, rows, arriving, hot_rows):
    """Stopped and started again on more files, the stream goes on where it was."""
    batch, stream = arriving
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream_events(
            captured(stream), ["key"], ["t"], ["size"], "done", sink, checkpoint,
            available_now=True, hot_rows=hot_rows,
        ).awaitTermination()

    run()
    more = [(k, t + 400, s, v) for k, t, s, v in make(12, 100)]
    extra = spark.createDataFrame(more, SCHEMA)
    extra.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    whole = captured(batch.unionAll(extra))
    expected = rows(
        events.assemble_events(whole, ["key"], ["t"], ["size"], "done"),
        "key", "size", "done", "complete",
    )
    schema = "key int, size bigint, done bigint, complete boolean"
    assert rows(read_sink(spark, sink, schema), "key", "size", "done", "complete") == expected


def run_stateful(results, tmp_path):
    query = stateful.start(results, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    return query


def test_stateful_changes_over_four_micro_batches(spark, tmp_path, rows, arriving):
    """One file a micro-batch, a third of all rows in one group."""
    batch, stream = arriving
    query = run_stateful(stateful.changes(stream, "state", ["key"], ["t"]), tmp_path)
    assert query.lastProgress["batchId"] >= 3
    expected = rows(events.changes_only(batch, "state", ["key"], ["t"]), "key", "t", "state", "v")
    assert rows(read_sink(spark, str(tmp_path / "out"), SCHEMA), "key", "t", "state", "v") == expected


def test_stateful_events_go_on_after_a_restart(spark, tmp_path, rows, arriving):
    batch, stream = arriving

    def run():
        run_stateful(stateful.assembled(captured(stream), ["key"], ["t"], ["size"], "done"), tmp_path)

    run()
    extra = spark.createDataFrame([(k, t + 400, s, v) for k, t, s, v in make(12, 100)], SCHEMA)
    extra.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    whole = captured(batch.unionAll(extra))
    columns = ("key", "size", "done", "complete")
    expected = rows(events.assemble_events(whole, ["key"], ["t"], ["size"], "done"), *columns)
    schema = "key int, size bigint, done bigint, complete boolean"
    assert rows(read_sink(spark, str(tmp_path / "out"), schema), *columns) == expected


def test_stateful_values_stay_as_they_are(spark, tmp_path, rows):
    """Nulls are values, in keys too, and long integers keep all digits."""
    given = [(1, 1, 2**60 + 1), (1, 2, 2**60 + 1), (1, 3, None), (1, 4, None), (None, 5, None), (None, 6, 2**60), (1, 7, 2**60)]
    schema = "key int, t bigint, v bigint"
    spark.createDataFrame(given, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run_stateful(stateful.changes(stream, "v", ["key"], ["t"]), tmp_path)
    found = rows(read_sink(spark, str(tmp_path / "out"), schema), "key", "t", "v")
    assert found == sorted([given[i] for i in (0, 2, 4, 5, 6)], key=repr)


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, rows, arriving):
    """Losing the last commit makes Spark run the last micro-batch again."""
    batch, stream = arriving
    sink, checkpoint = str(tmp_path / "out"), tmp_path / "ck"

    def run():
        stream_changes(
            stream, "state", ["key"], ["t"], sink, str(checkpoint), available_now=True
        ).awaitTermination()

    run()
    before = rows(read_sink(spark, sink, SCHEMA), "key", "t", "state", "v")
    (checkpoint / "offsets" / "commits" / "3").unlink()
    crc = checkpoint / "offsets" / "commits" / ".3.crc"
    if crc.exists():
        crc.unlink()
    run()
    assert rows(read_sink(spark, sink, SCHEMA), "key", "t", "state", "v") == before
    expected = rows(events.changes_only(batch, "state", ["key"], ["t"]), "key", "t", "state", "v")
    assert before == expected


SAMPLES = [
    "index, count, timestamp, name, utilization.gpu [%], utilization.memory [%], memory.total [MiB],"
    " memory.free [MiB], memory.used [MiB]",
    "0, 2, 2024/05/01 10:00:00.000, NVIDIA A100, 0, 0, 81920, 81920, 0",
    "1, 2, 2024/05/01 10:00:00.010, NVIDIA A100, 0, 0, 81920, 81000, 920",
    "0, 2, 2024/05/01 10:00:05.000, NVIDIA A100, 3, 0, 81920, 81920, 0",
    "1, 2, 2024/05/01 10:00:05.010, NVIDIA A100, 0, 0, 81920, 81000, 920",
    "0, 2, 2024/05/01 10:00:10.000, NVIDIA A100, 90, 10, 81920, 80000, 1920",
]


def test_gpu_telemetry(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(SAMPLES) + "\n")
    batch = tables.read_gpu_samples(spark, str(tmp_path / "in"))
    kept = events.changes_only(batch, "mem_used", ["index"], ["ts"])
    expected = [(0, 0.0), (0, 1920.0), (1, 920.0)]
    assert rows(kept, "index", "mem_used") == expected
    sink = str(tmp_path / "out")
    stream_changes(
        tables.stream_gpu_samples(spark, str(tmp_path / "in")), "mem_used", ["index"], ["ts"],
        sink, str(tmp_path / "ck"), available_now=True,
    ).awaitTermination()
    assert rows(read_sink(spark, sink, "index int, mem_used double"), "index", "mem_used") == expected
