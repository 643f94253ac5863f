"""The streaming forms: events arrive part by part, a stream stopped and started in between."""

from tallyloom.plans.log_queries import (
    CAPTURES,
    CHANGES_SQL,
    EVENT_ORDER,
    EVENTS_SQL,
    captured_events,
)
from tallyloom.plans.registry import query, table
from tallyloom.session import fresh_folder
from tallyloom.streaming.carried import read_sink
from tallyloom.streaming.stateful import assembled, changes, replayed, start


def arrived(spark, sf_dir, results, schema):
    """What ``results`` of a stream writes while all events arrive."""
    arriving, sink, checkpoint = (fresh_folder(spark, n) for n in ("arriving", "sink", "state"))
    replayed(
        table(spark, sf_dir, "events"), "ts", arriving,
        lambda stream: start(results(stream), sink, checkpoint, available_now=True),
    )
    return read_sink(spark, sink, schema)


@query("change_only_stream", CHANGES_SQL)
def change_only_stream(spark, sf_dir):
    def changed(stream):
        samples = stream.select("user_id", *EVENT_ORDER, "event_type")
        return changes(samples, "event_type", ["user_id"], EVENT_ORDER).drop("ts")

    return arrived(spark, sf_dir, changed, "user_id bigint, event_id bigint, event_type string")


@query("event_assembly_stream", EVENTS_SQL)
def event_assembly_stream(spark, sf_dir):
    def events(stream):
        return assembled(captured_events(stream), ["user_id"], EVENT_ORDER, CAPTURES, "done")

    schema = "user_id bigint, n_tokens bigint, runtime_sec double, done bigint, complete boolean"
    return arrived(spark, sf_dir, events, schema)
