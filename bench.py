"""Time the headline queries; prints one JSON line."""

import json
import os
import time

from tallyloom.plans import load_all
from tallyloom.plans.registry import QUERIES
from tallyloom.session import local_session

HEADLINE = [
    "batch_plan", "batch_summary", "batch_members", "pending", "progress_counts",
    "stage_funnel", "size_order_index", "equal_effort_splits", "size_tier_a", "attempt_ladder",
    "jobname", "jobname_first_wins", "token_count", "compose_members", "compose_pairs",
    "compose_tokens", "distinct_members", "file_stats", "residue_lines", "log_capture",
    "event_assembly", "runtime_model", "quadratic_fit", "change_only", "array_series",
    "batched_scoring", "change_only_stream", "event_assembly_stream", "input_json_roundtrip",
    "fasta_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    load_all()
    # Load classes, generate code and start Python workers on the smallest data before timing.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        QUERIES[name](spark, small if os.path.isdir(small) else sf_dir).write.format("noop").mode(
            "overwrite"
        ).save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
