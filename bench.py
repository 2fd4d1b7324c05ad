"""Wall time of the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Stores that several queries share are staged first and timed as ``stage_*``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from logflow.plans import QUERIES
from logflow.plans.base import events_store
from logflow.plans.scans import topics_store
from logflow.plans.sinks import duplicates_store, txn_store
from logflow.session import local_session

HEADLINE = [
    "user_balances",
    "log_scan",
    "log_scan_multi",
    "log_seek_offset",
    "resume_from_committed",
    "assign_offsets",
    "partition_round_robin",
    "per_key_order",
    "produce_append",
    "parse_action",
    "json_check_strict",
    "validate_record",
    "enrich_chain",
    "json_values",
    "enrich_with_fallback",
    "upsert_by_id",
    "read_committed",
    "send_metrics",
    "error_rate_alerts",
    "latency_percentiles",
    "running_batch_aggregates",
    "consumer_lag",
    "count_window",
    "time_range_window",
    "balance_history",
    "account_projection",
    "evolve_read",
    "stream_tumbling",
    "stream_balances",
    "stream_dedup",
    "stream_dead_letter",
    "sequence_dedup",
    "circuit_breaker",
]


def timed(work) -> float:
    begin = time.perf_counter()
    work()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before the clock
    times = {}
    for label, stage in (
        ("stage_events", events_store),
        ("stage_topics", topics_store),
        ("stage_duplicates", duplicates_store),
        ("stage_transactions", txn_store),
    ):
        times[label] = timed(lambda stage=stage: stage(spark, sf_dir))
    for name in names:
        times[name] = timed(
            lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
