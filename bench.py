"""Time the queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, and
``BENCH_QUERIES`` (comma-separated, or ``all``) other queries than the headline
ones. Each query runs to the end into Spark's ``noop`` sink; one untimed query
warms the session up.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

# So small that the traces of sf0.1 (about 130 rows) cross chunks.
os.environ.setdefault("CELLMETER_CHUNK_ROWS", "64")

from cellmeter.plans.queries import QUERIES  # noqa: E402
from cellmeter.session import local_session  # noqa: E402

# One query per distinct plan; the others are parts or projections of these.
HEADLINE = [
    "ordered_messages", "message_count", "new_files", "malformed_split", "parse_props",
    "line_split", "rb_sequential", "rb_total_by_batch", "rb_histogram",
    "rb_histogram_by_batch", "topk_with_other", "queue_match_unmatched", "clock_fill",
    "fifo_latency", "latency_flush", "uplink_latency", "latency_by_batch", "stream_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(
        cores, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cellmeter-bench-")}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("uplink_latency")
    times = {name: run(name) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
