"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores, ``BENCH_REPEATS`` the timed runs
after a warm-up of all (the median counts). With ``BENCH_DUCKDB=1`` the SQL of each query is timed too.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from lakegauge.checks.oracles import ORACLES
from lakegauge.checks.queries import QUERIES
from lakegauge.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "join_report_orders",
    "join_report_composite",
    "join_report_by_season",
    "unmatched_orders_sample",
    "duplicate_line_keys",
    "match_marker",
    "coverage_report",
    "coverage_by_season",
    "pooled_distinct",
    "null_inclusive_distinct",
    "prev_event",
    "running_total_by_user",
    "group_sum_cents",
    "filtered_min_event",
    "strict_cast_lines",
    "name_parts",
    "fingerprint",
    "pending_loads",
    "checksum_statuses",
    "compare_statuses",
    "row_difference",
    "compare_to_answer_key",
    "canonical_fields",
    "archive_roundtrip",
    "shotdetail_event_join",
    "season_view",
]


def median_seconds(run) -> float:
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def duckdb_seconds(names: list[str]) -> dict[str, float]:
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"SET threads = {CPUS}")
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    runs = {n: lambda n=n: connection.execute(ORACLES[n]).to_arrow_table() for n in names}
    for run in runs.values():
        run()
    return {n: median_seconds(run) for n, run in runs.items()}


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str):
        return lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    # All queries run once before any is timed: the first ones would else pay for the JVM's warming up.
    for name in names:
        run(name)()
    seconds = {name: median_seconds(run(name)) for name in names}
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    result = {
        "metric": "total seconds over headline queries (median per query, warm)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else SF_DIR,
    }
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_seconds(names)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
