"""Times the headline queries and prints one JSON line.

Each query is run once to warm up, which also writes the inputs that scans read, then three times; the
median counts. Every row of every result is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablejobs.checks import CHECKS  # noqa: E402
from tablejobs.storage import drop_scratch  # noqa: E402

HEADLINE = [
    "filtered_partition_count",
    "partition_filter",
    "scan_text_table",
    "scan_table_text",
    "scan_partitioned",
    "write_text_table",
    "write_partitioned",
    "write_table_modes",
    "check_contract",
    "snapshot_read",
    "snapshot_read_by_shuffle",
    "snapshot_delta_only",
    "apply_changes",
    "copy_file_to_table",
    "query_inputs",
    "run_sql_steps",
    "apply_function",
    "sql_join",
    "sql_semi_anti",
    "sql_aggregate",
    "sql_rollup",
    "sql_window",
    "sql_set_ops",
    "sql_datetime_string",
    "sql_json",
]


def session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    CHECKS[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = session()
    seconds = {}
    for name in names:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(3)), 4)
    total = round(sum(seconds.values()), 4)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps(
        {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
    ))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
