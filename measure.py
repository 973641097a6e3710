"""

Each figure is the median of three runs after one to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import tablejobs as tj
from bench import session
from tablejobs.checks import CHECKS
from tablejobs.checks.fixtures import describe, source
from tablejobs.sinks.tables import write_files
from tablejobs.storage import drop_scratch, shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def median_seconds(action) -> float:
    taken = []
    for _ in range(4):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken[1:]), 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def show(metric: str, seconds: float, n_rows: int | None = None, **config) -> None:
    rate = {} if n_rows is None else {"rows_per_sec": round(n_rows / seconds)}
    print(json.dumps({"metric": metric, "sec": seconds, **rate, **config}), flush=True)


def writes(spark) -> None:
    lines = source(spark, SF_DIR, "lineitem")
    n_rows = lines.count()
    table = describe(lines, "lineitem", ("l_returnflag", "l_linestatus"))
    seconds = median_seconds(lambda: write_files(lines, table, shared_folder(spark, "lineitem")))
    show("partitioned ORC write", seconds, n_rows, partitions=6)

    text = describe(lines, "lineitem", storage="text", delimiter="\t")
    paths = []

    def write():
        paths.append(shared_folder(spark, "lineitem"))
        tj.write_text_table(lines, paths[-1], "\t")

    show("text write", median_seconds(write), n_rows, columns=len(lines.columns))
    scan = median_seconds(lambda: run(tj.scan_text_table(spark, text, paths[-1])))
    show("text scan", scan, n_rows, columns=len(lines.columns))
    raw = tj.scan_text_table(spark, text, paths[-1], typed=False)
    show("contract report", median_seconds(lambda: run(tj.check_contract(raw, text))), n_rows)


def snapshots(spark) -> None:
    orders = source(spark, SF_DIR, "orders")
    table = describe(orders, "orders", transactional=True)
    root = shared_folder(spark, "orders")
    tj.write_base(tj.insert_events(orders, table, 1, "o_orderkey", "0"), table, root, 1)
    n_rows = orders.count()
    for share in (0.0, 0.01, 0.1):
        snapshot = tj.Snapshot(1)
        if share:
            limit = orders.approxQuantile("o_totalprice", [share], 0.0)[0]
            snapshot = tj.Snapshot(int(share * 100) + 1)
            tj.apply_changes(
                spark, table, root, tj.Snapshot(1), snapshot.high_mark,
                assign={"o_orderstatus": "'U'"}, update_where=f"o_totalprice <= {limit}",
            )
        for name, threshold in (("broadcast", "10m"), ("shuffle", "-1")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            seconds = median_seconds(lambda: run(tj.snapshot_read(spark, table, root, snapshot)))
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            show("snapshot read", seconds, n_rows, changed=share, join=name)


def queries(spark) -> None:
    for name in [name for name in CHECKS if name.startswith("sql_")] + ["partition_filter"]:
        show(name, median_seconds(lambda: run(CHECKS[name][0](spark, SF_DIR))))


if __name__ == "__main__":
    spark = session()
    writes(spark)
    snapshots(spark)
    queries(spark)
    drop_scratch(spark)
    spark.stop()
