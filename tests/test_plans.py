"""The plans Spark makes of the operators."""

import re

import pytest

import tablejobs as tj
from tablejobs.checks import CHECKS, snapshots
from tablejobs.checks.fixtures import describe, source
from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "Scan" in line]


def test_partition_filter_prunes_partitions_and_columns(spark):
    text = plan(CHECKS["filtered_partition_count"][0](spark, SMALL))
    scan = scans(text)[0]
    assert re.search(r"PartitionFilters: \[[^]]*o_orderpriority", scan)
    assert "ReadSchema: struct<>" in scan
    assert "partial_count" in text


def test_projection_reaches_the_scan(spark):
    scan = scans(plan(CHECKS["scan_partitioned_pruned"][0](spark, SMALL)))[0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in scan
    assert re.search(r"PartitionFilters: \[[^]]*l_returnflag", scan)


def test_base_rows_are_not_shuffled_when_few_rows_changed(spark):
    text = plan(CHECKS["snapshot_read"][0](spark, SMALL))
    base = text[text.index("BroadcastHashJoin"):text.index("BroadcastExchange")]
    assert "LeftAnti" in text and "Exchange" not in base


def test_more_changed_rows_are_joined_by_shuffle(spark):
    text = plan(CHECKS["snapshot_read_by_shuffle"][0](spark, SMALL))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_partitions_without_changes_skip_the_join(spark):
    table, root = snapshots._partitioned(spark, SMALL)
    text = plan(tj.snapshot_read(spark, table, root, tj.Snapshot(1)))
    assert "op" in text
    text = plan(tj.snapshot_read(spark, table, root, tj.Snapshot(2)))
    direct = [line for line in scans(text) if "InMemoryFileIndex(3 paths)" in line]
    assert len(direct) == 1 and "row_id" not in direct[0].split("Batched")[0]


def test_snapshot_reads_wanted_fields_only(spark):
    table, root = snapshots._base_with_deltas(spark, SMALL)
    text = plan(tj.snapshot_read(spark, table, root, tj.Snapshot(7), columns=["o_totalprice"]))
    assert "data:struct<o_totalprice:double>" in text and "o_custkey" not in text


def test_newest_event_is_combined_before_the_shuffle(spark):
    assert "partial_max_by" in plan(CHECKS["snapshot_delta_only"][0](spark, SMALL))


def test_changed_keys_are_shuffled_once(spark):
    text = plan(CHECKS["snapshot_read_by_shuffle"][0](spark, SMALL))
    join = text[text.index("SortMergeJoin"):text.index("max_by")]
    # One exchange for the base, one for the changed row ids: their grouping serves the join too.
    assert join.count("Exchange hashpartitioning") == 2


def test_deltas_of_inserts_are_read_without_a_shuffle(spark):
    df, table = snapshots._orders(spark, SMALL)
    from tablejobs.storage import shared_folder

    root = shared_folder(spark, "inserts")
    for txn in (1, 2):
        part = df.where(f"o_orderkey % 2 = {txn - 1}")
        tj.write_delta(tj.insert_events(part, table, txn, "o_orderkey", "0"), table, root, txn)
    got = tj.snapshot_read(spark, table, root, tj.Snapshot(2))
    text = plan(got)
    assert "Exchange" not in text and "Join" not in text and len(scans(text)) == 1
    assert got.count() == df.count()


@pytest.mark.parametrize("name", ["snapshot_bucketed", "snapshot_bucketed_partitioned"])
def test_buckets_are_merged_without_a_shuffle(spark, name):
    text = plan(CHECKS[name][0](spark, SMALL))
    assert "Exchange" not in text and "Join" not in text
    assert re.search(r"Bucketed: true|SelectedBucketsCount", text)


def test_large_buckets_are_spread_by_a_shuffle(spark, monkeypatch):
    from tablejobs.sources import snapshot

    few = sorted(map(tuple, CHECKS["snapshot_bucketed"][0](spark, SMALL).collect()))
    monkeypatch.setattr(snapshot, "BUCKET_ROWS", 100)
    df = CHECKS["snapshot_bucketed"][0](spark, SMALL)
    assert "Exchange" in plan(df) and sorted(map(tuple, df.collect())) == few


def test_partitioned_write_is_rebalanced_only_under_adaptive_execution(spark):
    from tablejobs.sinks.tables import rebalanced

    df = source(spark, SMALL, "orders")
    assert "REBALANCE" in plan(rebalanced(df, ["o_orderpriority"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in plan(rebalanced(df, ["o_orderpriority"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_hot_partition_is_cut_into_pieces(spark, database):
    """One partition holds all rows: several tasks write it."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = source(spark, "/root/testdata/sf0.1", "orders").repartition(16).selectExpr("*", "'x' AS p")
        table = describe(df, "hot", ("p",), database=database)
        tj.write_partitioned(df, table)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(spark.table(table.full_name).inputFiles()) > 4


def test_contract_report_is_one_pass(spark):
    text = plan(CHECKS["check_contract"][0](spark, SMALL))
    assert len(scans(text)) == 1


@pytest.mark.parametrize("name", ["sql_window"])
def test_window_is_limited_before_the_shuffle(spark, name):
    text = plan(CHECKS[name][0](spark, SMALL))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["scan_text_table", "map_columns", "check_contract", "sql_json"])
def test_no_python_in_the_hot_path(spark, name):
    assert "Python" not in plan(CHECKS[name][0](spark, SMALL))
