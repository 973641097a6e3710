"""Check queries of transactional tables: orders as a base with changes in deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks.fixtures import describe, once, source
from tablejobs.sinks.changes import PUBLIC_LAYOUT
from tablejobs.sources.snapshot import DELETE
from tablejobs.storage import shared_folder

ROW_ID, BUCKET = "o_orderkey", "o_orderkey % 4"


def _orders(spark, sf_dir, keys=(), buckets=0):
    df = source(spark, sf_dir, "orders")
    return df, describe(df, "orders", keys, transactional=True, buckets=buckets)


def _base_with_deltas(spark, sf_dir, buckets=0):
    """Base of transaction 5, an update in 6, a delete in 7, an update in 9 that readers may not see."""
    df, table = _orders(spark, sf_dir, buckets=buckets)

    def make():
        root = shared_folder(spark, "orders")
        tj.write_base(tj.insert_events(df, table, 1, ROW_ID, BUCKET), table, root, 5)
        tj.apply_changes(
            spark, table, root, tj.Snapshot(5), 6,
            assign={"o_orderstatus": "'U'"}, update_where="o_orderpriority = '1-URGENT'",
        )
        tj.apply_changes(
            spark, table, root, tj.Snapshot(6), 7,
            delete_where="o_orderpriority = '5-LOW' AND o_orderstatus = 'F'",
        )
        tj.apply_changes(
            spark, table, root, tj.Snapshot(7), 9,
            assign={"o_totalprice": "o_totalprice * 2"}, update_where="o_orderstatus = 'O'",
        )
        return root

    return table, once(spark, sf_dir, f"orders base {buckets}", make)


def snapshot_read(spark, sf_dir):
    table, root = _base_with_deltas(spark, sf_dir)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(7))


def snapshot_read_by_shuffle(spark, sf_dir):
    """The same rows in a session in which nothing is broadcast."""
    table, root = _base_with_deltas(spark, sf_dir)
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return tj.snapshot_read(session, table, root, tj.Snapshot(7))


def snapshot_read_open_txn(spark, sf_dir):
    table, root = _base_with_deltas(spark, sf_dir)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(7, {6}))


def snapshot_row_id(spark, sf_dir):
    table, root = _base_with_deltas(spark, sf_dir)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(7), row_id=True)


def snapshot_bucketed(spark, sf_dir):
    """The same rows of a table with buckets: base and deltas are merged without a shuffle."""
    table, root = _base_with_deltas(spark, sf_dir, buckets=8)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(7))


def snapshot_bucketed_partitioned(spark, sf_dir):
    """Buckets inside partitions, and a delta that reaches across a newer base."""
    df, table = _orders(spark, sf_dir, ("o_orderpriority",), 4)

    def make():
        root = shared_folder(spark, "orders")
        rows = tj.insert_events(df, table, 1, ROW_ID, BUCKET)
        tj.write_base(rows, table, root, 1)
        tj.apply_changes(
            spark, table, root, tj.Snapshot(1), 2,
            assign={"o_orderstatus": "lower(o_orderstatus)"},
            update_where="o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F'",
            delete_where="o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'",
        )
        return root

    return tj.snapshot_read(spark, table, once(spark, sf_dir, "orders buckets", make), tj.Snapshot(2))


def _statuses(df):
    return [row[0] for row in df.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]


def snapshot_delta_only(spark, sf_dir):
    """No base: one insert transaction per order status, then an update over all of them."""
    df, table = _orders(spark, sf_dir)

    def make():
        root = shared_folder(spark, "orders")
        found = _statuses(df)
        for txn, status in enumerate(found, start=1):
            rows = df.where(df.o_orderstatus.eqNullSafe(status))
            tj.write_delta(tj.insert_events(rows, table, txn, ROW_ID, BUCKET), table, root, txn)
        tj.apply_changes(
            spark, table, root, tj.Snapshot(len(found)), len(found) + 1,
            assign={"o_orderpriority": "'0-NOW'"}, update_where="o_totalprice > 400000",
        )
        return root

    root = once(spark, sf_dir, "orders deltas", make)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(len(_statuses(df)) + 1), row_id=True)


def _partitioned(spark, sf_dir):
    df, table = _orders(spark, sf_dir, ("o_orderpriority",))

    def make():
        root = shared_folder(spark, "orders")
        tj.write_base(tj.insert_events(df, table, 1, ROW_ID, BUCKET), table, root, 1)
        tj.apply_changes(
            spark, table, root, tj.Snapshot(1), 2,
            assign={"o_orderstatus": "lower(o_orderstatus)"},
            update_where="o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F'",
            delete_where="o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'",
        )
        return root

    return table, once(spark, sf_dir, "orders partitioned base", make)


def snapshot_partitioned(spark, sf_dir):
    table, root = _partitioned(spark, sf_dir)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(2))


def snapshot_partition_filter(spark, sf_dir):
    table, root = _partitioned(spark, sf_dir)
    return tj.snapshot_read(
        spark, table, root, tj.Snapshot(2), predicate="o_orderpriority >= '3-MEDIUM'"
    )


def apply_changes(spark, sf_dir):
    """Update and delete as one new delta, then read: the write is part of the query."""
    df = source(spark, sf_dir, "customer")
    table = describe(df, "customer", transactional=True)
    root = shared_folder(spark, "customer")
    tj.write_base(tj.insert_events(df, table, 1, "c_custkey", "0"), table, root, 1, check=False)
    tj.apply_changes(
        spark, table, root, tj.Snapshot(1), 2,
        assign={"c_mktsegment": "concat(c_mktsegment, '-VIP')", "c_acctbal": "c_acctbal + 1"},
        update_where="c_acctbal > 9000", delete_where="c_acctbal < 0",
    )
    return tj.snapshot_read(spark, table, root, tj.Snapshot(2))


def adopt_files(spark, sf_dir):
    """A base and a delta in the public ORC layout, taken over and read."""
    df, table = _orders(spark, sf_dir, ("o_orderstatus",))
    foreign, root = shared_folder(spark, "foreign"), shared_folder(spark, "orders")
    for folder, events in (
        ("base_0000001", tj.insert_events(df, table, 1, ROW_ID, BUCKET)),
        (
            "delta_0000002_0000002",
            tj.insert_events(df.where("o_orderpriority = '5-LOW'"), table, 1, ROW_ID, BUCKET)
            .withColumn("op", F.lit(DELETE))
            .withColumn("txn", F.lit(2).cast("bigint")),
        ),
    ):
        for status in _statuses(df):
            part = events.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
            part.toDF(*PUBLIC_LAYOUT).write.orc(f"{foreign}/o_orderstatus={status}/{folder}")
    tj.adopt_files(spark, table, foreign, root)
    return tj.snapshot_read(spark, table, root, tj.Snapshot(2))


_UPDATED = """
    SELECT {row_id} o_orderkey, {more}
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS o_orderstatus {rest}
    FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
"""
_ALL = {"row_id": "", "more": "o_custkey,", "rest": ", o_totalprice, o_orderdate, o_orderpriority"}
_CHANGED_PARTITIONS = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F' THEN lower(o_orderstatus)
                ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')
"""

QUERIES = {
    "snapshot_read": (snapshot_read, _UPDATED.format(**_ALL)),
    "snapshot_read_by_shuffle": (snapshot_read_by_shuffle, _UPDATED.format(**_ALL)),
    "snapshot_bucketed": (snapshot_bucketed, _UPDATED.format(**_ALL)),
    "snapshot_bucketed_partitioned": (snapshot_bucketed_partitioned, _CHANGED_PARTITIONS),
    "snapshot_read_open_txn": (
        snapshot_read_open_txn,
        "SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')",
    ),
    "snapshot_row_id": (
        snapshot_row_id,
        _UPDATED.format(
            row_id="CAST(1 AS BIGINT) AS orig_txn, CAST(o_orderkey % 4 AS INTEGER) AS bucket, "
            "o_orderkey AS row_id,",
            more=_ALL["more"], rest=_ALL["rest"],
        ),
    ),
    "snapshot_delta_only": (
        snapshot_delta_only,
        """
        SELECT CAST(dense_rank() OVER (ORDER BY o_orderstatus) AS BIGINT) AS orig_txn,
               CAST(o_orderkey % 4 AS INTEGER) AS bucket, o_orderkey AS row_id,
               o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_totalprice > 400000 THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority
        FROM orders
        """,
    ),
    "snapshot_partitioned": (snapshot_partitioned, _CHANGED_PARTITIONS),
    "snapshot_partition_filter": (
        snapshot_partition_filter,
        _CHANGED_PARTITIONS + " AND o_orderpriority >= '3-MEDIUM'",
    ),
    "adopt_files": (
        adopt_files,
        """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
        FROM orders WHERE o_orderpriority <> '5-LOW'
        """,
    ),
    "apply_changes": (
        apply_changes,
        """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_acctbal > 9000 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_acctbal > 9000 THEN c_mktsegment || '-VIP' ELSE c_mktsegment END AS c_mktsegment
        FROM customer WHERE NOT c_acctbal < 0
        """,
    ),
}
