"""Check queries of joins by time, each with a key that holds a third of the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks.fixtures import source

_HOT = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"


def _clicks(spark, sf_dir):
    events = source(spark, sf_dir, "events").withColumn("user", F.expr(_HOT))
    clicks = events.where("event_type = 'click'").select(
        "user", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id")
    )
    return events.where("event_type <> 'click'").select("event_id", "user", "ts"), clicks


def asof_join(spark, sf_dir):
    """The last click of the user before each other event."""
    others, clicks = _clicks(spark, sf_dir)
    return tj.asof_join(others, clicks, ["user"], "ts", "click_ts")


def asof_join_hot_key(spark, sf_dir):
    """The same with keys of more than 500 rows cut into ranges, and clicks of the last hour only."""
    others, clicks = _clicks(spark, sf_dir)
    return tj.asof_join(others, clicks, ["user"], "ts", "click_ts", tolerance=3_600_000_000, hot_rows=500)


def asof_join_last_order(spark, sf_dir):
    """The last order of the customer before each event of the user of that number, in years that overlap."""
    events = source(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("custkey"), "ts")
    events = events.withColumn("ts", F.expr("ts - make_interval(25)"))
    orders = source(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("ordered"), F.col("o_orderkey").alias("last_order")
    )
    return tj.asof_join(events, orders, ["custkey"], "ts", "ordered")


def interval_join(spark, sf_dir):
    """Orders and shipments of one supplier or customer number whose spans overlap; number 0 holds a third of both."""
    orders = source(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_custkey % 100 < 33 THEN 0 ELSE o_custkey END").alias("number"),
        F.to_date("o_orderdate").alias("open_from"),
        F.expr("date_add(to_date(o_orderdate), CAST(o_orderkey % 5 AS INT))").alias("open_to"),
    )
    lines = source(spark, sf_dir, "lineitem").where("l_quantity = 50").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("CASE WHEN l_suppkey % 100 < 33 THEN 0 ELSE l_suppkey END").alias("number"),
        F.to_date("l_shipdate").alias("ship_from"),
        F.expr("date_add(to_date(l_shipdate), CAST(l_orderkey % 7 AS INT))").alias("ship_to"),
    )
    pairs = tj.interval_join(orders, lines, ("open_from", "open_to"), ("ship_from", "ship_to"), ["number"])
    return pairs.groupBy("number").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum("o_orderkey").alias("orders"),
        F.sum(F.col("l_orderkey") * F.col("l_linenumber")).alias("lines"),
    )


def interval_join_mixed_lengths(spark, sf_dir):
    """Ranges of whole numbers, from one to many thousands long, without a key."""
    parts = source(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 40).alias("low"))
    parts = parts.withColumn("high", F.expr("low + CASE WHEN p_partkey % 97 = 0 THEN 30000 ELSE p_partkey % 11 END"))
    customers = source(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 53).alias("first"))
    customers = customers.withColumn("last", F.expr("first + CASE WHEN c_custkey % 89 = 0 THEN 9000 ELSE c_custkey % 13 END"))
    pairs = tj.interval_join(parts, customers, ("low", "high"), ("first", "last"))
    return pairs.select("p_partkey", "c_custkey")


_ASOF = """
    WITH e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS "user", ts, event_type FROM events)
    SELECT a.event_id, a."user", a.ts, {time} AS click_ts, {id} AS click_id
    FROM (SELECT * FROM e WHERE event_type <> 'click') a
    ASOF LEFT JOIN (
        SELECT "user", ts, max(event_id) AS event_id FROM e WHERE event_type = 'click' GROUP BY ALL
    ) b ON a."user" = b."user" AND a.ts >= b.ts
"""

QUERIES = {
    "asof_join": (asof_join, _ASOF.format(time="b.ts", id="b.event_id")),
    "asof_join_hot_key": (
        asof_join_hot_key,
        _ASOF.format(
            time="CASE WHEN a.ts - b.ts <= INTERVAL 1 HOUR THEN b.ts END",
            id="CASE WHEN a.ts - b.ts <= INTERVAL 1 HOUR THEN b.event_id END",
        ),
    ),
    "asof_join_last_order": (
        asof_join_last_order,
        """
        SELECT a.event_id, a.custkey, a.ts, b.ordered, b.last_order
        FROM (SELECT event_id, user_id AS custkey, ts - INTERVAL 25 YEAR AS ts FROM events) a
        ASOF LEFT JOIN (
            SELECT o_custkey, o_orderdate AS ordered, max(o_orderkey) AS last_order FROM orders GROUP BY ALL
        ) b ON a.custkey = b.o_custkey AND a.ts >= b.ordered
        """,
    ),
    "interval_join": (
        interval_join,
        """
        SELECT o.number, count(*) AS n_pairs, CAST(sum(o_orderkey) AS BIGINT) AS orders,
               CAST(sum(l_orderkey * l_linenumber) AS BIGINT) AS lines
        FROM (SELECT o_orderkey, CASE WHEN o_custkey % 100 < 33 THEN 0 ELSE o_custkey END AS number,
                     CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS b
              FROM orders) o
        JOIN (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 100 < 33 THEN 0 ELSE l_suppkey END AS number,
                     CAST(l_shipdate AS DATE) AS c, CAST(l_shipdate AS DATE) + CAST(l_orderkey % 7 AS INTEGER) AS d
              FROM lineitem WHERE l_quantity = 50) l
          ON o.number = l.number AND a <= d AND c <= b
        GROUP BY o.number
        """,
    ),
    "interval_join_mixed_lengths": (
        interval_join_mixed_lengths,
        """
        SELECT p_partkey, c_custkey FROM part JOIN customer
          ON p_partkey * 40 <= c_custkey * 53 + CASE WHEN c_custkey % 89 = 0 THEN 9000 ELSE c_custkey % 13 END
         AND c_custkey * 53 <= p_partkey * 40 + CASE WHEN p_partkey % 97 = 0 THEN 30000 ELSE p_partkey % 11 END
        """,
    ),
}
