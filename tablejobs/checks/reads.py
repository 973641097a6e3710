"""Check queries of the scans: an input table is written once, the query reads it."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks.fixtures import describe, new_database, once, source
from tablejobs.sinks.tables import write_files
from tablejobs.storage import quoted, shared_folder


def _catalog_table(spark, sf_dir, name, keys=(), **more):
    """Full name of a catalog table with the rows of a given table."""

    def make():
        df = source(spark, sf_dir, name)
        table = describe(df, name, keys, database=new_database(spark), **more)
        tj.write_table(df, table)
        return table.full_name

    return once(spark, sf_dir, f"catalog {name} {keys} {more}", make)


def _orders_by_priority(spark, sf_dir):
    return _catalog_table(spark, sf_dir, "orders", ("o_orderpriority",))


def scan_text_table(spark, sf_dir):
    df = source(spark, sf_dir, "customer")
    table = describe(df, "customer", storage="text")

    def make():
        path = shared_folder(spark, "customer")
        tj.write_text_table(df, path, table.delimiter)
        return path

    return tj.scan_text_table(spark, table, once(spark, sf_dir, "customer text", make))


def scan_table_orc(spark, sf_dir):
    return tj.scan_table(spark, _catalog_table(spark, sf_dir, "supplier"))


def scan_table_parquet(spark, sf_dir):
    return tj.scan_table(spark, _catalog_table(spark, sf_dir, "events", storage="parquet"))


def scan_table_text(spark, sf_dir):
    name = _catalog_table(spark, sf_dir, "orders", ("o_orderstatus",), storage="text", delimiter="\t")
    return tj.scan_table(spark, name)


def scan_table_sequencefile(spark, sf_dir):
    df = source(spark, sf_dir, "part")
    table = describe(df, "part", storage="sequencefile")

    def make():
        path = shared_folder(spark, "part")
        tj.write_sequence_table(df, table, path)
        return path

    return tj.scan_sequence_table(spark, table, once(spark, sf_dir, "part sequence", make))


def scan_nested_types(spark, sf_dir):
    df = tj.scan_table(spark, _catalog_table(spark, sf_dir, "embeddings"))
    every = df.select("vec_id", "label", F.posexplode("embedding").alias("place", "value"))
    return every.withColumn("value", F.col("value").cast("double"))


def project_fields(spark, sf_dir):
    return tj.scan_table(spark, _orders_by_priority(spark, sf_dir), ["O_TotalPrice", "o_orderkey"])


def partition_filter(spark, sf_dir):
    predicate = "o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'"
    return tj.scan_table(spark, _orders_by_priority(spark, sf_dir), None, predicate)


def partition_filter_ignored(spark, sf_dir):
    name = _catalog_table(spark, sf_dir, "orders")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return tj.scan_table(spark, name, None, "o_orderpriority = '1-URGENT'")


def _lineitem_files(spark, sf_dir):
    df = source(spark, sf_dir, "lineitem")
    table = describe(df, "lineitem", ("l_returnflag", "l_linestatus"))

    def make():
        path = shared_folder(spark, "lineitem")
        write_files(df, table, path)
        return path

    return table, once(spark, sf_dir, "lineitem files", make)


def scan_partitioned(spark, sf_dir):
    table, path = _lineitem_files(spark, sf_dir)
    return tj.scan_partitioned(spark, table, path)


def scan_partitioned_pruned(spark, sf_dir):
    table, path = _lineitem_files(spark, sf_dir)
    fields = ["l_linestatus", "l_orderkey", "l_quantity"]
    return tj.scan_partitioned(spark, table, path, fields, "l_returnflag = 'R'")


def scan_at_location(spark, sf_dir):
    """The descriptor names no place: the catalog's wins over the usual one."""
    df = source(spark, sf_dir, "customer")

    def make():
        away = describe(
            df, "customer", database=new_database(spark), location=shared_folder(spark, "away")
        )
        tj.write_table(df, away)
        return away.database

    database = once(spark, sf_dir, "customer away", make)
    return tj.scan_at_location(spark, describe(df, "customer", database=database))


def query_inputs(spark, sf_dir):
    """Rows per base table of a view over a view that joins three tables: partitioned, read twice, without rows."""

    def make():
        orders = _orders_by_priority(spark, sf_dir)
        customer = _catalog_table(spark, sf_dir, "customer")
        database = new_database(spark)
        inner, outer = quoted(f"{database}.inner_view"), quoted(f"{database}.outer_view")
        tj.run_sql_steps(
            spark,
            [
                f"CREATE TABLE {quoted(f'{database}.returned')} (r_orderkey BIGINT) USING orc",
                f"CREATE VIEW {inner} AS SELECT * FROM {quoted(orders)} JOIN {quoted(customer)} "
                "ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'",
                f"CREATE VIEW {outer} AS SELECT o_orderkey, c_name FROM {inner} "
                f"LEFT JOIN {quoted(f'{database}.returned')} ON o_orderkey = r_orderkey "
                f"WHERE o_totalprice >= (SELECT min(o_totalprice) FROM {quoted(orders)} WHERE o_orderpriority = '2-HIGH')",
            ],
        )
        return outer

    view = once(spark, sf_dir, "views", make)
    found = tj.query_inputs(spark, f"SELECT * FROM {view}")
    return found.select(
        F.regexp_extract("table", "[^.]+$", 0).alias("table_name"),
        F.regexp_extract("input", "[^/]+$", 0).alias("input"),
        "n_rows",
    )


def flagship(spark, sf_dir):
    """Rows per chosen partition of a partitioned table."""
    predicate = "o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'"
    fields = ["o_orderdate", "o_orderpriority"]
    chosen = tj.scan_table(spark, _orders_by_priority(spark, sf_dir), fields, predicate)
    return tj.group_count(chosen, ["o_orderpriority"], "n_orders")


QUERIES = {
    "scan_text_table": (scan_text_table, "SELECT * FROM customer"),
    "scan_table_orc": (scan_table_orc, "SELECT * FROM supplier"),
    "scan_table_parquet": (scan_table_parquet, "SELECT * FROM events"),
    "scan_table_text": (scan_table_text, "SELECT * FROM orders"),
    "scan_table_sequencefile": (scan_table_sequencefile, "SELECT * FROM part"),
    "scan_nested_types": (
        scan_nested_types,
        """
        SELECT vec_id, label, CAST(place - 1 AS INTEGER) AS place, CAST(embedding[place] AS DOUBLE) AS value
        FROM (SELECT *, unnest(generate_series(1, len(embedding))) AS place FROM embeddings)
        """,
    ),
    "project_fields": (
        project_fields,
        'SELECT o_totalprice AS "O_TotalPrice", o_orderkey FROM orders',
    ),
    "partition_filter": (
        partition_filter,
        "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    ),
    "partition_filter_ignored": (partition_filter_ignored, "SELECT * FROM orders"),
    "scan_partitioned": (
        scan_partitioned,
        """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus
        FROM lineitem
        """,
    ),
    "scan_partitioned_pruned": (
        scan_partitioned_pruned,
        "SELECT l_linestatus, l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'",
    ),
    "scan_at_location": (scan_at_location, "SELECT * FROM customer"),
    "query_inputs": (
        query_inputs,
        """
        SELECT 'orders' AS table_name, 'orders' AS input, count(*) AS n_rows FROM orders WHERE o_orderpriority <> '5-LOW'
        UNION ALL
        SELECT 'customer', 'customer', count(*) FROM customer
        UNION ALL
        SELECT 'returned', 'returned', 0
        """,
    ),
    "filtered_partition_count": (
        flagship,
        """
        SELECT o_orderpriority, count(*) AS n_orders FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority
        """,
    ),
}
