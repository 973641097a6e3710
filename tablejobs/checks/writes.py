"""Check queries of the sinks, copies and row operators. Each call writes tables of its own."""

from __future__ import annotations

from dataclasses import replace

import pandas as pd
from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks.fixtures import describe, new_database, once, source
from tablejobs.sinks.tables import write_files
from tablejobs.storage import quoted, shared_folder


def write_text_table(spark, sf_dir):
    df = source(spark, sf_dir, "orders")
    path = shared_folder(spark, "orders")
    tj.write_text_table(df, path, "\t")
    return tj.scan_text_table(spark, describe(df, "orders", storage="text", delimiter="\t"), path)


def write_table_modes(spark, sf_dir):
    """Keep, then update, then replace: only the rows of the last write are left."""
    df = source(spark, sf_dir, "orders")
    table = describe(df, "orders", database=new_database(spark))
    tj.write_table(df.where("o_orderstatus = 'F'"), table, "keep")
    tj.write_table(df.where("o_orderstatus = 'O'"), table, "update")
    tj.write_table(df, table, "replace")
    return tj.scan_table(spark, table.full_name)


def write_table_update(spark, sf_dir):
    df = source(spark, sf_dir, "orders")
    table = describe(df, "orders", database=new_database(spark))
    tj.write_table(df, table, "keep")
    tj.write_table(df.where("o_orderstatus = 'O'"), table, "update")
    return tj.scan_table(spark, table.full_name)


def drop_table(spark, sf_dir):
    """An external table is dropped: the rows stay at the declared place, a managed one leaves none."""
    df = source(spark, sf_dir, "customer")
    database = new_database(spark)
    kept = describe(df, "kept", database=database, location=shared_folder(spark, "kept"))
    gone = describe(df, "gone", database=database)
    for table in (kept, gone):
        tj.write_table(df, table)
        tj.drop_table(spark, table)
    tj.create_table(spark, gone)
    return tj.scan_at_location(spark, kept).unionByName(tj.scan_at_location(spark, gone))


def write_partitioned(spark, sf_dir):
    """Rows per partition, for the partitions the catalog knows."""
    df = source(spark, sf_dir, "lineitem")
    table = describe(df, "lineitem", ("l_returnflag", "l_linestatus"), database=new_database(spark))
    tj.write_partitioned(df, table)
    known = spark.sql(f"SHOW PARTITIONS {quoted(table.full_name)}")
    rows = tj.group_count(tj.scan_table(spark, table.full_name), table.partition_names, "n_rows")
    path = F.format_string("l_returnflag=%s/l_linestatus=%s", "l_returnflag", "l_linestatus")
    return rows.withColumn("partition", path).join(known, "partition")


def write_partitioned_overwrite(spark, sf_dir):
    """The second write replaces the one partition it touches."""
    df = source(spark, sf_dir, "orders")
    table = describe(df, "orders", ("o_orderpriority",), database=new_database(spark))
    tj.write_partitioned(df, table)
    changed = df.where("o_orderpriority = '3-MEDIUM'").withColumn("o_orderstatus", F.lit("X"))
    tj.write_partitioned(changed, table, "replace_partitions")
    return tj.scan_table(spark, table.full_name)


def register_partitions(spark, sf_dir):
    """Files put below a table's folder show up once their partitions are registered."""
    df = source(spark, sf_dir, "customer")
    table = describe(
        df, "customer", ("c_mktsegment",),
        database=new_database(spark), location=shared_folder(spark, "customer"),
    )
    tj.create_table(spark, table)
    write_files(df, table, table.location, mode="append")
    tj.register_partitions(spark, table, [{"c_mktsegment": "BUILDING"}])
    tj.register_partitions(spark, table, [{"c_mktsegment": "BUILDING"}])
    tj.register_partitions(spark, table)
    return tj.scan_table(spark, table.full_name)


def align_to_table(spark, sf_dir):
    """Rows with fewer columns, in another order and spelling."""
    df = source(spark, sf_dir, "customer")
    table = describe(df, "customer", ("c_nationkey",), database=new_database(spark))
    some = df.selectExpr("c_mktsegment AS C_MktSegment", "c_nationkey", "CAST(c_custkey AS string) AS c_custkey")
    tj.write_table(some, table)
    return tj.scan_table(spark, table.full_name)


def check_contract(spark, sf_dir):
    """A text table with values that do not fit its descriptor, partition column included."""
    df = source(spark, sf_dir, "customer")
    table = describe(df, "customer", ("c_mktsegment",), storage="text")
    planted = df.selectExpr(
        "c_custkey",
        "c_name",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE CAST(c_nationkey AS string) END AS c_nationkey",
        "CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE CAST(c_acctbal AS string) END AS c_acctbal",
        "CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment",
    )
    path = shared_folder(spark, "customer")
    write_files(planted, describe(planted, "customer", ("c_mktsegment",), storage="text"), path)
    return tj.check_contract(tj.scan_text_table(spark, table, path, typed=False), table)


def _customer_lines(spark, sf_dir):
    """All customers as lines: some with a field too many, some cut short, some with text for a number."""
    df = source(spark, sf_dir, "customer")

    def make():
        path = shared_folder(spark, "lines")
        df.selectExpr(
            """CASE WHEN c_custkey % 7 = 0 THEN concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'more')
                    WHEN c_custkey % 7 = 1 THEN concat_ws('|', c_custkey, c_name)
                    WHEN c_custkey % 7 = 2 THEN concat_ws('|', c_custkey, c_name, 'none', c_acctbal, c_mktsegment)
                    ELSE concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) END AS value"""
        ).write.text(path)
        return path

    return describe(df, "customer", storage="text", delimiter="|"), once(spark, sf_dir, "customer lines", make)


def check_contract_width(spark, sf_dir):
    """The report counts lines that are too long or too short."""
    table, path = _customer_lines(spark, sf_dir)
    return tj.check_contract(tj.scan_text_table(spark, table, path, typed=False, width=True), table)


def rejected_lines(spark, sf_dir):
    """Lines that are no rows, with the reason."""
    table, path = _customer_lines(spark, sf_dir)
    return tj.rejected_lines(tj.judged_lines(spark, table, path)).select("reason", "line")


def load_with_rejects(spark, sf_dir):
    """Rows go into the table, rejected lines into a folder of their own; both are counted by reason."""
    table, path = _customer_lines(spark, sf_dir)
    loaded = describe(source(spark, sf_dir, "customer"), "loaded", database=new_database(spark))
    loaded = replace(loaded, delimiter="|")
    rejects = shared_folder(spark, "rejects")
    tj.load_file(spark, path, loaded, rejects=rejects)
    rows = tj.scan_table(spark, loaded.full_name).select(F.lit("loaded").alias("outcome"), "c_acctbal")
    lines = spark.read.schema("file string, reason string, line string").json(rejects)
    lines = lines.select(F.col("reason").alias("outcome"), F.lit(None).cast("double").alias("c_acctbal"))
    sums = rows.unionByName(lines).groupBy("outcome")
    return sums.agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def discard(spark, sf_dir):
    n_rows = tj.discard(source(spark, sf_dir, "lineitem"))
    return spark.range(1).select(F.lit(n_rows).cast("bigint").alias("n_rows"))


def _orders_tables(spark, sf_dir):
    df = source(spark, sf_dir, "orders")
    database = new_database(spark)
    part = describe(df, "part", ("o_orderpriority",), database=database)
    plain = describe(df.drop("o_orderpriority"), "plain", database=database, storage="parquet")
    return df, part, plain


def copy_part_to_plain(spark, sf_dir):
    """The partition column is not in the target and is left out."""
    df, part, plain = _orders_tables(spark, sf_dir)
    tj.write_table(df, part)
    tj.copy_to_table(tj.scan_table(spark, part.full_name), plain)
    return tj.scan_table(spark, plain.full_name)


def copy_plain_to_part(spark, sf_dir):
    """The partition column is a constant."""
    df, part, plain = _orders_tables(spark, sf_dir)
    tj.copy_to_table(df, plain)
    tj.copy_to_table(tj.scan_table(spark, plain.full_name), part, constants={"o_orderpriority": "x"})
    return tj.scan_table(spark, part.full_name)


def copy_table_to_file(spark, sf_dir):
    df, part, _ = _orders_tables(spark, sf_dir)
    tj.write_table(df, part)
    path = shared_folder(spark, "orders")
    tj.copy_to_file(tj.scan_table(spark, part.full_name), path, "\t")
    order = part.data_names + part.partition_names
    file = describe(df.select(order), "orders", storage="text", delimiter="\t")
    return tj.scan_text_table(spark, file, path)


def copy_file_to_table(spark, sf_dir):
    df, part, _ = _orders_tables(spark, sf_dir)
    path = shared_folder(spark, "orders")
    tj.write_text_table(df, path, "\t")
    file = describe(df, "orders", storage="text", delimiter="\t")
    tj.copy_to_table(tj.scan_text_table(spark, file, path), part)
    return tj.scan_table(spark, part.full_name)


def write_with_options(spark, sf_dir):
    df = source(spark, sf_dir, "part")
    path = shared_folder(spark, "part")
    tj.write_text_table(df, path, "|", options={"compression": "gzip", "lineSep": ";\n"})
    table = describe(df, "part", storage="text", delimiter="|")
    return tj.scan_text_table(spark, table, path, options={"lineSep": ";\n"})


def load_file(spark, sf_dir):
    """Text files loaded over the rows a table holds."""
    df = source(spark, sf_dir, "supplier")
    path = shared_folder(spark, "supplier")
    table = describe(df, "supplier", database=new_database(spark), storage="text")
    tj.write_text_table(df, path, table.delimiter)
    tj.write_table(df, table)
    tj.load_file(spark, path, table, overwrite=True)
    return tj.scan_table(spark, table.full_name)


def remove_partitions(spark, sf_dir):
    """Partitions dropped, one of them not there, then a table emptied and filled again."""
    df = source(spark, sf_dir, "orders")
    table = describe(df, "orders", ("o_orderpriority",), database=new_database(spark))
    tj.write_table(df, table)
    tj.truncate_table(spark, table.full_name)
    tj.write_table(df, table, "keep")
    gone = [{"o_orderpriority": value} for value in ("1-URGENT", "5-LOW", "6-NONE")]
    tj.remove_partitions(spark, table.full_name, gone)
    return tj.scan_table(spark, table.full_name)


def step_metrics(spark, sf_dir):
    """Counters of four steps, two of them in one group, one of them of SQL statements that write and read."""
    metrics = tj.StepMetrics()
    orders, lines = source(spark, sf_dir, "orders"), source(spark, sf_dir, "lineitem")
    database = new_database(spark)
    partial = F.count_if(F.col("o_orderstatus") == "P")
    tj.write_table(
        orders,
        describe(orders, "orders", ("o_orderpriority",), database=database),
        watch=lambda rows: metrics.count(rows, "write", rows=F.count(F.lit(1)), partial=partial),
    )
    tj.write_table(metrics.count(lines, "write"), describe(lines, "lineitem", database=database))
    tj.discard(metrics.count(source(spark, sf_dir, "events"), "read"))
    held, copy = quoted(f"{database}.orders"), quoted(f"{database}.copy")
    tj.SqlStep(
        "sql",
        [
            f"CREATE TABLE {copy} (o_orderkey bigint, o_totalprice double) USING orc",
            f"INSERT INTO {copy} SELECT o_orderkey, o_totalprice FROM {held}",
            f"INSERT OVERWRITE {copy} SELECT o_orderkey, o_totalprice FROM {held} WHERE o_orderstatus = 'F'",
            f"SELECT * FROM {copy}",
        ],
        sources=[f"{database}.orders"],
    ).run(spark, metrics=metrics)
    return metrics.totals(spark).where("counter <> 'files_written'")


def map_columns(spark, sf_dir):
    return tj.map_columns(source(spark, sf_dir, "part"), ["p_name", "p_type"], F.upper)


def insert_constant(spark, sf_dir):
    return tj.insert_constant(source(spark, sf_dir, "customer"), "region", "EU")


def filter_rows(spark, sf_dir):
    return tj.filter_rows(source(spark, sf_dir, "orders"), "o_orderpriority", "2-HIGH")


def group_count(spark, sf_dir):
    return tj.group_count(source(spark, sf_dir, "events"), ["event_type"], "n_events")


def distinct_values(spark, sf_dir):
    big = source(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return tj.distinct_values(big, ["l_partkey"])


def order_rows(spark, sf_dir):
    return tj.order_rows(source(spark, sf_dir, "customer"), ["c_mktsegment"], ["c_custkey"])


def limit_rows(spark, sf_dir):
    df = source(spark, sf_dir, "orders")
    return tj.limit_rows(df, 20, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def apply_function(spark, sf_dir):
    def plain(segment: pd.Series) -> pd.Series:
        return segment.str.lower().str.replace("i", "1", regex=False)

    return tj.apply_function(
        source(spark, sf_dir, "customer"), plain, ["c_mktsegment"], "segment", "string"
    )


def apply_filter(spark, sf_dir):
    def is_ring(name: pd.Series) -> pd.Series:
        return name.str.endswith("ring")

    return tj.apply_filter(source(spark, sf_dir, "part"), is_ring, ["p_name"])


_CONTRACT = """
    SELECT 0 AS position, 'c_custkey' AS column_name, 'bigint' AS declared_type,
           CAST(0 AS BIGINT) AS bad_values, CAST(0 AS BIGINT) AS null_keys
    UNION ALL SELECT 1, 'c_name', 'string', 0, 0
    UNION ALL SELECT 2, 'c_nationkey', 'int', count(*), 0 FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT 3, 'c_acctbal', 'double', count(*), 0 FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 4, 'c_mktsegment', 'string', 0, count(*) FROM customer WHERE c_nationkey < 5
"""
_NO_PRIORITY = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"

QUERIES = {
    "write_text_table": (write_text_table, "SELECT * FROM orders"),
    "write_table_modes": (write_table_modes, "SELECT * FROM orders"),
    "write_table_update": (
        write_table_update,
        "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'",
    ),
    "drop_table": (drop_table, "SELECT * FROM customer"),
    "write_partitioned": (
        write_partitioned,
        """
        SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
               'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS partition
        FROM lineitem GROUP BY l_returnflag, l_linestatus
        """,
    ),
    "write_partitioned_overwrite": (
        write_partitioned_overwrite,
        """
        SELECT * FROM orders WHERE o_orderpriority <> '3-MEDIUM'
        UNION ALL
        SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderpriority = '3-MEDIUM'
        """,
    ),
    "register_partitions": (register_partitions, "SELECT * FROM customer"),
    "align_to_table": (
        align_to_table,
        """
        SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal,
               c_mktsegment, c_nationkey
        FROM customer
        """,
    ),
    "check_contract": (check_contract, _CONTRACT),
    "check_contract_width": (
        check_contract_width,
        """
        SELECT * FROM (VALUES
            (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
            (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string'), (5, '(line)', '5 fields')
        ) AS t(position, column_name, declared_type),
        LATERAL (SELECT CASE position WHEN 2 THEN count(*) FILTER (c_custkey % 7 = 2)
                                      WHEN 5 THEN count(*) FILTER (c_custkey % 7 < 2) ELSE 0 END AS bad_values,
                        CAST(0 AS BIGINT) AS null_keys FROM customer)
        """,
    ),
    "rejected_lines": (
        rejected_lines,
        """
        SELECT CASE c_custkey % 7 WHEN 0 THEN '6 fields instead of 5' WHEN 1 THEN '2 fields instead of 5'
                    ELSE 'column ''c_nationkey'' holds text that is no int' END AS reason,
               CASE c_custkey % 7
                    WHEN 0 THEN concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'more')
                    WHEN 1 THEN concat_ws('|', c_custkey, c_name)
                    ELSE concat_ws('|', c_custkey, c_name, 'none', c_acctbal, c_mktsegment) END AS line
        FROM customer WHERE c_custkey % 7 < 3
        """,
    ),
    "load_with_rejects": (
        load_with_rejects,
        """
        SELECT CASE c_custkey % 7 WHEN 0 THEN '6 fields instead of 5' WHEN 1 THEN '2 fields instead of 5'
                    WHEN 2 THEN 'column ''c_nationkey'' holds text that is no int' ELSE 'loaded' END AS outcome,
               count(*) AS n_lines, round(sum(c_acctbal) FILTER (c_custkey % 7 > 2), 2) AS balance
        FROM customer GROUP BY ALL
        """,
    ),
    "discard": (discard, "SELECT count(*) AS n_rows FROM lineitem"),
    "copy_part_to_plain": (copy_part_to_plain, f"{_NO_PRIORITY} FROM orders"),
    "copy_plain_to_part": (copy_plain_to_part, f"{_NO_PRIORITY}, 'x' AS o_orderpriority FROM orders"),
    "copy_table_to_file": (copy_table_to_file, "SELECT * FROM orders"),
    "copy_file_to_table": (copy_file_to_table, "SELECT * FROM orders"),
    "write_with_options": (write_with_options, "SELECT * FROM part"),
    "load_file": (load_file, "SELECT * FROM supplier"),
    "remove_partitions": (
        remove_partitions,
        "SELECT * FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')",
    ),
    "step_metrics": (
        step_metrics,
        """
        SELECT 'write' AS "group", 'rows' AS counter,
               (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS value
        UNION ALL
        SELECT 'write', 'partial', count(*) FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT 'read', 'rows', count(*) FROM events
        UNION ALL
        SELECT 'sql', 'rows', count(*) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT 'sql', 'rows_written', count(*) + count(*) FILTER (o_orderstatus = 'F') FROM orders
        """,
    ),
    "map_columns": (map_columns, "SELECT upper(p_name) AS p_name, upper(p_type) AS p_type FROM part"),
    "insert_constant": (insert_constant, "SELECT *, 'EU' AS region FROM customer"),
    "filter_rows": (filter_rows, "SELECT * FROM orders WHERE o_orderpriority = '2-HIGH'"),
    "group_count": (group_count, "SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type"),
    "distinct_values": (
        distinct_values,
        "SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'",
    ),
    "order_rows": (order_rows, "SELECT * FROM customer ORDER BY c_mktsegment, c_custkey"),
    "limit_rows": (limit_rows, "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"),
    "apply_function": (
        apply_function,
        "SELECT *, replace(lower(c_mktsegment), 'i', '1') AS segment FROM customer",
    ),
    "apply_filter": (apply_filter, "SELECT * FROM part WHERE p_name LIKE '%ring'"),
}
