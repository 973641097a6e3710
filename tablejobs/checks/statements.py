"""Check queries of SQL steps.

Sums are taken over whole units (cents for amounts with two decimals): unlike a sum of doubles they do
not depend on the order of the rows, and as decimals they cannot overflow.
"""

from __future__ import annotations

import tablejobs as tj
from tablejobs.checks.fixtures import describe, new_database, source
from tablejobs.storage import literal, quoted


def _views(sf_dir, names):
    return [
        f"CREATE TEMPORARY VIEW {name} USING parquet OPTIONS (path {literal(f'{sf_dir}/{name}.parquet')})"
        for name in names
    ]


def _answer(spark, sf_dir, names, statements, settings=None):
    """Rows of the last statement of a step that sees the given tables as views."""
    step = tj.SqlStep("check", _views(sf_dir, names) + statements, sources=names, settings=settings)
    return step.run(spark, keep_results=True, store_results=False)[-1]


def run_sql_steps(spark, sf_dir):
    table = quoted(f"{new_database(spark)}.keyed")
    return _answer(
        spark, sf_dir, ["customer", "supplier"],
        [
            f"CREATE TABLE {table} (kind string, name string) USING orc",
            f"INSERT INTO {table} SELECT 'old', c_name FROM customer",
            f"INSERT OVERWRITE TABLE {table} SELECT 'customer', c_name FROM customer",
            f"INSERT INTO TABLE {table} SELECT 'supplier', s_name FROM supplier",
            f"SELECT * FROM {table}",
        ],
    )


def sql_step_settings(spark, sf_dir):
    """Integer-like text is cast to null instead of an error only under the step's own setting."""
    return _answer(
        spark, sf_dir, ["orders"],
        ["SELECT o_orderkey, CAST(o_orderpriority AS int) AS number FROM orders"],
        {"spark.sql.ansi.enabled": "false"},
    )


def insert_partition_values(spark, sf_dir):
    """Rows and literal values inserted into fixed partitions."""
    table = quoted(f"{new_database(spark)}.names")
    return _answer(
        spark, sf_dir, ["customer"],
        [
            f"CREATE TABLE {table} (foo string, bar int, baz string) USING orc PARTITIONED BY (baz)",
            f"INSERT INTO {table} PARTITION (baz = 'x') SELECT c_name, c_nationkey FROM customer",
            f"INSERT INTO {table} PARTITION (baz = 'y') VALUES ('b', 2)",
            f"SELECT * FROM {table}",
        ],
    )


def view_query(spark, sf_dir):
    """A view over a partitioned table, and a view over that view."""
    df = source(spark, sf_dir, "customer")
    table = describe(df, "customer", ("c_mktsegment",), database=new_database(spark))
    tj.write_table(df, table)
    inner, outer = (quoted(f"{table.database}.{name}") for name in ("builders", "builders_at_home"))
    step = tj.SqlStep(
        "views",
        [
            f"CREATE OR REPLACE VIEW {inner} AS SELECT DISTINCT c_name, c_nationkey "
            f"FROM {quoted(table.full_name)} WHERE c_mktsegment = 'BUILDING'",
            f"CREATE OR REPLACE VIEW {outer} AS SELECT c_name FROM {inner} WHERE c_nationkey < 10",
            f"SELECT * FROM {outer}",
        ],
        sources=[table],
    )
    return step.run(spark, keep_results=True)[-1]


def _units(amount: str, per_one: int) -> str:
    return f"CAST(CAST(floor({amount} * {per_one} + 0.5) AS BIGINT) AS DECIMAL(18, 0))"


_CENTS = _units("o_totalprice", 100)

# Orders are summed per customer before the join: a customer with very many orders is a few rows then.
_JOIN = f"""
    SELECT n_name, CAST(sum(spent) AS DOUBLE) / 100 AS revenue, CAST(sum(n) AS BIGINT) AS n_orders
    FROM (
        SELECT o_custkey, sum({_CENTS}) AS spent, count(*) AS n
        FROM orders GROUP BY o_custkey
    ) o
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name
"""
_SEMI_ANTI = """
    SELECT c_custkey, 'with' AS orders FROM customer
    WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders)
    UNION ALL
    SELECT c_custkey, 'without' AS orders FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders) o WHERE o_custkey = c_custkey)
"""
_AGGREGATE = """
    SELECT l_returnflag, l_linestatus,
           CAST(sum(quantity) AS DOUBLE) / 100 AS sum_qty,
           CAST(sum(price) AS DOUBLE) / 100 AS sum_base_price,
           CAST(sum(disc_price) AS DOUBLE) / 10000 AS sum_disc_price,
           CAST(sum(charge) AS DOUBLE) / 1000000 AS sum_charge,
           CAST(sum(quantity) AS DOUBLE) / 100 / count(*) AS avg_qty,
           CAST(sum(price) AS DOUBLE) / 100 / count(*) AS avg_price,
           count(*) AS n_lines
    FROM (
        SELECT l_returnflag, l_linestatus, {quantity} AS quantity, {price} AS price,
               {disc_price} AS disc_price, {charge} AS charge
        FROM lineitem
    ) l
    GROUP BY l_returnflag, l_linestatus
"""
_ROLLUP = f"""
    SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,
           CAST(sum({_CENTS}) AS DOUBLE) / 100 AS total
    FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
"""
_WINDOW = """
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS INT) AS place FROM (
        SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
        FROM orders
    ) ranked WHERE place <= 3
"""
# Duplicates go before each set operation, so a part sold very often is shuffled as a few rows.
_SETS = """
    SELECT 'union' AS operation, k FROM (
        (SELECT DISTINCT l_partkey AS k FROM lineitem) UNION (SELECT p_partkey FROM part)) u
    UNION ALL
    SELECT 'intersect', k FROM (
        (SELECT DISTINCT l_partkey AS k FROM lineitem) INTERSECT (SELECT p_partkey FROM part)) i
    UNION ALL
    SELECT 'except', k FROM (
        (SELECT p_partkey AS k FROM part) EXCEPT (SELECT DISTINCT l_partkey FROM lineitem)) e
"""
_DATES = """
    SELECT CAST(ts AS DATE) AS day, event_type, upper(substring(event_type, 1, 3)) AS short_type,
           count(*) AS n_events
    FROM events GROUP BY CAST(ts AS DATE), event_type
"""
_STRINGS = """
    SELECT p_partkey, {word} AS first_word, CAST(length(p_name) AS INT) AS n_chars,
           concat(lower(p_brand), '/', trim(p_type)) AS label, substring(p_brand, 7) AS brand_number
    FROM part
"""
_JSON = """
    SELECT event_type, CAST(sum(k) AS DOUBLE) / count(k) AS average_k, max(k) AS largest_k
    FROM (SELECT event_type, CAST({k} AS BIGINT) AS k FROM events) e GROUP BY event_type
"""


def _check(names, spark_sql, duck_sql=None):
    def query(spark, sf_dir):
        return _answer(spark, sf_dir, names, [spark_sql])

    return query, duck_sql or spark_sql


_DAY = _AGGREGATE.format(
    quantity=_units("l_quantity", 100),
    price=_units("l_extendedprice", 100),
    disc_price=_units("l_extendedprice * (1 - l_discount)", 10000),
    charge=_units("l_extendedprice * (1 - l_discount) * (1 + l_tax)", 1000000),
)
QUERIES = {
    "run_sql_steps": (
        run_sql_steps,
        """
        SELECT 'customer' AS kind, c_name AS name FROM customer
        UNION ALL SELECT 'supplier', s_name FROM supplier
        """,
    ),
    "sql_step_settings": (
        sql_step_settings,
        "SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS number FROM orders",
    ),
    "insert_partition_values": (
        insert_partition_values,
        "SELECT c_name AS foo, c_nationkey AS bar, 'x' AS baz FROM customer UNION ALL SELECT 'b', 2, 'y'",
    ),
    "view_query": (
        view_query,
        "SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 10",
    ),
    "sql_join": _check(["orders", "customer", "nation"], _JOIN),
    "sql_semi_anti": _check(["customer", "orders"], _SEMI_ANTI),
    "sql_aggregate": _check(["lineitem"], _DAY.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), _DAY),
    "sql_rollup": _check(["orders"], _ROLLUP),
    "sql_window": _check(["orders"], _WINDOW),
    "sql_set_ops": _check(["lineitem", "part"], _SETS),
    "sql_datetime_string": _check(["events"], _DATES),
    "sql_strings": _check(
        ["part"],
        _STRINGS.format(word="split(p_name, ' ')[0]"),
        _STRINGS.format(word="split_part(p_name, ' ', 1)"),
    ),
    "sql_json": _check(
        ["events"],
        _JSON.format(k="get_json_object(props, '$.k')"),
        _JSON.format(k="json_extract_string(props, '$.k')"),
    ),
}
