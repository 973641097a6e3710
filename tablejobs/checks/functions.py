"""Check queries of user-written generators and aggregates, and of sketches."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks.fixtures import once, source
from tablejobs.functions.sketches import distinct_error, rank_error
from tablejobs.storage import shared_folder


def apply_generator(spark, sf_dir):
    """The words of a name, with their places: rows made of rows."""

    def words(names: pd.Series) -> pd.DataFrame:
        made = names.str.split(" ").explode().rename("word").to_frame()
        return made.assign(place=made.groupby(level=0).cumcount() + 1).dropna(subset=["word"])

    return tj.apply_generator(source(spark, sf_dir, "part"), words, ["p_name"], "word string, place int", ["p_partkey"])


class Highest:
    """The three highest distinct numbers."""

    def zero(self):
        return []

    def add(self, state, values):
        return self.merge(state, values.dropna().unique().tolist())

    def merge(self, state, other):
        return heapq.nlargest(3, {*state, *other})

    def finish(self, state):
        return ",".join(str(int(value)) for value in state)


def aggregate_with(spark, sf_dir):
    """Three highest order numbers per priority, where one priority holds a third of the rows and more."""
    orders = source(spark, sf_dir, "orders").withColumn(
        "priority", F.expr("CASE WHEN o_orderpriority < '3' THEN NULL ELSE o_orderpriority END")
    )
    return tj.aggregate_with(orders, ["priority"], ["o_custkey"], Highest(), "highest", "string")


def sketches(spark, sf_dir):
    """Sketches per day, stored, merged per flag, and held against the exact results."""
    lines = source(spark, sf_dir, "lineitem")

    def make():
        path = shared_folder(spark, "sketches")
        keys = ["l_returnflag", "l_shipdate"]
        tj.sketch_groups(lines, keys, ["l_orderkey"], ["l_extendedprice", "l_partkey"]).write.parquet(path)
        return path

    stored = spark.read.parquet(once(spark, sf_dir, "sketches", make))
    told = tj.read_sketches(tj.merge_sketches(stored, ["l_returnflag"]), [0.1, 0.5, 0.9])
    # One row a flag: sent to the lines, which would else be dealt out, sorted and counted by flag, one task each.
    both = lines.select("l_returnflag", "l_extendedprice", "l_partkey").join(F.broadcast(told), "l_returnflag")
    off = []
    for name in ("l_extendedprice", "l_partkey"):
        for place, share in enumerate((0.1, 0.5, 0.9)):
            below = F.avg((F.col(name) < F.col(f"quantiles_{name}")[place]).cast("int"))
            upto = F.avg((F.col(name) <= F.col(f"quantiles_{name}")[place]).cast("int"))
            off.append((below <= share + rank_error()) & (upto >= share - rank_error()))
    right = off[0]
    for one in off[1:]:
        right = right & one
    found = both.groupBy("l_returnflag").agg(
        F.max("n_rows").alias("n_rows"), F.max("distinct_l_orderkey").alias("estimate"), right.alias("quantiles_near")
    )
    # On its own, so that a task holds keys only for the orders it has seen.
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"))
    near = F.abs(F.col("estimate") - F.col("n_orders")) <= 4 * distinct_error() * F.col("n_orders")
    found = found.join(F.broadcast(exact), "l_returnflag")
    return found.select("l_returnflag", "n_rows", "n_orders", near.alias("n_orders_near"), "quantiles_near")


QUERIES = {
    "apply_generator": (
        apply_generator,
        """
        SELECT p_partkey, words[place] AS word, CAST(place AS INTEGER) AS place
        FROM (SELECT p_partkey, words, unnest(generate_series(1, len(words))) AS place
              FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part))
        """,
    ),
    "aggregate_with": (
        aggregate_with,
        """
        SELECT priority, string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_custkey DESC) AS highest
        FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY o_custkey DESC) AS place
              FROM (SELECT DISTINCT CASE WHEN o_orderpriority < '3' THEN NULL ELSE o_orderpriority END AS priority,
                                    o_custkey
                    FROM orders))
        WHERE place <= 3 GROUP BY priority
        """,
    ),
    "sketches": (
        sketches,
        """
        SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, true AS n_orders_near,
               true AS quantiles_near
        FROM lineitem GROUP BY l_returnflag
        """,
    ),
}
