"""User-written generators and aggregates, and sketches."""

import pandas as pd
import pytest
from conftest import SMALL, rows

import tablejobs as tj
from tablejobs.checks import functions
from tablejobs.checks.fixtures import source
from tablejobs.errors import FieldError
from tablejobs.functions import aggregates
from tablejobs.storage import session_setting


def total():
    """An aggregate of a class of its own, which travels to the workers by value."""

    class Total:
        """Sum and number of values; says how many states it merged."""

        def zero(self):
            return (0, 0)

        def add(self, state, values):
            return (state[0] + int(values.sum()), state[1] + len(values))

        def merge(self, state, other):
            return (state[0] + other[0], state[1] + other[1])

        def finish(self, state):
            return {"total": state[0], "n": state[1]}

    return Total()


def test_rows_made_of_rows(spark):
    df = spark.createDataFrame([("a b", 1), ("", 2), (None, 3), ("c", 4)], "text string, n int")

    def words(text: pd.Series) -> pd.DataFrame:
        made = text.dropna().str.split().explode().dropna()
        return made.rename("word").to_frame()

    assert rows(tj.apply_generator(df, words, ["text"], "word string")) == [("a b", 1, "a"), ("a b", 1, "b"), ("c", 4, "c")]
    assert rows(tj.apply_generator(df, words, ["text"], "word string", ["n"])) == [(1, "a"), (1, "b"), (4, "c")]
    assert rows(tj.apply_generator(df.limit(0), words, ["text"], "word string")) == []
    with pytest.raises(FieldError, match="already"):
        tj.apply_generator(df, words, ["text"], "n string")
    with pytest.raises(FieldError, match="no such"):
        tj.apply_generator(df, words, ["other"], "word string")


@pytest.mark.parametrize("held", [20_000, 1])
def test_states_are_merged(spark, monkeypatch, held):
    monkeypatch.setattr(aggregates, "HELD_STATES", held)
    df = spark.range(3000).repartition(12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN double('NaN') ELSE double(id % 7) END AS k", "id % 2 AS j", "id"
    )
    found = tj.aggregate_with(df, ["k", "j"], ["id"], total(), "out", "struct<total: bigint, n: bigint>")
    expected = df.groupBy("k", "j").agg({"id": "sum", "*": "count"})
    got = sorted((repr(r.k), r.j, r.out.total, r.out.n) for r in found.collect())
    assert got == sorted((repr(r.k), r.j, r["sum(id)"], r["count(1)"]) for r in expected.collect())
    whole = tj.aggregate_with(df, [], ["id"], total(), "out", "struct<total: bigint, n: bigint>").collect()
    assert [tuple(r.out) for r in whole] == [(2999 * 1500, 3000)]
    assert tj.aggregate_with(df.limit(0), ["k"], ["id"], total(), "out", "struct<total: bigint, n: bigint>").count() == 0


def test_a_hot_group_reaches_the_shuffle_as_states(spark):
    """A million rows of one key: no more rows than tasks are shuffled."""
    df = spark.range(0, 1_000_000, 1, 6).selectExpr("'x' AS k", "id")
    found = tj.aggregate_with(df, ["k"], ["id"], total(), "out", "struct<total: bigint, n: bigint>")
    text = found._jdf.queryExecution().executedPlan().toString()
    below = text[text.rindex("Exchange"):]
    assert "MapInArrow" in below and text.count("Exchange hashpartitioning") == 2
    assert [tuple(r.out) for r in found.collect()] == [(999_999 * 500_000, 1_000_000)]


def test_sketches_of_parts_are_those_of_the_whole(spark):
    lines = source(spark, SMALL, "lineitem")
    parts = tj.sketch_groups(lines, ["l_returnflag", "l_linestatus"], ["l_partkey"], ["l_quantity"])
    merged = tj.read_sketches(tj.merge_sketches(parts), [0.5]).first()
    whole = tj.read_sketches(tj.sketch_groups(lines, [], ["l_partkey"], ["l_quantity"]), [0.5]).first()
    assert merged.n_rows == whole.n_rows == lines.count()
    assert merged.distinct_l_partkey == whole.distinct_l_partkey
    assert abs(merged.quantiles_l_quantity[0] - whole.quantiles_l_quantity[0]) <= 2
    with pytest.raises(FieldError, match="numbers"):
        tj.sketch_groups(lines, [], [], ["l_returnflag"])


def test_checks_hold_on_other_data(spark):
    assert all(r.n_orders_near and r.quantiles_near for r in functions.sketches(spark, SMALL).collect())


def test_lines_are_not_dealt_out_by_flag(spark):
    """Distinct orders are counted in tasks by flag and order, whatever Spark guesses about the size of the sketches."""
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = functions.sketches(spark, SMALL)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
        dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(l_returnflag" in line]
        assert any("l_orderkey" in line.split("ENSURE")[0] for line in dealt)
        assert all(row.n_orders_near and row.quantiles_near for row in found.collect())
