"""Joins by time against plain loops, on skewed, repeated and missing values, and the plans they get."""

import importlib
import random
import time

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.checks import CHECKS
from tablejobs.errors import FieldError


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def last_before(left, right, tolerance=None):
    out = []
    for key, time, name in left:
        fitting = [(t, v) for k, t, v in right if key is not None and k == key and None not in (time, t) and t <= time]
        found = max(fitting, key=lambda f: (f[0], f[1] is not None, f[1] or ""), default=(None, None))
        if tolerance is not None and found[0] is not None and time - found[0] > tolerance:
            found = (None, None)
        out.append((key, time, name, *found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, hot_rows, tolerance", [(0, None, None), (1, 20, None), (2, 7, 30), (3, 1, None), (4, 40, 0)])
def test_asof_join_against_a_loop(spark, seed, hot_rows, tolerance):
    chance = random.Random(seed)
    keys = [1] * 8 + [2, 3, 4, 5, None]
    times = [50] * 10 + [*range(0, 120, 7), None]
    left = [(chance.choice(keys), chance.choice(times), f"l{i % 90}") for i in range(400)]
    right = [(chance.choice(keys), chance.choice(times), chance.choice(["a", "b", "c", None])) for _ in range(150)]
    a = spark.createDataFrame(left, "k int, at long, name string")
    b = spark.createDataFrame(right, "k int, t long, v string")
    found = tj.asof_join(a, b, ["k"], "at", "t", tolerance, hot_rows)
    assert found.columns == ["k", "at", "name", "t", "v"]
    assert rows(found) == last_before(left, right, tolerance)


def test_asof_join_with_nothing_on_a_side(spark):
    a = spark.createDataFrame([(1, 5)], "k int, at int")
    none = spark.createDataFrame([], "k int, t int, v string")
    assert rows(tj.asof_join(a, none, ["k"], "at", "t")) == [(1, 5, None, None)]
    assert rows(tj.asof_join(none, a, ["k"], "t", "at")) == []
    for fields in ({"on": []}, {"on": ["x"]}, {"left_time": "x"}):
        with pytest.raises(FieldError):
            tj.asof_join(a, none, **{"on": ["k"], "left_time": "at", "right_time": "t", **fields})
    with pytest.raises(FieldError, match="both sides"):
        tj.asof_join(a, a, ["k"], "at", "at")
    with pytest.raises(FieldError, match="whole number"):
        tj.asof_join(a.selectExpr("k", "at * 1.5D AS at"), none.selectExpr("k", "t * 1.5D AS t"), ["k"], "at", "t")


def test_a_hot_key_is_cut_into_ranges(spark):
    """No task of the last window holds more than a few times the wanted rows, whatever the key holds."""
    a = spark.range(6000).selectExpr("if(id % 3 = 0, 0, id) AS k", "if(id % 2 = 0, 77, id) AS at", "id AS name")
    b = spark.range(300).selectExpr("id % 2 AS k", "id * 20 AS t", "id AS v")
    found = tj.asof_join(a, b, ["k"], "at", "t", hot_rows=200)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in text and "Cartesian" not in text and "NestedLoop" not in plan(found)
    expected = last_before([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()])
    assert rows(found) == expected


def test_hot_keys_are_cut_by_their_own_rows(spark):
    """Ranges hold about as many rows as wanted, whatever other keys hold, and finding them is no search of all cuts."""
    a = spark.range(300_000).selectExpr(
        "if(id % 2 = 0, 0, 1 + id % 1500) AS k", "if(id % 30 = 0, 777, id * 7919 % 1000003) AS at", "id AS name"
    )
    b = spark.range(3000).selectExpr("if(id % 2 = 0, 0, id % 1500) AS k", "id * 331 AS t", "id AS v")
    sums = ("count(*)", "count(v)", "sum(v * (name % 1009))", "sum(t)")
    expected = tj.asof_join(a, b, ["k"], "at", "t").selectExpr(*sums).first()
    began = time.time()
    found = tj.asof_join(a, b, ["k"], "at", "t", hot_rows=20)
    assert found.selectExpr(*sums).first() == expected
    assert time.time() - began < 60  # several minutes with each row held against 7,500 cuts
    joins = importlib.import_module("tablejobs.operators.joins")
    rows = a.selectExpr("k", "at AS __time", "struct(name) AS __left", "CAST(null AS struct<v: bigint>) AS __last")
    counts = rows.groupBy("k").agg(F.count("*").alias("__n"))
    cuts = {row.k: row.n for row in joins._cuts(rows, ["k"], counts, 20).groupBy("k").agg(F.max("__until").alias("n")).collect()}
    assert 6000 < cuts.pop(0) < 9500 and len(cuts) > 500 and all(n <= 25 for n in cuts.values())
    once = joins._cuts(rows, ["k"], counts, 20).orderBy("k", "__time").collect()
    again = joins._cuts(rows.repartition(7), ["k"], counts, 20).orderBy("k", "__time").collect()
    assert once == again and any(row.k == 0 and row["__time"] == 777 and row["__until"] - row["__before"] > 100 for row in once)


def overlapping(left, right):
    def full(row):
        return None not in row[:3] and row[1] <= row[2]

    pairs = [(*l, *r[1:]) for l in left for r in right if full(l) and full(r) and l[0] == r[0] and l[1] <= r[2] and r[1] <= l[2]]
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_interval_join_against_a_loop(spark, seed):
    chance = random.Random(seed)

    def ranges(count):
        made = []
        for i in range(count):
            begin = chance.choice([None, chance.randint(-400, 400), chance.randint(-5, 5)])
            length = chance.choice([0, 0, 1, 3, 20, 300, 2000, -1])
            made.append((chance.choice([1, 1, 1, 2, None]), begin, None if begin is None else begin + length, i % 40))
        return made

    left, right = ranges(120), ranges(90)
    a = spark.createDataFrame(left, "k int, a long, b long, l int")
    b = spark.createDataFrame(right, "k int, c long, d long, r int")
    found = tj.interval_join(a, b, ("a", "b"), ("c", "d"), ["k"])
    assert found.columns == ["k", "a", "b", "l", "c", "d", "r"]
    assert rows(found) == overlapping(left, right)
    without = tj.interval_join(a, b.withColumnRenamed("k", "j"), ("a", "b"), ("c", "d"))
    one = lambda data: [(0, *row[1:3], row) for row in data]
    expected = sorted(((*l[3], r[3][0], *r[3][1:]) for l in one(left) for r in one(right) if overlapping([l], [r])), key=repr)
    assert rows(without) == expected


def test_extreme_ranges_and_types(spark):
    far = 2**62
    a = spark.createDataFrame([(-far, far, 1), (5, 5, 2), (far, far, 3)], "a long, b long, l int")
    b = spark.createDataFrame([(0, 0, 1), (far, far, 2), (-far, -far + 1, 3)], "c long, d long, r int")
    found = tj.interval_join(a, b, ("a", "b"), ("c", "d")).select("l", "r")
    assert rows(found) == [(1, 1), (1, 2), (1, 3), (3, 2)]
    days = spark.sql("SELECT DATE'2024-01-01' AS a, DATE'2024-02-01' AS b")
    other = spark.sql("SELECT DATE'2024-02-01' AS c, DATE'2024-02-03' AS d")
    assert tj.interval_join(days, other, ("a", "b"), ("c", "d")).count() == 1
    with pytest.raises(FieldError, match="differ"):
        tj.interval_join(days, b, ("a", "b"), ("c", "d"))
    assert rows(tj.interval_join(a, b.limit(0), ("a", "b"), ("c", "d"))) == []


def test_long_ranges_are_copied_twice_at_most(spark):
    a = spark.range(50).selectExpr("id AS a", "id + 1000000 AS b", "id AS l")
    b = spark.range(50).selectExpr("id * 7 AS c", "id * 7 AS d", "id AS r")
    found = tj.interval_join(a, b, ("a", "b"), ("c", "d"))
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert rows(found.select("l", "r")) == sorted(((i, j) for i in range(50) for j in range(50) if i <= 7 * j), key=repr)


@pytest.mark.parametrize("name", ["asof_join", "asof_join_hot_key", "interval_join", "interval_join_mixed_lengths"])
def test_checks_need_no_nested_loop(spark, name):
    text = plan(CHECKS[name][0](spark, SMALL))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
