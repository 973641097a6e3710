import pytest
from conftest import rows
from pyspark.sql import types as T

import tablejobs as tj
from tablejobs.errors import FieldError, PartitionFilterError

TABLE = tj.TableDescriptor("t", ("foo", "bar", "baz"), ("string", "int", "string"), ("baz",))


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "foo string, bar int, baz string")


def test_projection_keeps_order_and_spelling(frame):
    got = tj.project_fields(frame, ["BAZ", "foo"])
    assert got.columns == ["BAZ", "foo"]
    assert rows(got) == [("x", "a"), ("y", "b")]


@pytest.mark.parametrize("fields", [["foo", "FOO"], ["foo", "nothing"]])
def test_projection_refuses_repeated_and_unknown_names(frame, fields):
    with pytest.raises(FieldError):
        tj.project_fields(frame, fields)


def test_projection_checks_types_if_given(frame):
    assert rows(tj.project_fields(frame, T.StructType([T.StructField("Bar", T.IntegerType())]))) == [(1,), (2,)]
    with pytest.raises(FieldError):
        tj.project_fields(frame, T.StructType([T.StructField("bar", T.StringType())]))


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert rows(tj.project_fields(df, ["A.B"])) == [(1,)]


def test_partition_filter(frame):
    assert rows(tj.partition_filter(frame, "baz = 'y'", ["baz"])) == [("b", 2, "y")]
    assert rows(tj.partition_filter(frame, "baz='x' OR baz='y'", ["baz"])) == rows(frame)


@pytest.mark.parametrize("predicate", ["foo = 'b'", "bar > 1 AND baz = 'y'", "baz", "nothing = 1"])
def test_partition_filter_takes_partition_columns_only(frame, predicate):
    with pytest.raises(PartitionFilterError):
        tj.partition_filter(frame, predicate, ["baz"])


def test_partition_filter_is_ignored_without_partitions(frame):
    with pytest.warns(UserWarning, match="ignored"):
        assert rows(tj.partition_filter(frame, "foo = 'b'", [])) == rows(frame)


def test_alignment_matches_names_and_fills_nulls(spark):
    df = spark.createDataFrame([("x", "first")], "BAZ string, Foo string")
    got = tj.align_to_table(df, TABLE)
    assert got.columns == ["foo", "bar", "baz"]
    assert got.schema["bar"].dataType == T.IntegerType()
    assert rows(got) == [("first", None, "x")]


def test_alignment_converts_types(spark):
    df = spark.createDataFrame([("7", "x")], "bar string, baz string")
    assert rows(tj.align_to_table(df, TABLE)) == [(None, 7, "x")]


@pytest.mark.parametrize(
    "columns", ["foo string, bar int", "foo string, baz string, more int", "foo string, FOO string, baz string"]
)
def test_alignment_refuses(spark, columns):
    with pytest.raises(FieldError):
        tj.align_to_table(spark.createDataFrame([], columns), TABLE)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_alignment_never_loses_a_value(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("seven", "x")], "bar string, baz string")
        with pytest.raises(Exception, match="does not fit int"):
            tj.align_to_table(df, TABLE).collect()
        big = spark.createDataFrame([(2**40, "x")], "bar bigint, baz string")
        with pytest.raises(Exception, match="does not fit int"):
            tj.align_to_table(big, TABLE).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
