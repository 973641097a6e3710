"""Copies between tables and files, for each storage."""

import pytest
from conftest import rows

import tablejobs as tj
from tablejobs.storage import shared_folder

NAMES, TYPES = ("foo", "bar", "baz"), ("string", "int", "string")
DATA = [("a", 1, "x"), ("b", 2, "y")]


@pytest.fixture(params=["orc", "text", "parquet", "json"])
def tables(request, spark, database):
    part = tj.TableDescriptor("part", NAMES, TYPES, ("baz",), database, storage=request.param)
    plain = tj.TableDescriptor("plain", NAMES[:2], TYPES[:2], (), database, storage=request.param)
    return part, plain


@pytest.fixture
def source(spark):
    return spark.createDataFrame(DATA, "foo string, bar int, baz string")


def lines(spark, path):
    return sorted(row[0] for row in spark.read.text(path).collect())


def test_partitioned_table_to_file(spark, tables, source):
    part, _ = tables
    tj.write_table(source, part)
    path = shared_folder(spark, "file")
    tj.copy_to_file(tj.scan_table(spark, part.full_name), path, "\t")
    assert lines(spark, path) == ["a\t1\tx", "b\t2\ty"]


def test_file_to_partitioned_table(spark, tables, source):
    part, _ = tables
    path = shared_folder(spark, "file")
    tj.write_text_table(source, path, "\t")
    file = tj.TableDescriptor("f", NAMES, TYPES, delimiter="\t")
    tj.copy_to_table(tj.scan_text_table(spark, file, path), part)
    assert rows(spark.sql(f"SHOW PARTITIONS {part.full_name}")) == [("baz=x",), ("baz=y",)]
    assert rows(tj.scan_table(spark, part.full_name)) == DATA


def test_plain_table_to_file_and_back(spark, tables, source):
    _, plain = tables
    path = shared_folder(spark, "file")
    tj.write_table(source.drop("baz"), plain)
    tj.copy_to_file(tj.scan_table(spark, plain.full_name), path, "\t")
    assert lines(spark, path) == ["a\t1", "b\t2"]
    file = tj.TableDescriptor("f", NAMES[:2], TYPES[:2], delimiter="\t")
    tj.copy_to_table(tj.scan_text_table(spark, file, path), plain, "replace")
    assert rows(tj.scan_table(spark, plain.full_name)) == [("a", 1), ("b", 2)]


def test_partitioned_to_plain(spark, tables, source):
    part, plain = tables
    tj.write_table(source, part)
    tj.copy_to_table(tj.scan_table(spark, part.full_name), plain)
    assert rows(tj.scan_table(spark, plain.full_name)) == [("a", 1), ("b", 2)]


def test_plain_to_partitioned(spark, tables, source):
    part, plain = tables
    tj.write_table(source.drop("baz"), plain)
    tj.copy_to_table(tj.scan_table(spark, plain.full_name), part, constants={"baz": "x"})
    assert rows(spark.sql(f"SHOW PARTITIONS {part.full_name}")) == [("baz=x",)]
    assert rows(tj.scan_table(spark, part.full_name)) == [("a", 1, "x"), ("b", 2, "x")]


def test_filter(spark, tables, source):
    part, plain = tables
    tj.write_table(source, part)
    tj.write_table(source.drop("baz"), plain)
    assert rows(tj.scan_table(spark, part.full_name, predicate="baz='y'")) == [("b", 2, "y")]
    with pytest.warns(UserWarning, match="ignored"):
        assert len(rows(tj.scan_table(spark, plain.full_name, predicate="foo='b'"))) == 2


def test_projection(spark, tables, source):
    part, plain = tables
    tj.write_table(source, part)
    tj.write_table(source.drop("baz"), plain)
    assert rows(tj.scan_table(spark, part.full_name, ["bar", "baz"], "baz='y'")) == [(2, "y")]
    assert rows(tj.scan_table(spark, plain.full_name, ["bar"])) == [(1,), (2,)]
