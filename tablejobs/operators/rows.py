"""Row operators used between a scan and a sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_columns(df: DataFrame, names: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    """The named columns only, each put through a column function."""
    return df.select([change(F.col(name)).alias(name) for name in names])


def insert_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def filter_rows(df: DataFrame, name: str, value) -> DataFrame:
    return df.where(F.col(name) == F.lit(value))


def group_count(df: DataFrame, names: Sequence[str], alias: str = "count") -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names).distinct()


def order_rows(df: DataFrame, by: Sequence[str | Column], ties: Sequence[str | Column] = ()) -> DataFrame:
    """Sort the whole frame. Rows that agree on ``by`` are ordered by ``ties``.

    Spark sorts by ranges of the sort key, so one hot value of ``by`` would be one task. A hash of the
    row, put last, lets the ranges cut through such a value.
    """
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return df.orderBy(*by, *ties, *([F.xxhash64(*hashed)] if hashed else []))


def limit_rows(df: DataFrame, n: int, by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows of an order. Name a key in ``by`` so that the result is fixed."""
    return df.orderBy(*by).limit(n)
