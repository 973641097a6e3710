"""Distinct counts and quantiles that can be added up: Spark's mergeable sketches, one row per group.

Sketches of partitions are stored once and merged for any coarser grouping, without reading the rows again. With
``precision`` p a distinct count has a relative standard error of about ``1.04 / sqrt(2 ** p)``; the rank of a quantile
from sketches of size k is off by less than ``RANK_ERROR * 200 / k`` of all rows in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.errors import FieldError

PRECISION, SIZE = 14, 400
#: Of sketches of size 200.
RANK_ERROR = 0.0165


def distinct_error(precision: int = PRECISION) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (precision / 2)


def rank_error(size: int = SIZE) -> float:
    """By how much of all rows the rank of a quantile may be off."""
    return RANK_ERROR * 200 / size


def _kind(field: T.StructField) -> str:
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(field.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    raise FieldError(f"quantiles need numbers, not '{field.name}' of type {field.dataType.simpleString()}")


def sketch_groups(
    df: DataFrame,
    keys: Sequence[str],
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    precision: int = PRECISION,
    size: int = SIZE,
) -> DataFrame:
    """Per group: keys, n_rows, and binary columns ``distinct_<column>``, ``quantiles_<kind>_<column>``.

    Sketches are made by the tasks that read the rows and merged in the shuffle, so a hot group costs each task one row.
    Nulls are in no sketch. A group without any value has an empty sketch of distinct values, or a null one of quantiles.
    """
    made = [F.hll_sketch_agg(F.col(f"`{name}`"), F.lit(precision)).alias(f"distinct_{name}") for name in distinct]
    for name in quantiles:
        kind = _kind(df.schema[name])
        value = F.col(f"`{name}`").cast(kind)
        made.append(F.call_function(f"kll_sketch_agg_{kind}", value, F.lit(size)).alias(f"quantiles_{kind}_{name}"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *made)


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, from the columns ``sketch_groups`` names."""
    merged = [F.sum("n_rows").alias("n_rows")]
    for name in sketches.columns:
        if name.startswith("distinct_"):
            merged.append(F.hll_union_agg(f"`{name}`").alias(name))
        elif name.startswith("quantiles_"):
            kind = name.split("_")[1]
            merged.append(F.call_function(f"kll_merge_agg_{kind}", F.col(f"`{name}`")).alias(name))
    return sketches.groupBy(*keys).agg(*merged)


def read_sketches(sketches: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What sketches say: distinct counts (``distinct_<column>``) and, as an array, the quantiles of ``shares``
    (``quantiles_<column>``); other columns stay as they are."""

    def told(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name.startswith("distinct_"):
            return F.hll_sketch_estimate(column).alias(name)
        if name.startswith("quantiles_"):
            _, kind, own = name.split("_", 2)
            found = F.call_function(f"kll_sketch_get_quantile_{kind}", column, F.array(*map(F.lit, shares)))
            return found.alias(f"quantiles_{own}")
        return column

    return sketches.select(*map(told, sketches.columns))
