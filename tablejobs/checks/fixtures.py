"""Input tables of the check queries, made from the given parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablejobs.descriptor import TableDescriptor
from tablejobs.storage import literal, quoted, shared_folder

_made: dict[tuple, object] = {}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def describe(df: DataFrame, table: str, keys: tuple[str, ...] = (), **more) -> TableDescriptor:
    """A descriptor with the columns of a frame."""
    types = tuple(field.dataType.simpleString() for field in df.schema)
    return TableDescriptor(table, tuple(df.columns), types, keys, **{"storage": "orc", **more})


def new_database(spark: SparkSession) -> str:
    """A database of its own whose tables lie in the shared folder."""
    name = f"checks_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {quoted(name)} LOCATION {literal(shared_folder(spark, 'database'))}")
    return name


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Make a read-only input once per session and data directory."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]
