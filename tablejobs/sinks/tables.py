"""Making, writing and dropping catalog tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import (
    COLUMNS_PROPERTY,
    DELIMITER_PROPERTY,
    LINE,
    TableDescriptor,
    look_up,
)
from tablejobs.errors import TableHasDataError, TableJobError, TransactionalTableError
from tablejobs.operators.contract import validate_table
from tablejobs.operators.fields import align_to_table, column
from tablejobs.sinks.text import join_fields
from tablejobs.storage import literal, materialize, qualified_path, quoted, session_setting

# Formats that only a Hive catalog can keep tables in.
HIVE_STORAGE = ("textfile", "sequencefile", "avro")

MODES = ("keep", "update", "replace", "replace_partitions")


def forbid_transactional(spark: SparkSession, table: TableDescriptor) -> None:
    """The catalog's word counts if the table exists, else the descriptor's."""
    if spark.catalog.tableExists(table.full_name):
        table = look_up(spark, table.full_name).descriptor
    if table.transactional:
        raise TransactionalTableError(f"writing to a transactional table is refused: {table.full_name}")


def _create_statement(spark: SparkSession, table: TableDescriptor) -> str:
    table.schema  # a type Spark does not know ends here
    keys = [f"{quoted(n)} {table.type_text(n)}" for n in table.partition_names]
    data = [f"{quoted(n)} {table.type_text(n)}" for n in table.data_names]
    hive = table.storage in HIVE_STORAGE
    if hive and spark.conf.get("spark.sql.catalogImplementation") != "hive":
        raise TableJobError(f"{table.storage} tables need a session with a Hive catalog")
    properties = {}
    if table.storage == "text":
        declared = [[n, table.type_text(n)] for n in table.data_names]
        properties = {COLUMNS_PROPERTY: json.dumps(declared), DELIMITER_PROPERTY: table.delimiter}
        data = [f"{quoted(LINE)} string"]
    parts = [f"CREATE TABLE IF NOT EXISTS {quoted(table.full_name)}"]
    if hive:
        parts.append(f"({', '.join(data)})")
        if keys:
            parts.append(f"PARTITIONED BY ({', '.join(keys)})")
        if table.storage != "avro":
            parts.append(f"ROW FORMAT DELIMITED FIELDS TERMINATED BY {literal(table.delimiter)}")
        parts.append(f"STORED AS {table.storage.upper()}")
    else:
        parts.append(f"({', '.join(data + keys)}) USING {table.storage}")
        if keys:
            parts.append(f"PARTITIONED BY ({', '.join(map(quoted, table.partition_names))})")
    if table.location is not None:
        parts.append(f"LOCATION {literal(table.location)}")
    if properties:
        pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({pairs})")
    return " ".join(parts)


def create_table(spark: SparkSession, table: TableDescriptor, strict: bool = False) -> None:
    """Make the table, and its database, unless they exist. ``strict`` checks an existing table."""
    if spark.catalog.tableExists(table.full_name):
        if strict:
            validate_table(spark, table)
        return
    forbid_transactional(spark, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(table.database)}")
    spark.sql(_create_statement(spark, table))


def drop_table(spark: SparkSession, table: TableDescriptor) -> None:
    """Drop the table. Spark removes the files of a managed table and keeps those of an external one."""
    forbid_transactional(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table.full_name)}")


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together to limit the number of files, without hot tasks.

    Adaptive execution cuts a large partition into pieces and joins small ones. With adaptive execution
    off a plain shuffle would put a hot partition in one task, so rows are then left where they are.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    return df.hint("rebalance", *keys) if keys and adaptive else df


def no_empty_keys(df: DataFrame, table: TableDescriptor) -> DataFrame:
    """Refuse empty partition values: Spark stores them as null, which would change the row."""
    for name in table.partition_names:
        if isinstance(df.schema[name].dataType, T.StringType):
            message = F.lit(f"partition column '{name}' holds an empty string")
            value = column(df, name)
            df = df.withColumn(
                name, F.when(value == "", F.raise_error(message).cast("string")).otherwise(value)
            )
    return df


def _holds_rows(spark: SparkSession, table: TableDescriptor) -> bool:
    return not spark.table(quoted(table.full_name)).isEmpty()


def write_table(
    df: DataFrame,
    table: TableDescriptor,
    mode: str = "keep",
    strict: bool = False,
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write rows into a table, making database and table first if they are missing.

    Rows are brought into the shape of the table as it is in the catalog.

    ``keep`` refuses a table that holds rows, ``update`` adds rows, ``replace`` leaves only the new rows
    (and the new shape, if the descriptor differs), ``replace_partitions`` swaps the partitions that
    the new rows touch. Rows that replace a table are written to the shared folder first, so a value that
    does not fit leaves the old table as it is, and rows may come from the table itself. ``watch`` may attach counters
    to the rows as they go to the files.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = df.sparkSession
    forbid_transactional(spark, table)
    if strict and spark.catalog.tableExists(table.full_name):
        validate_table(spark, table)
    if mode == "replace" and spark.catalog.tableExists(table.full_name):
        # Rows are computed and checked first, in the shared folder: an error must come before the old table goes.
        df = _staged(df, table)
        found = look_up(spark, table.full_name).descriptor
        if not _same_shape(spark, found, table):
            drop_table(spark, table)
    create_table(spark, table)
    if mode == "keep" and _holds_rows(spark, table):
        raise TableHasDataError(f"{table.full_name} already holds rows")
    # An existing table has the last word on columns, their order and their storage.
    table = look_up(spark, table.full_name).descriptor
    rows = _shaped(df, table, rebalance)
    _insert(watch(rows) if watch else rows, table, mode, options)


def _staged(df: DataFrame, table: TableDescriptor) -> DataFrame:
    """The rows in the shape of the table, written once to the shared folder with every check of their values."""
    rows = no_empty_keys(align_to_table(df, table), table)
    if table.storage == "text":
        join_fields(rows, table.delimiter, table.partition_names).write.format("noop").mode("overwrite").save()
    return materialize(rows, "replace")


def _shaped(df: DataFrame, table: TableDescriptor, rebalance: bool) -> DataFrame:
    """Rows as the files of a table take them."""
    rows = no_empty_keys(align_to_table(df, table), table)
    if table.storage == "text":
        rows = join_fields(rows, table.delimiter, table.partition_names)
    return rebalanced(rows, table.partition_names) if rebalance else rows


def _same_shape(spark: SparkSession, found: TableDescriptor, table: TableDescriptor) -> bool:
    def place(descriptor):
        return qualified_path(spark, descriptor.location)

    shapes = [(t.schema, t.partition_names, t.storage, t.delimiter) for t in (found, table)]
    return shapes[0] == shapes[1] and (table.location is None or place(found) == place(table))


def _insert(rows: DataFrame, table: TableDescriptor, mode: str, options) -> None:
    spark = rows.sparkSession
    overwrite = mode in ("replace", "replace_partitions")
    scope = "dynamic" if mode == "replace_partitions" else "static"
    # Inserting into a table takes these settings from the session, not from the writer.
    with (
        session_setting(spark, "spark.sql.sources.partitionOverwriteMode", scope),
        session_setting(spark, "hive.exec.dynamic.partition.mode", "nonstrict"),
    ):
        rows.write.options(**(options or {})).insertInto(quoted(table.full_name), overwrite=overwrite)


def write_partitioned(
    df: DataFrame,
    table: TableDescriptor,
    mode: str = "update",
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write each row to the partition its partition columns name."""
    if not table.partitioned:
        raise TableJobError(f"{table.full_name} is not partitioned")
    write_table(df, table, mode, rebalance=rebalance, options=options)


def insert_into(df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> None:
    """Add rows to a table of the catalog, whatever it holds already."""
    write_table(df, look_up(df.sparkSession, name).descriptor, "update", options=options)


def write_files(
    df: DataFrame,
    table: TableDescriptor,
    path: str,
    mode: str = "errorifexists",
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write rows in the shape of a table below a path, without touching the catalog."""
    rows = _shaped(df, table, rebalance)
    writer = rows.write.options(**(options or {})).mode(mode).format(table.storage)
    writer.partitionBy(*table.partition_names).save(path)


def _partition_clause(values: Mapping[str, object]) -> str:
    pairs = []
    for key, value in values.items():
        shown = "null" if value is None else literal(str(value))
        pairs.append(f"{quoted(key)} = {shown}")
    return f"PARTITION ({', '.join(pairs)})"


def register_partitions(
    spark: SparkSession, table: TableDescriptor, partitions: Sequence[Mapping[str, object]] | None = None
) -> None:
    """Tell the catalog about partition directories: the given ones, or all it does not know yet.

    A known partition is left alone, a table without partitions is ignored, a missing table is made.
    """
    if not table.partitioned:
        return
    create_table(spark, table)
    name = quoted(table.full_name)
    if partitions is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    elif partitions:
        clauses = " ".join(map(_partition_clause, partitions))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {clauses}")


def remove_partitions(
    spark: SparkSession, name: str, partitions: Sequence[Mapping[str, object]]
) -> None:
    """Drop partitions; those that are not there are ignored."""
    forbid_transactional(spark, look_up(spark, name).descriptor)
    if partitions:
        clauses = ", ".join(map(_partition_clause, partitions))
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {clauses}")


def truncate_table(spark: SparkSession, name: str) -> None:
    forbid_transactional(spark, look_up(spark, name).descriptor)
    spark.sql(f"TRUNCATE TABLE {quoted(name)}")
