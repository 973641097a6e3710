"""Copies between tables and files of any storage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tablejobs.descriptor import DEFAULT_DELIMITER, TableDescriptor
from tablejobs.operators.rows import insert_constant
from tablejobs.sinks.tables import write_table
from tablejobs.sinks.text import write_text_table


def copy_to_table(
    df: DataFrame,
    target: TableDescriptor,
    mode: str = "update",
    constants: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Copy rows to a table. Columns the target lacks are left out, ``constants`` are added first."""
    for name, value in (constants or {}).items():
        df = insert_constant(df, name, value)
    kept = [name for name in df.columns if name.lower() in target.schema.names]
    write_table(df.select(*kept), target, mode, options=options)


def copy_to_file(
    df: DataFrame,
    path: str,
    delimiter: str = DEFAULT_DELIMITER,
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
) -> None:
    """Copy rows to delimited text files."""
    write_text_table(df, path, delimiter, mode, options)
