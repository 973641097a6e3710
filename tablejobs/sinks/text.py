"""Writing delimited text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import DEFAULT_DELIMITER, LINE
from tablejobs.errors import TableJobError
from tablejobs.operators.fields import column
from tablejobs.sources.text import NULL_TEXT


# What numbers, dates, flags and base64 text can be made of.
_VALUE_CHARACTERS = re.compile(r"[\w+./:= -]")


def _splits(text: Column, delimiter: str) -> Column:
    """Would a reader see the delimiter before the end of this text?"""
    if len(delimiter) == 1:
        return text.contains(delimiter)
    return F.instr(F.concat(text, F.lit(delimiter)), delimiter) != F.length(text) + 1


def _field_text(df: DataFrame, field: T.StructField, delimiter: str, line_end: str | None) -> Column:
    value = column(df, field.name)
    if isinstance(field.dataType, T.BinaryType):
        text = F.base64(value)
        unsafe = text.contains("\n")
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise TableJobError(f"text tables hold scalar columns only: {field.name}")
    elif isinstance(field.dataType, T.StringType):
        breaks = [line_end] if line_end else ["\n", "\r"]
        unsafe = reduce(Column.__or__, [value.contains(end) for end in breaks], value == NULL_TEXT)
        text = value
    else:
        text, unsafe = value.cast("string"), F.lit(False)
        if line_end and _VALUE_CHARACTERS.search(line_end):
            unsafe = text.contains(line_end)
        elif not _VALUE_CHARACTERS.search(delimiter):
            return text
    message = f"column '{field.name}' holds the delimiter, a line break or the null mark"
    refused = F.raise_error(F.lit(message)).cast("string")
    return F.when(unsafe | _splits(text, delimiter), refused).otherwise(text)


def join_fields(
    df: DataFrame,
    delimiter: str = DEFAULT_DELIMITER,
    partition_names: Sequence[str] = (),
    line_end: str | None = None,
) -> DataFrame:
    """One line per row, partition columns kept beside it. ``line_end`` is the separator of lines, if it is not a break.

    A value that would not read back the same stops the job with an error.
    """
    if delimiter in NULL_TEXT or "\n" in delimiter or "\r" in delimiter:
        raise TableJobError(f"text fields cannot be divided by {delimiter!r}")
    fields = [
        F.coalesce(_field_text(df, field, delimiter, line_end), F.lit(NULL_TEXT))
        for field in df.schema
        if field.name not in partition_names
    ]
    return df.select(F.concat_ws(delimiter, *fields).alias(LINE), *partition_names)


def write_text_table(
    df: DataFrame,
    path: str,
    delimiter: str = DEFAULT_DELIMITER,
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write rows as delimited text without a header, columns in frame order."""
    ends = [value for key, value in (options or {}).items() if key.lower() == "linesep"]
    join_fields(df, delimiter, line_end=ends[0] if ends else None).write.options(**(options or {})).mode(mode).text(path)
