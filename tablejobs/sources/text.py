"""Delimited text tables: one row per line, no header, ``\\N`` for null."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import DEFAULT_DELIMITER, LINE, TableDescriptor, look_up
from tablejobs.errors import TableJobError
from tablejobs.storage import literal, quoted

# Fixed value of the text format.
NULL_TEXT = "\\N"

#: How many fields a line has, and why it is no row of the table; names that no column of a table should have.
WIDTH, REJECTED = "__n_fields", "__rejected"


def _typed(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        raise TableJobError(f"text tables hold scalar columns only, not {data_type.simpleString()}")
    return text.try_cast(data_type)


def _pattern(table: TableDescriptor) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", table.delimiter or DEFAULT_DELIMITER)


def split_lines(
    lines: DataFrame, table: TableDescriptor, typed: bool = True, bad_rows: str = "null", width: bool = False
) -> DataFrame:
    """Turn a frame with a line column (and partition columns) into the table's rows.

    With ``bad_rows="null"`` a line with too few fields gives nulls, one with too many loses those behind, and a field
    that does not fit its type gives null; with ``"error"`` each of these stops the job; ``"skip"`` leaves such lines
    out (``judged_lines`` shows them). With ``typed=False`` the fields stay text. ``width`` adds the number of fields of
    each line (``WIDTH``), which ``check_contract`` reports.
    """
    if bad_rows not in ("null", "error", "skip"):
        raise ValueError(f"bad_rows must be 'null', 'error' or 'skip', not {bad_rows!r}")
    if bad_rows == "skip":
        lines = lines.where(_reason(table).isNull())
    parts = lines.select(F.split(LINE, _pattern(table), -1).alias("__parts"), *table.partition_names)
    fields = []
    for place, field in enumerate(table.data_schema):
        text = F.nullif(F.get("__parts", F.lit(place)), F.lit(NULL_TEXT))
        value = _typed(text, field.dataType) if typed else text
        if bad_rows == "error":
            wanted = len(table.data_schema)
            wrong = F.concat(F.lit(f"a line of {table.full_name} has other than {wanted} fields: "), F.size("__parts"))
            value = F.when(F.size("__parts") != wanted, F.raise_error(wrong).cast(value_type(field, typed))).otherwise(value)
            message = F.lit(f"column '{field.name}' of {table.full_name} holds text that is no {field.dataType.simpleString()}")
            misfit = text.isNotNull() & value.isNull()
            value = F.when(misfit, F.raise_error(message).cast(value_type(field, typed))).otherwise(value)
        fields.append(value.alias(field.name))
    widths = [F.size("__parts").alias(WIDTH)] if width else []
    return parts.select(*fields, *table.partition_names, *widths)


def _reason(table: TableDescriptor) -> Column:
    """Why a line is no row of the table; null if it is one. The first reason counts."""
    parts, width = F.split(LINE, _pattern(table), -1), len(table.data_schema)
    wrong = F.concat(F.size(parts).cast("string"), F.lit(f" fields instead of {width}"))
    reason = F.when(F.size(parts) != width, wrong)
    for place, field in enumerate(table.data_schema):
        text = F.nullif(F.get(parts, F.lit(place)), F.lit(NULL_TEXT))
        if not isinstance(field.dataType, T.StringType):
            misfit = text.isNotNull() & _typed(text, field.dataType).isNull()
            reason = reason.when(misfit, F.lit(f"column '{field.name}' holds text that is no {field.dataType.simpleString()}"))
    return reason


def judged_lines(
    spark: SparkSession, table: TableDescriptor, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """One read of text files that tells rows from rejected lines.

    The columns of the table, then ``REJECTED``: null for a row, else file, reason and line; the columns of a rejected
    line are null but for those of its partition. Lines are rejected for their number of fields and for the first field
    that does not fit its type. ``accepted_rows`` and ``rejected_lines`` take the two parts; write the whole once
    (``materialize``) to use both without a second read.
    """
    reader = spark.read.options(**(options or {})).schema(line_schema(table)).format("text").load(path)
    told = F.struct(F.col("_metadata.file_path").alias("file"), F.col("__reason").alias("reason"), F.col(LINE).alias("line"))
    lines = reader.select(LINE, "_metadata", *table.partition_names, _reason(table).alias("__reason"))
    rejected = F.when(F.col("__reason").isNotNull(), told).alias(REJECTED)
    parts = lines.select(F.split(LINE, _pattern(table), -1).alias("__parts"), rejected, *table.partition_names)
    fields = [
        F.when(F.col(REJECTED).isNull(), _typed(F.nullif(F.get("__parts", F.lit(place)), F.lit(NULL_TEXT)), field.dataType)).alias(field.name)
        for place, field in enumerate(table.data_schema)
    ]
    return parts.select(*fields, *table.partition_names, REJECTED)


def accepted_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_lines(judged: DataFrame) -> DataFrame:
    """file, reason, line."""
    return judged.where(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*")


def value_type(field: T.StructField, typed: bool) -> T.DataType:
    return field.dataType if typed else T.StringType()


def create_text_view(spark: SparkSession, name: str, view: str) -> None:
    """A view through which SQL sees the rows of a delimited text table instead of its lines."""
    table = look_up(spark, name).descriptor
    fields = []
    for place, field in enumerate(table.data_schema):
        text = f"nullif(get(__parts, {place}), {literal(NULL_TEXT)})"
        kind = field.dataType
        _typed(F.lit(None), kind)  # refuses what text cannot hold
        if isinstance(kind, T.BinaryType):
            text = f"try_to_binary({text}, 'base64')"
        elif not isinstance(kind, T.StringType):
            text = f"try_cast({text} AS {kind.simpleString()})"
        fields.append(f"{text} AS {quoted(field.name)}")
    keys = [quoted(key) for key in table.partition_names]
    parts = f"split({quoted(LINE)}, {literal(_pattern(table))}, -1) AS __parts"
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT {', '.join(fields + keys)} "
        f"FROM (SELECT {', '.join([parts, *keys])} FROM {quoted(table.full_name)})"
    )


def line_schema(table: TableDescriptor) -> T.StructType:
    keys = list(table.partition_schema) if table.partitioned else []
    return T.StructType([T.StructField(LINE, T.StringType()), *keys])


def scan_text_table(
    spark: SparkSession,
    table: TableDescriptor,
    path: str,
    typed: bool = True,
    options: Mapping[str, str] | None = None,
    bad_rows: str = "null",
    width: bool = False,
) -> DataFrame:
    """Read the text files under a path as the rows of a table. ``bad_rows``, ``width``: see ``split_lines``."""
    reader = spark.read.options(**(options or {})).schema(line_schema(table))
    return split_lines(reader.format("text").load(path), table, typed, bad_rows, width)
