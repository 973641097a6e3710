"""Does a table, and does its data, fit the descriptor?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import TableDescriptor, look_up
from tablejobs.errors import FieldError, TableMismatchError
from tablejobs.operators.fields import column, lower_names
from tablejobs.sources.text import WIDTH
from tablejobs.storage import qualified_path


def differences(spark: SparkSession, table: TableDescriptor) -> list[str]:
    """Everything in which the catalog table differs from the descriptor: a line for each."""
    from tablejobs.sources.tables import expected_location

    catalog = look_up(spark, table.full_name)
    found = catalog.descriptor

    def columns(descriptor: TableDescriptor, names: list[str]) -> list[str]:
        return [f"{name} {descriptor.declared_types[name].simpleString()}" for name in names]

    facts = {
        "data columns": (columns(table, table.data_names), columns(found, found.data_names)),
        "partition columns": (columns(table, table.partition_names), columns(found, found.partition_names)),
        "kind": ("MANAGED" if table.location is None else "EXTERNAL", catalog.kind),
        "path": (expected_location(spark, table), qualified_path(spark, found.location)),
        "transactional": (table.transactional, found.transactional),
    }
    return [f"{what}: expected {want!r}, found {got!r}" for what, (want, got) in facts.items() if want != got]


def validate_table(spark: SparkSession, table: TableDescriptor) -> None:
    """Raise, with all differences, unless the catalog table agrees with the descriptor."""
    if report := differences(spark, table):
        raise TableMismatchError(f"{table.full_name}: " + "; ".join(report))


def _fits(value, field: T.StructField):
    if isinstance(field.dataType, T.BinaryType):
        return F.try_to_binary(value, F.lit("base64"))
    return value.try_cast(field.dataType)


def check_contract(df: DataFrame, table: TableDescriptor) -> DataFrame:
    """Count, per column and in one pass, the values that break the descriptor.

    ``bad_values`` are values that cannot become the declared type. ``null_keys`` are nulls in
    partition columns. The rows are usually text fields (``scan_text_table(..., typed=False)``). If they come with the
    width of their lines (``width=True``), a last line of the report, ``(line)``, counts those with too few or too many
    fields.
    """
    known = dict(zip(lower_names(df.columns), df.columns))
    missing = [name for name in table.schema.names if name not in known]
    if missing:
        raise FieldError(f"columns of {table.full_name} missing from the rows: {missing}")
    counts, lines = [], []
    for place, field in enumerate(table.schema):
        value = column(df, known[field.name])
        if df.schema[known[field.name]].dataType == field.dataType:
            bad = F.lit(0).cast("bigint")
        else:
            bad = F.count_if(value.isNotNull() & _fits(value, field).isNull())
        is_key = field.name in table.partition_names
        nulls = F.count_if(value.isNull()) if is_key else F.lit(0).cast("bigint")
        counts += [bad.alias(f"bad_{place}"), nulls.alias(f"null_{place}")]
        lines.append(
            F.struct(
                F.lit(place).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(table.type_text(field.name)).alias("declared_type"),
                F.col(f"bad_{place}").alias("bad_values"),
                F.col(f"null_{place}").alias("null_keys"),
            )
        )
    if WIDTH in df.columns:
        wanted = len(table.data_names)
        counts.append(F.count_if(F.col(WIDTH) != wanted).alias("bad_width"))
        lines.append(
            F.struct(
                F.lit(len(table.schema)).alias("position"),
                F.lit("(line)").alias("column_name"),
                F.lit(f"{wanted} fields").alias("declared_type"),
                F.col("bad_width").alias("bad_values"),
                F.lit(0).cast("bigint").alias("null_keys"),
            )
        )
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    return totals.select(F.inline(F.array(*lines)))
