"""Matching of field lists to tables by name, without regard to case."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import TableDescriptor
from tablejobs.errors import FieldError, PartitionFilterError


def lower_names(names: Sequence[str]) -> list[str]:
    """Lower-case names; an error if two differ in case only."""
    lower = [name.lower() for name in names]
    repeated = sorted({name for name in lower if lower.count(name) > 1})
    if repeated:
        raise FieldError(f"field names repeat (case is ignored): {repeated}")
    return lower


def column(df: DataFrame, name: str) -> Column:
    """A column by its plain name, whatever characters the name has."""
    return df[f"`{name.replace('`', '``')}`"]


def project_fields(df: DataFrame, fields: Sequence[str] | T.StructType) -> DataFrame:
    """Keep the named fields, in the given order and spelling.

    With a ``StructType`` the types must be those of the table as well.
    """
    names = fields.names if isinstance(fields, T.StructType) else list(fields)
    known = dict(zip(lower_names(df.columns), df.columns))
    unknown = [name for name in lower_names(names) if name not in known]
    if unknown:
        raise FieldError(f"fields not in the table: {unknown}; it has {df.columns}")
    if isinstance(fields, T.StructType):
        for field in fields:
            found = df.schema[known[field.name.lower()]].dataType
            if found != field.dataType:
                raise FieldError(
                    f"field '{field.name}' is {found.simpleString()} in the table, "
                    f"not {field.dataType.simpleString()}"
                )
    return df.select([column(df, known[name.lower()]).alias(name) for name in names])


def partition_filter(df: DataFrame, predicate: str, partition_names: Sequence[str]) -> DataFrame:
    """Keep the partitions a predicate selects. Without partition columns it is ignored."""
    if not partition_names:
        warnings.warn(f"table is not partitioned, filter ignored: {predicate}", stacklevel=2)
        return df
    keys = df.select(list(partition_names)).schema
    try:
        df.sparkSession.createDataFrame([], keys).where(predicate).schema
    except AnalysisException as error:
        raise PartitionFilterError(
            f"a partition filter is a predicate over {list(partition_names)}: {predicate}"
        ) from error
    return df.where(predicate)


def fitted(value: Column, data_type: T.DataType, what: str) -> Column:
    """A value as another type. One that does not fit is an error, whatever the session's cast rules."""
    cast = value.try_cast(data_type)
    message = F.concat(F.lit(f"{what} does not fit {data_type.simpleString()}: "), value.cast("string"))
    wrong = F.raise_error(message).cast(data_type)
    return F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast)


def align_to_table(df: DataFrame, table: TableDescriptor) -> DataFrame:
    """Bring rows into the shape of a table: its columns, its order, its types.

    Data columns the rows lack become null. Partition columns must be there, and no other names may.
    """
    known = dict(zip(lower_names(df.columns), df.columns))
    missing = [name for name in table.partition_names if name not in known]
    if missing:
        raise FieldError(f"partition columns are required, missing: {missing}")
    schema = table.schema
    unknown = [name for name in known if name not in schema.names]
    if unknown:
        raise FieldError(f"fields not in {table.full_name}: {unknown}")
    shaped = []
    for field in schema:
        if field.name not in known:
            value = F.lit(None).cast(field.dataType)
        else:
            value = column(df, known[field.name])
            if df.schema[known[field.name]].dataType != field.dataType:
                value = fitted(value, field.dataType, f"column '{field.name}'")
        shaped.append(value.alias(field.name))
    return df.select(shaped)
