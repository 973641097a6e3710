"""Reading tables: by catalog name, or at the place their files lie."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablejobs.descriptor import TableDescriptor, look_up
from tablejobs.errors import TableJobError, TransactionalTableError
from tablejobs.operators.fields import partition_filter, project_fields
from tablejobs.sources.text import scan_text_table, split_lines
from tablejobs.storage import qualified_path, quoted

Fields = Sequence[str] | T.StructType


def _narrow(df, table: TableDescriptor, fields: Fields | None, predicate: str | None) -> DataFrame:
    if predicate is not None:
        df = partition_filter(df, predicate, table.partition_names)
    return df if fields is None else project_fields(df, fields)


def scan_table(
    spark: SparkSession,
    name: str,
    fields: Fields | None = None,
    predicate: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a catalog table: chosen fields of the partitions a predicate selects."""
    found = look_up(spark, name)
    table = found.descriptor
    if table.transactional:
        raise TransactionalTableError(f"{name} is transactional, read it with snapshot_read")
    df = spark.read.options(**(options or {})).table(quoted(table.full_name))
    if found.delimited:
        df = split_lines(df, table)
    return _narrow(df, table, fields, predicate)


def scan_partitioned(
    spark: SparkSession,
    table: TableDescriptor,
    path: str,
    fields: Fields | None = None,
    predicate: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read ``key=value`` directories. Partition columns come last and have their declared types."""
    if table.storage == "text":
        df = scan_text_table(spark, table, path, options=options)
    elif table.storage == "avro":
        df = _read_avro(spark, table, path, options)
    else:
        df = spark.read.options(**(options or {})).schema(table.schema).format(table.storage).load(path)
    return _narrow(df, table, fields, predicate)


def _read_avro(spark, table, path, options):
    try:
        return spark.read.options(**(options or {})).schema(table.schema).format("avro").load(path)
    except AnalysisException as error:
        raise TableJobError("Avro files need the Spark Avro package or a Hive catalog") from error


def table_location(spark: SparkSession, table: TableDescriptor) -> str:
    """Where the rows of a table lie: catalog first, then the declared place, then the warehouse."""
    if spark.catalog.tableExists(table.full_name):
        return qualified_path(spark, look_up(spark, table.full_name).descriptor.location)
    return expected_location(spark, table)


def expected_location(spark: SparkSession, table: TableDescriptor) -> str:
    """Where a table that is still to be made will lie."""
    if table.location is None and spark.catalog.databaseExists(table.database):
        place = f"{spark.catalog.getDatabase(table.database).locationUri}/{table.table}"
    else:
        place = table.location_in(spark.conf.get("spark.sql.warehouse.dir"))
    return qualified_path(spark, place)


def scan_at_location(
    spark: SparkSession,
    table: TableDescriptor,
    fields: Fields | None = None,
    predicate: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a described table where it really lies, whether or not the catalog knows it."""
    if spark.catalog.tableExists(table.full_name):
        return scan_table(spark, table.full_name, fields, predicate, options)
    return scan_partitioned(spark, table, table_location(spark, table), fields, predicate, options)
