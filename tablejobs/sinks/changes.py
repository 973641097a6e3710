"""Writing base and delta folders of a transactional table, and changes as new deltas."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import TableDescriptor
from tablejobs.errors import FieldError, SnapshotError
from tablejobs.operators.fields import align_to_table, fitted
from tablejobs.sinks.tables import no_empty_keys, rebalanced
from tablejobs.sources.snapshot import (
    COMMITS,
    DELETE,
    INNER,
    INSERT,
    ROW_ID,
    UPDATE,
    Snapshot,
    change_schema,
    list_folders,
    read_commits,
    rows_with_id,
)
from tablejobs.storage import (
    create_file,
    decoded,
    glob,
    make_folder,
    materialize,
    move,
    partition_value,
    qualified_path,
    quoted,
    remove,
)

# The columns of the public layout, in the order of ours.
PUBLIC_LAYOUT = ("operation", "originalTransaction", "bucket", "rowId", "currentTransaction", "row")
#: Folders that are put in place at a time.
MOVES = 16
#: Tasks that write a bucket.
PARTS = 4


def insert_events(
    df: DataFrame, table: TableDescriptor, txn: int, row_id: Column | str, bucket: Column | str
) -> DataFrame:
    """Insert events for rows. ``row_id`` and ``bucket`` are expressions over the table's columns that
    identify a row within its partition."""
    row_id, bucket = (F.expr(c) if isinstance(c, str) else c for c in (row_id, bucket))
    return align_to_table(df, table).select(
        F.lit(INSERT).alias("op"),
        F.lit(txn).cast("long").alias("orig_txn"),
        bucket.cast("int").alias("bucket"),
        row_id.cast("long").alias("row_id"),
        F.lit(txn).cast("long").alias("txn"),
        F.struct(*[F.col(f"`{name}`") for name in table.data_names]).alias("data"),
        *table.partition_names,
    )


def _write_folder(
    events: DataFrame, table: TableDescriptor, root: str, name: str, low: int, high: int, check: bool
) -> None:
    """Stage, check, move into place under a name of its own, then commit: the record is what makes it count."""
    spark = events.sparkSession
    root = qualified_path(spark, root)
    levels = "".join(f"{key}=*/" for key in table.partition_names)
    if _is_there(spark, root, levels, name):
        raise SnapshotError(f"{root}: {name} is there already")
    staging = f"{root}/_staging_{uuid.uuid4().hex}"
    seen = Observation()
    rows = no_empty_keys(events.select(*change_schema(table).names, *table.partition_names), table)
    unnamed = reduce(Column.__or__, [F.col(column).isNull() for column in ("op", *ROW_ID, "txn")])
    # Buckets are cut finer by the same hash, so that no task writes a whole one.
    dealt = rows.repartition(table.buckets * PARTS, *ROW_ID) if table.buckets else rebalanced(rows, table.partition_names)
    rows = dealt.observe(
        seen,
        F.min("txn").alias("first"),
        F.max("txn").alias("last"),
        F.max(unnamed).alias("unnamed"),
        F.coalesce(F.max(F.col("op") == INSERT), F.lit(False)).alias("inserts"),
        F.coalesce(F.max(F.col("op") != INSERT), F.lit(False)).alias("changes"),
    )
    if table.buckets:
        # Spark writes buckets through a table; it goes at once, its files stay.
        passing = quoted(f"passing_{uuid.uuid4().hex}")
        writer = rows.write.format("orc").option("path", staging).bucketBy(table.buckets, *ROW_ID)
        writer = writer.partitionBy(*table.partition_names) if table.partitioned else writer
        writer.saveAsTable(passing)
        spark.sql(f"DROP TABLE {passing}")
    else:
        rows.write.partitionBy(*table.partition_names).orc(staging)
    found = seen.get
    if found["unnamed"]:
        remove(spark, staging)
        raise SnapshotError(f"{name} holds an event without operation, row id or transaction")
    if found["first"] is not None and not (low <= found["first"] and found["last"] <= high):
        remove(spark, staging)
        raise SnapshotError(f"{name} holds transactions {found['first']} to {found['last']}")
    written = spark.read.schema(events.select(*table.partition_names, *ROW_ID, "txn").schema).orc(staging)
    if check:
        version = [*table.partition_names, *ROW_ID, *(() if name.startswith("base") else ("txn",))]
        twice = written.groupBy(*version).count().where("count > 1")
        if not twice.isEmpty():
            remove(spark, staging)
            raise SnapshotError(f"{name} holds a row id twice for one transaction")
    largest = 0
    if table.buckets:
        sizes = written.groupBy(F.pmod(F.hash(*ROW_ID), F.lit(table.buckets)).alias("bucket")).count()
        largest = sizes.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    folder = f"{name}_{uuid.uuid4().hex}"
    # From now on folders count by their records, not by being there.
    make_folder(spark, f"{root}/{COMMITS}")
    if table.partitioned:
        folders = glob(spark, f"{staging}/{levels.rstrip('/')}")
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda path: move(spark, path, f"{root}{path[len(staging):]}/{folder}"), folders))
        remove(spark, staging)
    else:
        move(spark, staging, f"{root}/{folder}")
    record = {
        "folder": folder, "inserts": found["inserts"], "changes": found["changes"], "buckets": table.buckets, "largest": largest,
    }
    if not create_file(spark, f"{root}/{COMMITS}/{name}", json.dumps(record)):
        for path in glob(spark, f"{root}/{levels}{folder}"):
            remove(spark, path)
        raise SnapshotError(f"{root}: {name} is there already, another writer has committed it")


def _is_there(spark: SparkSession, root: str, levels: str, name: str) -> bool:
    commits = read_commits(spark, root)
    if commits is None:
        return bool(glob(spark, f"{root}/{levels}{name}*"))
    return name in commits


def remove_uncommitted(spark: SparkSession, table: TableDescriptor, root: str) -> list[str]:
    """Delete what broken or refused writers left, and return these paths. No writer may be at work meanwhile.

    Records that were begun and never finished go too, so that their transaction can be written again.
    """
    root = qualified_path(spark, root)
    commits = read_commits(spark, root)
    left = glob(spark, f"{root}/_staging_*")
    if commits is not None:
        levels = "".join(f"{key}=*/" for key in table.partition_names)
        kept = {record["folder"] for record in commits.values()}
        left += [p for p in glob(spark, f"{root}/{levels}{{base,delta}}_*") if p.rpartition("/")[2] not in kept]
        left += [p for p in glob(spark, f"{root}/{COMMITS}/*") if p.rpartition("/")[2] not in commits]
    for path in left:
        remove(spark, path)
    return left


def write_base(
    events: DataFrame, table: TableDescriptor, root: str, txn: int, check: bool = True
) -> None:
    """Write a base: one event per row, the state after transaction ``txn``."""
    _write_folder(events, table, root, f"base_{txn:07d}", 0, txn, check)


def write_delta(
    events: DataFrame,
    table: TableDescriptor,
    root: str,
    low: int,
    high: int | None = None,
    check: bool = True,
) -> None:
    """Write a delta with the events of transactions ``low`` to ``high``.

    ``check`` refuses two events of one transaction for one row id, with one narrow aggregation
    over what was written.
    """
    high = low if high is None else high
    _write_folder(events, table, root, f"delta_{low:07d}_{high:07d}", low, high, check)


def apply_changes(
    spark: SparkSession,
    table: TableDescriptor,
    root: str,
    snapshot: Snapshot,
    txn: int,
    assign: Mapping[str, str | Column] | None = None,
    update_where: str | Column | None = None,
    delete_where: str | Column | None = None,
) -> None:
    """``UPDATE .. SET .. WHERE`` and ``DELETE .. WHERE`` as one new delta of transaction ``txn``.

    The rows are those ``snapshot`` sees. A row that meets both conditions is deleted. Readers see the
    change once their snapshot accepts ``txn``.
    """
    if txn <= snapshot.high_mark:
        raise SnapshotError(f"transaction {txn} is not newer than the snapshot {snapshot.high_mark}")
    if delete_where is None and not assign:
        raise FieldError("nothing to do: give delete_where, or assign with update_where")
    assign = {name.lower(): value for name, value in (assign or {}).items()}
    unknown = [name for name in assign if name not in table.data_names]
    if unknown:
        raise FieldError(f"only data columns can be assigned, not {unknown}")

    def expression(given) -> Column:
        return F.expr(given) if isinstance(given, str) else given

    deleted = expression("false" if delete_where is None else delete_where)
    updated = expression("true" if update_where is None else update_where) if assign else F.lit(False)

    def new_value(field: T.StructField) -> Column:
        if field.name not in assign:
            return F.col(f"`{field.name}`")
        return fitted(expression(assign[field.name]), field.dataType, f"value of '{field.name}'")

    row = F.struct(*[new_value(field).alias(field.name) for field in table.data_schema])
    # The plain condition reaches the scan. A delete alone then reads the columns it tests, no others.
    op = F.when(deleted, F.lit(DELETE)).otherwise(F.lit(UPDATE))
    changed = rows_with_id(spark, table, root, snapshot, table.data_names).where(deleted | updated)
    events = changed.select(
        op.alias("op"),
        *[F.col(INNER + name).alias(name) for name in ROW_ID],
        F.lit(txn).cast("long").alias("txn"),
        (F.when(op == UPDATE, row) if assign else F.lit(None).cast(table.data_schema)).alias("data"),
        *table.partition_names,
    )
    events = materialize(events, "changes") if _unseen(spark, table, root, snapshot) else events
    _refuse_conflicts(spark, table, root, snapshot, events)
    # One event per row id by construction: the snapshot holds each row id once.
    write_delta(events, table, root, txn, check=False)


def _unseen(spark: SparkSession, table: TableDescriptor, root: str, snapshot: Snapshot) -> list[str]:
    """Deltas that hold, or may hold, transactions the snapshot does not accept."""
    folders = list_folders(spark, table, qualified_path(spark, root))
    return [
        folder.path
        for found in folders.values()
        for folder in found
        if folder.kind == "delta"
        and (folder.high > snapshot.high_mark or any(folder.low <= t <= folder.high for t in snapshot.open_txns))
    ]


def _refuse_conflicts(
    spark: SparkSession, table: TableDescriptor, root: str, snapshot: Snapshot, events: DataFrame
) -> None:
    """An update or delete that the snapshot does not see must not meet a row that is changed now: it would be lost."""
    paths = _unseen(spark, table, root, snapshot)
    if not paths:
        return
    keys = [*table.partition_names, *ROW_ID]
    schema = T.StructType([*change_schema(table), *(table.partition_schema if table.partitioned else ())])
    others = spark.read.schema(schema).option("basePath", qualified_path(spark, root)).orc(paths)
    others = others.where(~snapshot.accepts(F.col("txn")) & (F.col("op") != INSERT))
    others = others.select(*[F.col(key).alias(f"other_{key}") for key in keys])
    same = [events[key].eqNullSafe(others[f"other_{key}"]) for key in keys]
    if not events.select(*keys).join(others, same, "left_semi").isEmpty():
        raise SnapshotError(f"{table.full_name}: a transaction outside the snapshot changed some of these rows already")


def adopt_files(spark: SparkSession, table: TableDescriptor, source: str, root: str) -> None:
    """Copy a transactional table in the public ORC layout into one that ``snapshot_read`` reads.

    Spark cannot read some columns of such files without the others, nor partition columns beside them,
    so each base and delta is read whole, once, and written again with other column names. ``table``
    describes rows and partitions.
    """
    ours = change_schema(table)
    public = T.StructType([T.StructField(name, f.dataType) for name, f in zip(PUBLIC_LAYOUT, ours)])
    # Names of files come as addresses, in which the characters of a path are encoded once more.
    file = decoded(F.input_file_name())
    keys = [partition_value(file, field) for field in (table.partition_schema if table.partitioned else ())]
    by_name = defaultdict(list)
    for folders in list_folders(spark, table, qualified_path(spark, source)).values():
        for folder in folders:
            by_name[folder.kind, folder.low, folder.high].append(folder.path)
    for (kind, low, high), paths in sorted(by_name.items()):
        whole = spark.read.schema(public).option("recursiveFileLookup", "true").orc(paths)
        events = whole.toDF(*ours.names).select("*", *keys)
        if kind == "base":
            write_base(events, table, root, high)
        else:
            write_delta(events, table, root, low, high)
