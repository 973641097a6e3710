"""Reading a transactional table as of a snapshot.

A transactional table is a folder, with ``key=value`` folders inside if it is partitioned, that holds

* ``base_N``: the rows that were valid after transaction N, all earlier ones folded in;
* ``delta_A_B``: the change events of transactions A to B.

All of them are ORC files of change rows (``change_schema``): what happened (``op``), the identity of the
row (``orig_txn``, ``bucket``, ``row_id``), the transaction of the event (``txn``) and the row (``data``).
Files never change once their folder is there, so readers need no lock: they name the transactions they
accept.

``_commits`` holds a record for each base and delta: which folders are the real ones, and what they hold. It is written
last and only if there is none of this name, so a folder counts as a whole or not at all, and of two writers of one
transaction only one wins. A table without ``_commits`` was written by others; all of its folders count.

Files of a table with buckets are dealt by a hash of the row identity, equally in all folders.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.descriptor import TableDescriptor
from tablejobs.errors import FieldError, SnapshotError
from tablejobs.operators.fields import lower_names, partition_filter
from tablejobs.storage import exists, glob, partition_value, qualified_path, read_file

# Fixed values of the change format.
INSERT, UPDATE, DELETE = 0, 1, 2
ROW_ID = ("orig_txn", "bucket", "row_id")
EVENT = ("op", *ROW_ID, "txn", "data")

# While rows are read, the columns of an event have names that no column of a table should have.
INNER = "__"
INNER_ROW_ID = tuple(INNER + name for name in ROW_ID)
BASE = "__base"

_FOLDER = re.compile(r"^(base|delta)_(\d+)(?:_(\d+))?")

COMMITS = "_commits"
#: Commit records that are read at a time.
READS = 16
#: Rows one task merges by row id without a shuffle; larger buckets are merged by a shuffle that spreads them.
BUCKET_ROWS = 20_000_000


@dataclass(frozen=True)
class Snapshot:
    """The transactions a reader accepts: those up to ``high_mark`` that are not ``open_txns``."""

    high_mark: int
    open_txns: frozenset[int] = frozenset()

    def __post_init__(self):
        object.__setattr__(self, "open_txns", frozenset(self.open_txns))

    @classmethod
    def parse(cls, text: str) -> Snapshot:
        """From ``"<high mark>:<open>:<open>.."``; ``"7:"`` accepts all transactions up to 7."""
        high, *rest = [part for part in re.split("[:,]", text) if part]
        return cls(int(high), frozenset(map(int, rest)))

    def accepts(self, txn: Column) -> Column:
        inside = txn <= self.high_mark
        return inside & ~txn.isin(*self.open_txns) if self.open_txns else inside

    def accepts_base(self, txn: int) -> bool:
        # Nothing can be taken out of a base again, so no open transaction may lie inside.
        return txn <= self.high_mark and all(txn < other for other in self.open_txns)


def change_schema(table: TableDescriptor) -> T.StructType:
    """Columns of the change files of a table, without its partition columns."""
    taken = [name for name in table.partition_names if name in EVENT]
    if taken:
        raise FieldError(f"{table.full_name}: partition columns of a transactional table cannot be {taken}")
    return T.StructType(
        [
            T.StructField("op", T.IntegerType()),
            T.StructField("orig_txn", T.LongType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("row_id", T.LongType()),
            T.StructField("txn", T.LongType()),
            T.StructField("data", table.data_schema),
        ]
    )


@dataclass(frozen=True)
class _Folder:
    path: str
    kind: str
    low: int
    high: int
    # From the commit record; without one, a folder may hold anything.
    inserts: bool = True
    changes: bool = True
    buckets: int = 0
    largest: int = 0


@dataclass(frozen=True)
class _Choice:
    """What to read of one partition."""

    base: _Folder | None
    deltas: tuple[_Folder, ...]

    @property
    def cut(self) -> int | None:
        """Events up to here are in the base already; only set if a delta reaches across it."""
        reaches_across = any(self.base and d.low <= self.base.high for d in self.deltas)
        return self.base.high if reaches_across else None


def read_commits(spark: SparkSession, root: str) -> dict[str, dict] | None:
    """The commit records by name of base or delta; None if the table has none.

    An empty record was begun by a writer that has not finished, or never will: nothing is committed by it.
    """
    if not exists(spark, f"{root}/{COMMITS}"):
        return None
    paths = glob(spark, f"{root}/{COMMITS}/*")
    with ThreadPoolExecutor(READS) as pool:
        texts = list(pool.map(lambda path: read_file(spark, path), paths))
    return {path.rpartition("/")[2]: json.loads(text) for path, text in zip(paths, texts) if text}


def list_folders(
    spark: SparkSession, table: TableDescriptor, root: str, predicate: str | None = None
) -> dict[str, list[_Folder]]:
    """Committed base and delta folders of each partition folder.

    Records are read first and folders afterwards: what a record names is all there. With a predicate, the partition
    folders are listed first, and only the selected ones are looked into.
    """
    commits = read_commits(spark, root)
    by_folder = None if commits is None else {record["folder"]: record for record in commits.values()}
    levels = "".join(f"{name}=*/" for name in table.partition_names)
    places = [f"{root}/{levels}"]
    if predicate is not None and table.partitioned:
        places = [f"{_escaped(path)}/" for path in _selected(spark, table, glob(spark, f"{root}/{levels.rstrip('/')}"), predicate)]
    elif predicate is not None:
        _selected(spark, table, [root], predicate)  # checks the predicate
    found = defaultdict(list)
    for path in (path for place in places for path in glob(spark, f"{place}{{base,delta}}_*")):
        partition, _, name = path.rpartition("/")
        match = _FOLDER.match(name)
        if match and (by_folder is None or name in by_folder):
            kind, low, high = match.groups()
            low = int(low)
            about = {k: v for k, v in (by_folder or {}).get(name, {}).items() if k != "folder"}
            found[partition].append(_Folder(path, kind, low, low if kind == "base" else int(high or low), **about))
    if commits is None and exists(spark, f"{root}/{COMMITS}"):
        return list_folders(spark, table, root, predicate)  # the first commit began meanwhile
    return found


def _escaped(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _selected(spark: SparkSession, table: TableDescriptor, folders: Sequence[str], predicate: str) -> list[str]:
    """The partition folders a predicate selects, so that no other is looked into."""
    known = spark.createDataFrame([(path,) for path in folders], "__folder string")
    kept = partition_filter(known.select("__folder", *_keys(table)), predicate, table.partition_names)
    return [row["__folder"] for row in kept.select("__folder").collect()]


def _keys(table: TableDescriptor) -> list[Column]:
    """The partition columns of a folder, from its path."""
    return [partition_value(F.col("__folder"), f) for f in (table.partition_schema if table.partitioned else ())]


def _reaches(deltas: Iterable[_Folder], last: int) -> bool:
    """Do the deltas hold every transaction from the first to ``last``?"""
    covered = 0
    for delta in sorted(deltas, key=lambda d: d.low):
        if delta.low > covered + 1:
            break
        covered = max(covered, delta.high)
    return covered >= last


def _choose(partition: str, folders: list[_Folder], snapshot: Snapshot) -> _Choice:
    bases = [f for f in folders if f.kind == "base"]
    deltas = [f for f in folders if f.kind == "delta" and f.low <= snapshot.high_mark]
    usable = [f for f in bases if snapshot.accepts_base(f.high)]
    base = max(usable, key=lambda f: f.high, default=None)
    if bases and base is None:
        first = min(f.high for f in bases)
        if not _reaches(deltas, min(first, snapshot.high_mark)):
            raise SnapshotError(
                f"{partition}: every base is newer than the snapshot or holds an open transaction, "
                "and the deltas do not reach back to the start"
            )
    after = base.high if base else 0
    return _Choice(base, tuple(d for d in deltas if d.high > after))


def _wanted(table: TableDescriptor, columns: Sequence[str] | None) -> list[str]:
    if columns is None:
        return table.data_names
    wanted = lower_names(columns)
    unknown = [name for name in wanted if name not in table.schema.names]
    if unknown:
        raise FieldError(f"columns not in {table.full_name}: {unknown}")
    return [name for name in wanted if name in table.data_names]


def _data(names: Sequence[str], row: str) -> list[Column]:
    return [F.col(f"{row}.`{name}`").alias(name) for name in names]


def snapshot_read(
    spark: SparkSession,
    table: TableDescriptor,
    root: str,
    snapshot: Snapshot,
    row_id: bool = False,
    columns: Sequence[str] | None = None,
    predicate: str | None = None,
) -> DataFrame:
    """The rows of a transactional table as a snapshot sees them.

    Base rows and inserted rows come from one scan and pass unless an accepted update or delete names their
    row id; these ids are narrow, and Spark joins them by broadcast or by one shuffle of each side, by its own
    estimate of their bytes. For changed row ids the newest accepted event counts, and a delete removes the row.
    Where commit records say that no delta holds updates or deletes, nothing is joined or shuffled. If base and
    deltas share buckets, they are merged by row id within each bucket, without a shuffle; buckets of more than
    ``BUCKET_ROWS`` rows go the other way, which spreads their rows. Partitions without deltas take no part.

    No job runs while the frame is built, unless a predicate has to be evaluated on the names of partition
    folders. The number of scans does not follow the number of partitions.

    ``row_id`` puts ``orig_txn, bucket, row_id`` in front, ``columns`` limits the columns read, and
    ``predicate`` selects partitions before their base and delta folders are listed.
    """
    names = _wanted(table, columns)
    wanted_keys = table.partition_names if columns is None else lower_names(columns)
    shown = names + [name for name in table.partition_names if name in wanted_keys]
    taken = [name for name in shown if row_id and name in ROW_ID]
    if taken:
        raise FieldError(f"columns {taken} cannot be read beside the row id, leave them out")
    rows = rows_with_id(spark, table, root, snapshot, names, predicate)
    front = [F.col(INNER + name).alias(name) for name in ROW_ID] if row_id else []
    return rows.select(*front, *[F.col(f"`{name}`") for name in shown])


def rows_with_id(
    spark: SparkSession,
    table: TableDescriptor,
    root: str,
    snapshot: Snapshot,
    names: Sequence[str],
    predicate: str | None = None,
) -> DataFrame:
    """What ``snapshot_read`` reads: partition columns, row id under inner names, the named data columns."""
    root = qualified_path(spark, root)
    keys = [*table.partition_names, *INNER_ROW_ID]
    schema = T.StructType(
        [*change_schema(table), *(table.partition_schema if table.partitioned else ())]
    )
    folders = list_folders(spark, table, root, predicate)
    choices = [_choose(partition, found, snapshot) for partition, found in folders.items()]

    cuts = {partition: choice.cut for partition, choice in zip(folders, choices) if choice.cut is not None}
    # Rows of a base pass like the inserts they came from, unless the base folds in other events or is cut out of deltas.
    told_apart = bool(cuts) or any(choice.base and choice.base.changes for choice in choices)

    def read(found: Iterable[_Folder], buckets: int = 0) -> DataFrame:
        paths = [folder.path for folder in found]
        if buckets:
            df = _bucketed(spark, paths, schema, root, buckets)
        else:
            reader = spark.read.schema(schema).option("basePath", root)
            df = reader.orc(paths) if paths else spark.createDataFrame([], schema)
        # The folder of a file: one of a base begins with "base_".
        folder = F.element_at(F.split("_metadata.file_path", "/"), -2) if paths and told_apart else F.lit("")
        of_base = folder.startswith("base_")
        return df.select(*[F.col(name).alias(INNER + name) for name in EVENT], of_base.alias(BASE), *table.partition_names)

    def base_rows(found: Iterable[_Folder]) -> DataFrame:
        return read(found).where(F.col("__op") != DELETE).select(*keys, *_data(names, "__data"))

    deltas = [delta for choice in choices for delta in choice.deltas]
    touched = [c.base for c in choices if c.base and c.deltas]

    def accepted(rows: DataFrame) -> DataFrame:
        """Rows of bases, and events that the snapshot sees and the base of their partition does not hold already."""
        if not told_apart:
            return rows.where(snapshot.accepts(F.col("__txn")))
        rows = rows.where((F.col(BASE) & (F.col("__op") != DELETE)) | (~F.col(BASE) & snapshot.accepts(F.col("__txn"))))
        return _after_cuts(rows, table, cuts) if cuts else rows

    parts = []
    if untouched := [c.base for c in choices if c.base and not c.deltas]:
        parts.append(base_rows(untouched))
    changing = [delta for delta in deltas if delta.changes]
    if deltas and changing and _aligned([*touched, *deltas], table):
        parts.append(_newest(accepted(read([*touched, *deltas], table.buckets)), keys, names))
    elif deltas:
        # A row id is inserted once, in its first transaction, so an insert is a row like one of a base. Both come
        # from one scan: a union would let the join sink into its parts and double what is joined.
        rows = accepted(read([*touched, *[delta for delta in deltas if delta.inserts]]))
        inserted = F.col("__op") == INSERT
        rows = rows.where(F.col(BASE) | inserted if told_apart else inserted).select(*keys, *_data(names, "__data"))
        if changing:
            changes = accepted(read(changing)).where(F.col("__op") != INSERT)
            parts += [_without(rows, changes, keys), _newest(changes, keys, names)]
        else:
            parts.append(rows)
    return reduce(DataFrame.unionByName, parts or [base_rows([])])


def _aligned(folders: Sequence[_Folder], table: TableDescriptor) -> bool:
    """Do all folders share the buckets of the table, with few enough rows in each?"""
    same = table.buckets > 0 and all(folder.buckets == table.buckets for folder in folders)
    return same and sum(folder.largest for folder in folders) <= BUCKET_ROWS


def _bucketed(spark: SparkSession, paths: list[str], schema: T.StructType, root: str, buckets: int) -> DataFrame:
    """One scan of folders whose files are dealt by row identity, told to Spark as its own bucketing."""
    jvm = spark._jvm
    scala = jvm.org.apache.spark.api.python.PythonUtils

    def seq(values):
        return scala.toSeq(jvm.java.util.ArrayList(list(values)))

    spec = jvm.org.apache.spark.sql.catalyst.catalog.BucketSpec(buckets, seq(ROW_ID), seq([]))
    kind = jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    options = scala.toScalaMap(jvm.java.util.HashMap({"basePath": root}))
    some, none = jvm.scala.Option.apply, jvm.scala.Option.empty()
    source = jvm.org.apache.spark.sql.execution.datasources.DataSource(
        spark._jsparkSession, "orc", seq(paths), some(kind), seq([]), some(spec), options, none
    )
    relation = source.resolveRelation(False, True)
    return DataFrame(spark._jsparkSession.baseRelationToDataFrame(relation), spark)


def _after_cuts(events: DataFrame, table: TableDescriptor, cuts: dict[str, int]) -> DataFrame:
    """Events that the base of their partition does not hold already, and all base rows. The cuts are rows, one per
    partition."""
    spark = events.sparkSession
    known = spark.createDataFrame(list(cuts.items()), "__folder string, __cut bigint")
    if not table.partitioned:
        return events.where(F.col(BASE) | (F.col("__txn") > next(iter(cuts.values()))))
    keys = [key.alias(f"__of_{name}") for key, name in zip(_keys(table), table.partition_names)]
    known = known.select("__cut", *keys)
    same = [events[name].eqNullSafe(known[f"__of_{name}"]) for name in table.partition_names]
    later = F.col(BASE) | F.col("__cut").isNull() | (F.col("__txn") > F.col("__cut"))
    return events.join(known, same, "left").where(later).drop("__cut", *[f"__of_{name}" for name in table.partition_names])


def _newest(events: DataFrame, keys: list[str], names: Sequence[str]) -> DataFrame:
    """The newest event or base row per row id, without deletes. ``max_by`` is combined before the shuffle, so a row
    that was changed very often reaches the final task as a few rows only."""
    event = F.struct(F.col("__op").alias("op"), F.struct(*_data(names, "__data")).alias("data"))
    newest = events.groupBy(*keys).agg(F.max_by(event, "__txn").alias("__event"))
    kept = newest.where(F.col("__event.op") != DELETE)
    return kept.select(*keys, *_data(names, "__event.data"))


def _without(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose row id no update or delete names."""
    changed = changes.select(*[F.col(key).alias(f"changed_{key}") for key in keys]).distinct()
    same_row = [
        rows[key] == changed[f"changed_{key}"]
        if key in INNER_ROW_ID
        else rows[key].eqNullSafe(changed[f"changed_{key}"])
        for key in keys
    ]
    return rows.join(changed, same_row, "left_anti")
