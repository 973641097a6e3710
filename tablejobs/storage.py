"""Where intermediate tables go, and the few file-system calls the library needs."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: a null in the path of a partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

_named: list[str] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tablejobs-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may leave that setting out.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    path = f"{root.rstrip('/')}/tablejobs/{label}-{uuid.uuid4().hex}"
    _named.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete the folders ``shared_folder`` named in this process. Frames that read them end with it."""
    while _named:
        path = _named.pop()
        if exists(spark, path):
            remove(spark, path)


def materialize(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later use does not compute it again."""
    path = shared_folder(df.sparkSession, label)
    # Numbered columns allow any names, repeated ones too; files have no type for nothing but nulls.
    places = [f"c{i}" for i in range(len(df.columns))]
    voids = {c for c, f in zip(places, df.schema) if isinstance(f.dataType, T.NullType)}
    numbered = df.toDF(*places)
    numbered.select([F.col(c).cast("string") if c in voids else c for c in places]).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored = stored.select([F.lit(None).alias(c) if c in voids else c for c in places]).toDF(*df.columns)
    stored.kept_at = path
    return stored


def release(df: DataFrame) -> None:
    """Delete what ``materialize`` kept for ``df``. No frame that reads it may be used afterwards."""
    path = df.kept_at
    if path in _named:
        _named.remove(path)
    remove(df.sparkSession, path)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    """Set a session setting for a block of code."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def quoted(name: str) -> str:
    """A one- or many-part identifier in back ticks."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def literal(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def decoded(text: Column) -> Column:
    """Text with its ``%xx`` codes replaced."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def partition_value(path: Column, field: T.StructField) -> Column:
    """The value of a partition column in the path of a folder or file."""
    text = decoded(F.regexp_extract(path, f"/{re.escape(field.name)}=([^/]*)(/|$)", 1))
    return F.nullif(text, F.lit(NULL_PARTITION)).cast(field.dataType).alias(field.name)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, without a trailing slash."""
    return _file_system(spark, path).makeQualified(_path(spark, path)).toString().rstrip("/")


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, sorted. Meant for directories, never for the files of a table."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or [])


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def move(spark: SparkSession, source: str, target: str) -> None:
    files = _file_system(spark, source)
    files.mkdirs(_path(spark, target).getParent())
    if exists(spark, target) or not files.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot move {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless one of this name is there already; says whether it was written."""
    from py4j.protocol import Py4JJavaError

    try:
        out = _file_system(spark, path).create(_path(spark, path), False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)
