"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that ends a word: what ``bytes.split()`` takes for it.
SPACE = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(id_column: Column, folds: int) -> Column:
    """The fold of a row: the CRC-32 of its id as text, modulo the number of folds; a null id is fold 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds, F.lit(0))


def python_fold(key: str, folds: int) -> int:
    return zlib.crc32(key.encode()) % folds


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under names of its own: further columns cannot clash with its results."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row in one, ``row``, so that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{name.replace('`', '``')}`") for name in docs.columns]).alias("row")


def whole_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """As ``ids_and_texts``, with the whole row beside them for operators that return it."""
    return docs.select(whole_row(docs), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def give_back() -> None:
    """Memory that a finished task has freed goes back to the system: Spark keeps its Python worker for other work."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # the C library of Linux alone has it
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(frame: DataFrame, columns: str, function, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``function`` turns a list of texts (null: None) into one list per new column; rows pass through in Arrow batches.

    ``columns`` are the new columns as DDL; ``keep`` names the columns of ``frame`` that stay in front.
    """
    added = T.StructType.fromDDL(columns)
    schema = T.StructType([frame.schema[name] for name in keep] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(added)
        for batch in batches:
            for part in slices(batch, batch.schema.get_field_index("text")):
                made = function(part.column("text").to_pylist())
                arrays = [part.column(name) for name in keep]
                arrays += [pa.array(values, field.type) for values, field in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        give_back()

    return frame.select(*keep, *({"text"} - {*keep})).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text_at: int | pa.Array, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text, so that memory follows bytes and not rows."""
    texts = batch.column(text_at) if isinstance(text_at, int) else text_at
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    start = size = 0
    for i, length in enumerate(lengths):
        size += length
        if size >= most:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
