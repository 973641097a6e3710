"""Cuts passages that repeat across documents, wherever in a line they begin.

Two documents share a passage if ``WIDTH`` words in a row are equal in both. Each window of that many words is known by
the lowest hash of the ``GRAM`` words in a row inside it, its mark; equal windows have equal marks, and neighbours
mostly share one, so a text gives a mark for about every eighteenth word. Only windows whose mark occurs in several
documents are hashed whole and compared: nothing is missed, and no row per word is dealt out. A window stays in the
first document that has it, the one with the lowest id; all others lose its words.

Marks and windows are counted with minima and maxima that combine before a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm.common import give_back, slices, whole_row
from tablejobs.llm.words import PART, Words
from tablejobs.storage import materialize, release

#: Words in a row that make a passage.
WIDTH = 50
#: Words in a row whose hash can be the mark of a window.
GRAM = 16
#: Up to so many documents' ids (8 bytes each) or lists of numbers (8 numbers each on average) are sent to all tasks;
#: beyond that, all texts are shuffled.
SENT = 500_000

_WORD = re.compile(r"\S+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row, the same wherever in a text they are."""
    n = len(hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n), dtype=np.uint64)])
    found = (sums[width:] - sums[:-width]) * _powers(_INVERSE, n - width + 1)
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest of each ``width`` values in a row."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def window_marks(hashes: np.ndarray) -> np.ndarray:
    """The mark of the window at each word, signed; none without a whole window."""
    if len(hashes) < WIDTH:
        return np.zeros(0, np.int64)
    return _lowest(_rolling(hashes, GRAM), WIDTH - GRAM + 1).view(np.int64)


def _whole_windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word of each window that lies in one text."""
    sizes = np.maximum(np.diff(words.texts) - WIDTH + 1, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) + np.repeat(words.texts[:-1] - np.cumsum(sizes) + sizes, sizes)


def without_lines(text: Column, dropped: Column) -> Column:
    """The text without the lines whose numbers are in ``dropped``; only texts that lose any are taken apart."""
    parts = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), dropped)
    left = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    return F.when(dropped.isNull(), text).otherwise(left)


def cut(text: str, starts: list[int]) -> tuple[str, int]:
    """The text without the windows that start at the given words, a line break in place of each cut inside it."""
    spans = [word.span() for word in _WORD.finditer(text)]
    covered = np.zeros(len(spans) + 1, np.int64)
    at = np.array(starts)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WIDTH, -1)
    gone = np.cumsum(covered)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))
    parts = []
    for first, end in zip(edges[::2], edges[1::2]):
        begin = 0 if first == 0 else spans[first][0]
        parts.append(text[begin : len(text) if end == len(spans) else spans[end - 1][1]])
    return "\n".join(parts), int(gone.sum())


def _marks(rows: DataFrame) -> DataFrame:
    """(uid, mark) for the marks of all windows of a text without its dropped lines; some come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PART):
                words = Words(part.column(1)).without(part.column(2))
                of, at = _whole_windows(words)
                marks = window_marks(words.hashes)[at]
                new = np.ones(len(of), bool)
                new[1:] = (marks[1:] != marks[:-1]) | (of[1:] != of[:-1])
                of = pa.array(of[new], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0).take(of), pa.array(marks[new])], names=["uid", "mark"])
        give_back()

    return rows.select("uid", "text", "dropped").mapInArrow(run, "uid long, mark long")


def _windows(rows: DataFrame) -> DataFrame:
    """(of, uid, id, at, window) for the windows whose mark is among ``marks``: word they start at and hash."""
    names = ("of", "uid", "id")
    schema = T.StructType([*[rows.schema[name] for name in names], *T.StructType.fromDDL("at int, window long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, PART):
                words = Words(part.column(3))
                of, at = _whole_windows(words)
                marks = window_marks(words.hashes)[at]
                edges = np.searchsorted(of, np.arange(part.num_rows + 1))
                asked = part.column(4)
                chosen = np.zeros(len(of), bool)
                for i in range(part.num_rows):
                    begin, end = edges[i], edges[i + 1]
                    chosen[begin:end] = np.isin(marks[begin:end], asked[i].values.to_numpy(zero_copy_only=False))
                of, at = of[chosen], at[chosen]
                window = _rolling(words.hashes, WIDTH).view(np.int64)[at] if len(at) else at
                rows_of = pa.array(of, pa.int32())
                columns = [part.column(i).take(rows_of) for i in range(len(names))]
                columns += [pa.array(at - words.texts[of], pa.int32()), pa.array(window, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        give_back()

    return rows.select(*names, "text", "marks").mapInArrow(run, schema)


def with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows whose uid has a list, beside it.

    Other texts are not shuffled, if the documents that have one are few enough to be sent to all tasks.
    """
    lists = materialize(lists.withColumnRenamed("uid", "of"), "lists")
    own = F.col("uid") == F.col("of")
    if lists.count() <= SENT:
        rows = rows.join(F.broadcast(lists.select("of")), own, "left_semi")
    return rows.join(lists, own).drop("of")


def beside(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """All rows, beside the lists of their uid (``of``), null where there are none.

    Texts are not shuffled, if the lists are few and short enough to be sent to all tasks.
    """
    numbers = [F.coalesce(F.size(name), F.lit(0)) for name in lists.columns if name != "of"]
    held = lists.agg(F.count("*"), *[F.sum(own.cast("long")) for own in numbers]).first()
    few = held[0] <= SENT and sum(own or 0 for own in held[1:]) <= 8 * SENT
    return rows.join(F.broadcast(lists) if few else lists, F.col("uid") == F.col("of"), "left").drop("of")


def stays_with(lowest: Column, first: Column) -> Column:
    """Whether a row of ``uid`` and ``id`` belongs to the first document of what it shares."""
    return F.when(first.isNull(), F.col("uid") == lowest).otherwise(F.col("id").eqNullSafe(first))


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row (all other columns), text without the words of passages that an earlier document has, n_cut (words).

    Words are what white space parts; a passage may run across line breaks. Documents are told apart by id and text, as
    in ``line_dedup.dedup_lines``: an exact repetition of a row is treated alike, rows with the lowest id keep a
    passage, and without any id the one with the lowest hash does. Passages are those of the texts handed in: words
    that only a cut brings together, now with a line break between them, are not searched again.
    """
    rows = docs.select(whole_row(docs.drop(text_col)), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("id", "text"))
    found = beside(rows, materialize(passage_starts(rows), "starts")).select("row", "text", "starts")
    schema = T.StructType([found.schema["row"], *T.StructType.fromDDL("text string, n_cut long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                pairs = zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                made = [cut(text, starts) if starts else (text, 0) for text, starts in pairs]
                columns = [part.column(0), pa.array([m[0] for m in made], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([m[1] for m in made], pa.int64())], names=schema.names)

    return found.mapInArrow(run, schema)


def passage_starts(rows: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """(of, starts): the words at which windows begin that the document with uid ``of`` loses.

    ``rows`` are uid, id and text; ``dropped``, if given, has the numbers of lines (``dropped``) that the document with
    uid ``of`` has lost already. Words are numbered, and documents told apart, by the texts without these lines.
    """
    rows = rows.select("uid", "id", "text")

    def lined(some: DataFrame) -> DataFrame:
        return beside(some, dropped) if dropped is not None else some.withColumn("dropped", F.lit(None).cast("array<int>"))

    marks = materialize(_marks(lined(rows.select("uid", "text"))), "marks")
    shared = marks.groupBy("mark").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low <> high")
    searched = marks.join(shared.select("mark"), "mark").groupBy("uid").agg(F.collect_set("mark").alias("marks"))
    texts = lined(with_lists(rows, searched))
    texts = texts.withColumn("text", without_lines(F.col("text"), F.col("dropped"))).withColumnRenamed("uid", "of")
    windows = materialize(_windows(texts.withColumn("uid", F.xxhash64("id", "text"))), "windows")
    release(marks)
    recurring = (
        windows.groupBy("window")
        .agg(F.min("uid").alias("lowest"), F.max("uid").alias("highest"), F.min("id").alias("first"))
        .where("lowest <> highest")
    )
    return (
        windows.join(recurring.drop("highest"), "window")
        .where(~stays_with(F.col("lowest"), F.col("first")))
        .groupBy("of")
        .agg(F.collect_set("at").alias("starts"))
    )
