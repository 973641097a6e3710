"""Drops lines whose template recurs across documents, and passages that do so inside longer lines.

A line goes down a tree of fixed depth: first by its number of tokens, then by its leading tokens, with tokens that
hold a digit read as a variable field. In the leaf it ends in, further fields may vary: a token is a constant of its
place if another document has it at the same place of the same leaf, and a variable field otherwise. The line with its
fields replaced is its template. A template that occurs in several documents is kept in the first of them, the one
with the lowest id, and its lines are dropped from all others.

Lines are parsed once, in Arrow batches, to hash keys; everything after that is counted by keys, with minima and maxima
that combine before a shuffle, so a line that a third of all documents share costs each task one row. Only leaves that
hold different lines of different documents are opened for the search of further fields. ``dedup_texts`` links similar
lines of a leaf instead, so that values of a field may recur, and goes on with the passages that the remaining texts
share, see ``passages``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import passages
from tablejobs.llm.common import give_back, slices, whole_row
from tablejobs.llm.passages import stays_with
from tablejobs.llm.simhash import components
from tablejobs.llm.words import PART, Words, lists, mixed
from tablejobs.storage import materialize, release

#: Leading tokens that lead to a leaf.
DEPTH = 3
#: Tokens a line must have; shorter ones recur by chance and stay.
LEAST_TOKENS = 4
#: Share of a template's tokens that must be constants.
SIMILARITY = 0.8

FIELD = "<*>"
_DIGIT = re.compile("[0-9]")


def tokens_of(line: str) -> list[str]:
    """The words of a line, those with a digit replaced by the variable field."""
    tokens = line.split()
    return [FIELD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


class _Lines:
    """Per line with enough tokens, over many texts: text, line (its number), start, n (tokens), leaf and full.

    ``full`` is a hash of all tokens of a line, ``tokens`` has hashes of those of all lines.
    """

    def __init__(self, words: Words):
        field = Words(pa.array([FIELD])).hashes[0]
        self.tokens = np.where(words.hashes & np.uint64(1), field, words.hashes)
        sizes = np.diff(words.lines)
        of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        place = np.arange(len(self.tokens)) - np.repeat(words.lines[:-1], sizes)
        sums = np.cumsum(mixed(self.tokens + mixed(place.astype(np.uint64))), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), sums])
        long = np.flatnonzero(sizes >= LEAST_TOKENS)
        self.text, self.line = of[long], (long - words.first[of[long]]).astype(np.int32)
        self.start, self.n = words.lines[long], sizes[long]
        count = mixed(self.n.astype(np.uint64))
        self.full = mixed((sums[self.start + self.n] - sums[self.start]) ^ count).view(np.int64)
        leaf = count
        for k in range(DEPTH):
            leaf = mixed(leaf ^ self.tokens[self.start + k])
        self.leaf = leaf.view(np.int64)


def _lines(rows: DataFrame) -> DataFrame:
    """Per line with enough tokens: uid, id, line (its number), leaf, full; written as one row per text."""
    schema = T.StructType(
        [rows.schema["uid"], rows.schema["id"], *T.StructType.fromDDL("line array<int>, leaf array<long>, full array<long>")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, PART):
                found = _Lines(Words(part.column(2)))
                sizes = np.bincount(found.text, minlength=part.num_rows)
                columns = [lists(sizes, pa.array(own)) for own in (found.line, found.leaf, found.full)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=schema.names)
        give_back()

    return materialize(rows.select("uid", "id", "text").mapInArrow(run, schema).where(F.size("line") > 0), "lines")


def _one_by_one(lines: DataFrame) -> DataFrame:
    return lines.select("uid", "id", F.inline(F.arrays_zip("line", "leaf", "full")))


def _with_tokens(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(leaf, full, tokens) for lines of leaves that hold different lines of different documents; tokens are 32-bit hashes.

    Each line is taken from one document that has it, so only these are parsed again.
    """
    mixed_leaves = (
        seen.groupBy("leaf")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("full").alias("f"), F.max("full").alias("g"))
        .where("low <> high and f <> g")
        .select("leaf")
    )
    wanted = seen.join(mixed_leaves, "leaf", "left_semi").groupBy(F.col("low").alias("uid"))
    wanted = wanted.agg(F.collect_set("full").alias("fulls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, PART):
                found = _Lines(Words(part.column(0)))
                # Lines wanted from other texts of the part are found here too; they are made one again below.
                chosen = np.isin(found.full, part.column(1).flatten().to_numpy(zero_copy_only=False))
                sizes = found.n[chosen]
                at = np.arange(sizes.sum()) + np.repeat(found.start[chosen] - np.cumsum(sizes) + sizes, sizes)
                tokens = (found.tokens[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns = [pa.array(found.leaf[chosen]), pa.array(found.full[chosen]), lists(sizes, pa.array(tokens))]
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "full", "tokens"])
        give_back()

    found = passages.with_lists(rows.select("uid", "text"), wanted).select("text", "fulls")
    found = found.mapInArrow(run, "leaf long, full long, tokens array<int>")
    return found.groupBy("full").agg(F.any_value("leaf").alias("leaf"), F.any_value("tokens").alias("tokens"))


def _generalised(rows: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(full, template) for lines of leaves where more than the masked fields may vary, and the table it reads."""
    places = (
        _with_tokens(rows, seen)
        .join(seen.select("full", "low", "high"), "full")
        .select("leaf", "full", "low", "high", F.posexplode("tokens").alias("place", "token"))
    )
    places = materialize(places, "places")
    constants = (
        places.groupBy("leaf", "place", "token")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low <> high")
        .select("leaf", "place", "token", F.lit(True).alias("constant"))
    )
    # The hash of a template is an exclusive or over its places, which combines in any order.
    own = F.when(F.col("constant"), F.col("token").cast("long"))
    templates = (
        places.join(constants, ["leaf", "place", "token"], "left")
        .groupBy("leaf", "full")
        .agg(
            F.bit_xor(F.xxhash64("place", own)).alias("sum"),
            F.avg(F.coalesce("constant", F.lit(False)).cast("int")).alias("share"),
        )
        .where(F.col("share") >= SIMILARITY)
        .select("full", F.xxhash64("leaf", "sum").alias("template"))
    )
    return templates, places


def _allowed(n: Column) -> Column:
    """In how many places lines of ``n`` tokens may differ."""
    return n - F.ceil(F.round(SIMILARITY * n, 6)).cast("int")


def _keys() -> Column:
    """Hashes of one more stretch of a line than it may have differing places: similar lines share one of them."""
    free, parts = F.size("tokens") - DEPTH, _allowed(F.size("tokens")) + 1

    def key(part: Column) -> Column:
        start = F.floor(part * free / parts).cast("int")
        end = F.floor((part + 1) * free / parts).cast("int")
        return F.xxhash64("leaf", part, F.slice("tokens", start + DEPTH + 1, end - start))

    return F.transform(F.sequence(F.lit(0), parts - 1), key)


def _linked(tokens: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the lines, one a row, that differ in at most ``most`` places."""
    rest = np.arange(len(tokens))
    queue: list[int] = []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        near = (tokens[rest] != tokens[at]).sum(1) <= most
        yield from ((at, other) for other in rest[near])
        queue.extend(rest[near])
        rest = rest[~near]


def _similar(rows: DataFrame, seen: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(full, template) for lines that are similar to another, and the tables it reads but the result.

    Lines of one leaf are linked if at least ``SIMILARITY`` of their tokens are equal, place by place; what links
    connect is one template. More documents add links and never take one away. Lines that share a stretch are first
    held against one of them, which settles any number of lines of one template; only where one of them differs
    from it too much are all lines of that stretch compared.
    """
    whole = materialize(_with_tokens(rows, seen).where(_allowed(F.size("tokens")) > 0), "whole")
    keyed = whole.select("full", F.explode(_keys()).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("full").alias("one"), F.max("full").alias("top")).where("one <> top")
    keyed = materialize(keyed.join(shared.select("key", "one"), "key"), "keys")
    tokens = whole.select("full", "tokens")
    other = tokens.select(F.col("full").alias("one"), F.col("tokens").alias("others"))
    differ = F.size(F.filter(F.zip_with("tokens", "others", lambda a, b: a != b), lambda d: d))
    pairs = keyed.where("full <> one").select("full", "one").distinct().join(tokens, "full").join(other, "one")
    pairs = materialize(pairs.select("full", "one", (differ <= _allowed(F.size("tokens"))).alias("near")), "pairs")
    open_keys = keyed.join(pairs.where(~F.col("near")), ["full", "one"], "left_semi").select("key").distinct()
    groups = keyed.join(open_keys, "key", "left_semi").join(tokens, "full")
    groups = groups.groupBy("key").agg(F.collect_list("full").alias("fulls"), F.collect_list("tokens").alias("tokens"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                fulls = batch.column(0)[i].values.to_numpy()
                held = batch.column(1)[i].values.flatten().to_numpy().reshape(len(fulls), -1)
                n = held.shape[1]
                found = np.array(list(_linked(held, n - math.ceil(round(SIMILARITY * n, 6)))), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(fulls[found[:, k]], pa.int64()) for k in (0, 1)], names=["a", "b"])

    links = groups.select("fulls", "tokens").mapInArrow(compare, "a long, b long")
    links = links.unionByName(pairs.where("near").select(F.col("full").alias("a"), F.col("one").alias("b")))
    found = components(links).select(F.col("node").alias("full"), F.col("root").alias("template"))
    return found, [whole, keyed, pairs]


def recurring_lines(rows: DataFrame, lines: DataFrame, similar: bool = False) -> tuple[DataFrame, DataFrame]:
    """(full, lowest, first): lines of templates in several documents, with the first document's id and the lowest uid.

    ``lines`` are those of the texts of ``rows``. The second frame is the table the first one reads. With ``similar``
    templates are what links of similar lines connect.
    """
    seen = lines.groupBy("leaf", "full").agg(
        F.min("uid").alias("low"), F.max("uid").alias("high"), F.min("id").alias("first")
    )
    seen = materialize(seen, "seen")
    if similar:
        template, places = _similar(rows, seen)
    else:
        template, place = _generalised(rows, seen)
        places = [place]
    # A line of one document that is like no other is a template of its own, which cannot recur.
    named = seen.join(template, "full", "left").where("low <> high or template is not null")
    named = named.select("full", "low", "high", "first", F.coalesce("template", "full").alias("template"))
    named = materialize(named, "templates")
    for table in (seen, *places):  # all that follows reads the templates
        release(table)
    recurring = (
        named.groupBy("template")
        .agg(F.min("low").alias("lowest"), F.max("high").alias("highest"), F.min("first").alias("first"))
        .where("lowest <> highest")
    )
    return named.select("full", "template").join(recurring, "template").select("full", "lowest", "first"), named


def _dropped(rows: DataFrame, similar: bool) -> tuple[DataFrame, list[DataFrame]]:
    """(of, dropped): numbers of the lines that the document with uid ``of`` loses; and the tables this reads."""
    stored = _lines(rows)
    lines = _one_by_one(stored)
    recurring, named = recurring_lines(rows, lines, similar)
    dropped = (
        lines.select("uid", "id", "line", "full")
        .join(recurring, "full")
        .where(~stays_with(F.col("lowest"), F.col("first")))
        .groupBy(F.col("uid").alias("of"))
        .agg(F.collect_set("line").alias("dropped"))
    )
    return dropped, [stored, named]


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False, similar: bool = False
) -> DataFrame:
    """Per row: id, n_lines, n_dropped, kept, text without the dropped lines; with ``keep_rows`` also the row itself.

    ``kept`` is false where nothing but white space is left: whatever a document holds alone or as the first stays.
    Documents are told apart by id and text: an exact repetition of a row is the same document, and each repetition is
    treated alike. Rows with one id and different texts are different documents, of which all with the lowest id keep
    a line. A null id is never the lowest; if all documents of a template lack an id, the one with the lowest hash
    keeps it. Lines with fewer than ``LEAST_TOKENS`` tokens stay, as does a line repeated in one document only. A null
    text stays null, with no lines; an empty text has one empty line. An empty table gives no rows. With
    ``similar`` a token is no constant because another document has it, but lines are one template if enough of their
    tokens are equal, directly or by further lines.
    """
    carried = ("row", "id") if keep_rows else ("id",)
    rows = docs.select(whole_row(docs), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("id", "text"))
    dropped, _ = _dropped(rows, similar)
    joined = rows.select(*carried, "text", "uid").join(dropped, F.col("uid") == F.col("of"), "left")
    left = passages.without_lines(F.col("text"), F.col("dropped"))
    n_lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    return joined.select(
        *carried,
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNotNull(), left.rlike(r"\S")).otherwise(True).alias("kept"),
        left.alias("text"),
    )


def dedup_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row (all columns but the text), id, n_lines, n_dropped, n_cut, kept, text.

    First the lines go that ``dedup_lines`` drops with ``similar``, then from what is left the passages that
    ``passages.drop_passages`` finds, also those inside longer lines; ``n_cut`` counts the words of these. A document
    whose last words are cut is not kept.

    Texts are read again in each step rather than written without their lines: what a document loses are two lists of
    numbers, which meet the texts once at the end.
    """
    others = docs.drop(text_col)
    row = whole_row(others) if others.columns else F.lit(None).alias("row")
    rows = docs.select(row, F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("id", "text"))
    found, scratch = _dropped(rows, similar=True)
    dropped = materialize(found, "dropped")
    for table in scratch:
        release(table)
    starts = materialize(passages.passage_starts(rows, dropped), "starts")
    found = passages.beside(rows, materialize(dropped.join(starts, "of", "full"), "lost"))
    for table in (dropped, starts):
        release(table)
    found = found.select("row", "id", "text", "dropped", "starts")
    added = "n_lines long, n_dropped long, n_cut long, kept boolean, text string"
    schema = T.StructType([found.schema["row"], found.schema["id"], *T.StructType.fromDDL(added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 2 * PART):
                made = [_left(*one) for one in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)))]
                columns = [pa.array(own, kind) for own, kind in zip(zip(*made), _LEFT)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=schema.names)
        give_back()

    return found.mapInArrow(run, schema)


_LEFT = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
#: What the regular expressions of Spark take for something but white space.
_SOLID = re.compile(r"\S", re.ASCII)


def _left(
    text: str | None, dropped: list[int] | None, starts: list[int] | None
) -> tuple[int, int, int, bool, str | None]:
    """Lines, dropped lines, cut words, whether anything is left, and the text without these lines and passages."""
    if text is None:
        return 0, 0, 0, True, None
    n_lines, n_cut, kept = text.count("\n") + 1, 0, True
    if dropped:
        gone = set(dropped)
        text = "\n".join([line for k, line in enumerate(text.split("\n")) if k not in gone])
        kept = bool(_SOLID.search(text))
    if starts:
        text, n_cut = passages.cut(text, starts)
        kept = kept and bool(_SOLID.search(text))
    return n_lines, len(dropped or ()), n_cut, kept, text
