"""Benchmark passages in training text, found with a positional inverted index.

The index is a table of postings: for each block of documents and each term, the sorted places of the term in the
block. Places count words through the whole block, with a gap between documents, so a phrase can never run over the
end of one. A query reads the postings of its own terms only, takes the places of its rarest term in a block and
intersects them, shifted by their offsets, with those of the other terms. No block is larger than ``BLOCK`` bytes of
text plus one document, whatever the corpus holds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.common import give_back, ids_and_texts, slices, whole_row
from tablejobs.storage import materialize

#: Bytes of text after which a block of documents ends.
BLOCK = 8_000_000
#: Places left free between two documents; a query and its slop must be shorter.
GAP = 256
#: Words of benchmark text that are matched at once. A larger benchmark takes several passes over the index.
QUERY_WORDS = 200_000

_TERM_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Words: runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _unpacked(data: bytes) -> np.ndarray:
    """Places from their differences, low halves first: high halves are nearly all zero and compress away."""
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
    return np.cumsum(low + (high << 16))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings of every word of every text: block, term, places. One row per block has a null term and its documents.

    The place of a posting is that of the word in its block. The row of documents holds ids (as text), first places
    and word counts. A block is what one task reads in a row, up to ``BLOCK`` bytes.
    """
    source = ids_and_texts(docs, id_col, text_col).select(F.col("id").cast("string").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, 1, BLOCK):
                yield from block(f"{task}-{number}", part.column(0).to_pylist(), part.column(1).to_pylist())
                number += 1
        give_back()

    def block(name: str, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        words, firsts, counts, place = [], [], [], 0
        for text in texts:
            own = terms(text)
            if own:
                words.append(pa.array(own, pa.binary()))  # a Python object for every word of a block takes far more
            firsts.append(place)
            counts.append(len(own))
            place += len(own) + GAP
        table = json.dumps([ids, firsts, counts]).encode()
        yield _rows(name, [None], [table])
        if not words:
            return
        coded = pa.concat_arrays(words).dictionary_encode()
        words.clear()
        codes = coded.indices.to_numpy()
        counted = np.array(counts)
        places = np.arange(len(codes)) + np.repeat(np.arange(len(counted)) * GAP, counted)
        order = np.argsort(codes, kind="stable")
        places = places[order]
        del order
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        steps = np.diff(places, prepend=0)
        starts = np.concatenate([[0], ends[:-1]])
        steps[starts] = places[starts]
        low, high = (steps & 0xFFFF).astype("<u2").tobytes(), (steps >> 16).astype("<u2").tobytes()
        del places, steps
        spans = zip((2 * starts).tolist(), (2 * ends).tolist())
        found = coded.dictionary.to_pylist()
        packed = [low[a:b] + high[a:b] for a, b in spans]
        for i in range(0, len(found), 50_000):
            yield _rows(name, found[i : i + 50_000], packed[i : i + 50_000])

    def _rows(name: str, found: list, packed: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(found)), pa.array(found, pa.binary()), pa.array(packed, pa.binary())],
            names=["block", "term", "places"],
        )

    return materialize(source.mapInArrow(run, "block string, term binary, places binary"), "postings")


def phrases(items: list[tuple[str, list[bytes]]], width: int) -> list[tuple[str, list[bytes]]]:
    """Every run of ``width`` words of an item; an item with fewer words, but not none, is one phrase."""
    return [
        (key, words[i : i + width])
        for key, words in items
        if words
        for i in range(max(1, len(words) - width + 1))
    ]


def _exact(phrase: list[bytes], postings: dict[bytes, np.ndarray]) -> np.ndarray:
    """First places of a phrase: the rarest term's places, cut down term by term."""
    offsets = sorted(range(len(phrase)), key=lambda i: len(postings[phrase[i]]))
    starts = postings[phrase[offsets[0]]] - offsets[0]
    for i in offsets[1:]:
        if not len(starts):
            break
        places = postings[phrase[i]]
        at = np.searchsorted(places, starts + i)
        starts = starts[(at < len(places)) & (places[np.minimum(at, len(places) - 1)] == starts + i)]
    return starts


def _near(phrase: list[bytes], postings: dict[bytes, np.ndarray], reach: int) -> np.ndarray:
    """Places of the rarest term with every other term, in any order, at most ``reach`` places away."""
    words = sorted(set(phrase), key=lambda word: len(postings[word]))
    centre = postings[words[0]]
    for word in words[1:]:
        if not len(centre):
            break
        places = postings[word]
        at = np.searchsorted(places, centre - reach)
        centre = centre[(at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= centre + reach)]
    return centre


def _search(rows: list[tuple], queries: list[tuple[str, list[bytes]]], slop: int):
    """Per document of a block: id, words, hit words, spans of hits, items, items only near."""
    ids, firsts, counts = json.loads(next(places for term, places in rows if term is None))
    firsts = np.array(firsts)
    postings = {bytes(term): _unpacked(places) for term, places in rows if term is not None}
    total = int(firsts[-1] + counts[-1]) if len(counts) else 0
    edge = np.zeros(total + 1, np.int64)
    exact: list[set] = [set() for _ in ids]
    near: list[set] = [set() for _ in ids]
    for key, phrase in queries:
        if not all(word in postings for word in phrase):
            continue
        starts = _exact(phrase, postings)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + len(phrase), -1)
        for doc in np.unique(np.searchsorted(firsts, starts, "right") - 1).tolist():
            exact[doc].add(key) if key is not None else None
        for doc in np.unique(np.searchsorted(firsts, _near(phrase, postings, len(phrase) + slop), "right") - 1).tolist():
            near[doc].add(key) if key is not None else None
    hit = np.cumsum(edge)[:total] > 0
    for i, (key, first, count) in enumerate(zip(ids, firsts.tolist(), counts)):
        own = np.flatnonzero(np.diff(hit[first : first + count].astype(np.int8), prepend=0, append=0))
        spans = own.reshape(-1, 2)
        yield key, count, spans.tolist(), sorted(exact[i]), sorted(near[i] - exact[i])


def _query_blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> Iterator[list]:
    """The benchmark's phrases, in lists of at most ``QUERY_WORDS`` words of text or one item."""
    held, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for key, text in rows.toLocalIterator():
        words = terms(text)
        if not words:
            continue
        if held and size + len(words) > QUERY_WORDS:
            yield phrases(held, width)
            held, size = [], 0
        held.append((key, words))
        size += len(words)
    yield phrases(held, width)


RESULT = (
    "id string, n_words long, spans array<struct<first:int,end:int>>, items array<string>, near_items array<string>"
)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    slop: int = 5,
) -> DataFrame:
    """Per row of ``docs``: id as text, n_words, spans, items, near_items.

    ``spans`` are the runs of words (first, one behind the last) inside an occurrence of a phrase of ``width``
    consecutive words of an item; ``items`` are the ids, as text and sorted, of items with an occurring phrase, and
    ``near_items`` those of which only all words of a phrase occur within ``width + slop`` words of the rarest one.

    Null and empty texts have no words and no hits; a null id stays null, repeated rows give repeated rows. An item
    without words matches nothing; one without id gives spans like others but is listed nowhere; items with the same id
    count as one. An empty ``docs`` gives no rows, an
    empty ``benchmark`` no hits. The benchmark is matched in blocks of ``QUERY_WORDS`` words, each a pass over the
    postings of its own words. Further columns are not read.
    """
    if width + slop >= GAP:
        raise ValueError(f"width and slop together must stay below {GAP}")
    index = build_index(docs, id_col, text_col)
    found = None
    for queries in _query_blocks(benchmark, item_col, item_text_col, width):
        part = _matched(index, queries, slop)
        found = part if found is None else _merged(found, part)
    return found


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no phrase of the benchmark. Null and empty texts stay.

    Rows are told apart by a hash of their text, which spreads evenly: equal texts share their verdict.
    """
    key = F.concat_ws(":", F.xxhash64(text_col).cast("string"), F.xxhash64(F.reverse(text_col), F.length(text_col)))
    rows = docs.select(whole_row(docs), key.alias("key"))
    texts = docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text"))
    found = find_passages(texts, benchmark, "key", "text", **options)
    dirty = found.where(F.size("spans") > 0).select(F.col("id").alias("dirty")).distinct()
    return rows.join(dirty, F.col("key") == F.col("dirty"), "left_anti").select("row.*")


def _matched(index: DataFrame, queries: list, slop: int) -> DataFrame:
    spark = index.sparkSession
    wanted = sorted({word for _, phrase in queries for word in phrase})
    names = spark.createDataFrame(pa.table({"term": pa.array(wanted, pa.binary())}).to_pandas(), "term binary")
    # At most QUERY_WORDS words: small enough for every task, and the index need not be shuffled to meet them.
    needed = index.join(F.broadcast(names), "term", "left_semi").unionByName(index.where("term is null"))

    def search(key: tuple, table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("term").to_pylist(), table.column("places").to_pylist()))
        columns = list(zip(*_search(rows, queries, slop))) or [()] * 5
        spans = [[{"first": a, "end": b} for a, b in doc] for doc in columns[2]]
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return pa.table({
            "id": pa.array(columns[0], pa.string()),
            "n_words": pa.array(columns[1], pa.int64()),
            "spans": pa.array(spans, span),
            "items": pa.array(columns[3], pa.list_(pa.string())),
            "near_items": pa.array(columns[4], pa.list_(pa.string())),
            "block": pa.array([key[0].as_py()] * len(columns[0]), pa.string()),
            "place": pa.array(range(len(columns[0])), pa.int32()),
        })

    return needed.groupBy("block").applyInArrow(search, RESULT + ", block string, place int")


def _merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Results of two lists of queries for the same documents, known by their block and place in it."""
    right = right.select(*[F.col(name).alias(f"more_{name}") for name in right.columns])
    both = left.join(
        right, (F.col("block") == F.col("more_block")) & (F.col("place") == F.col("more_place"))
    )
    items = F.array_sort(F.array_union("items", "more_items"))
    return materialize(
        both.select(
            "id",
            "n_words",
            _united(F.concat("spans", "more_spans")).alias("spans"),
            items.alias("items"),
            F.array_sort(F.array_except(F.array_union("near_items", "more_near_items"), items)).alias("near_items"),
            "block",
            "place",
        ),
        "passages",
    )


def _united(spans):
    """Spans without overlaps: a span that begins inside the one before it continues it."""
    empty = F.expr("cast(array() as array<struct<first:int,end:int>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(F.size(done) == 0, F.array(span)).otherwise(
            F.when(
                span["first"] <= last["end"],
                F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown)),
            ).otherwise(F.concat(done, F.array(span)))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def hit_words(spans):
    """Words inside the spans of a row."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["first"])
