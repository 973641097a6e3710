"""Token ids in compressed binary files: canonical Huffman codes of limited length from global counts.

A token file set is a folder with

* ``codes``: symbol and code length of every id that occurs. Canonical codes follow from the lengths alone: shorter
  codes first, equal lengths by symbol;
* ``segments``: rows in ascending order of documents, each one a binary image of whole documents of about
  ``SEGMENT`` ids, beside the ids, first places and sizes of its documents;
* ``parts``: the place of each part's first id in the whole sequence.

An image is ``HUF1``, then little-endian: number of ids (64 bits), ids a block (32), and one checkpoint a block, the
bit at which it begins (64 each); then the bits, most significant first. Every block can be decoded by itself, so a
reader jumps to any id, and all blocks of an image are decoded side by side, one table look-up for each id.

Texts are encoded once. Their ids pass one range shuffle by document, in two bytes each where the vocabulary allows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm.common import ids_and_texts, slices
from tablejobs.llm.word_ids import WHOLE, Runs, Usual, WordCache, joined_ids
from tablejobs.storage import materialize, release

#: Longest code in bits; 2 ** LIMIT must not be below the number of different ids.
LIMIT = 18
#: Ids a block of an image holds.
BLOCK = 512
#: Ids after which an image is closed, at the end of a document.
SEGMENT = 1_000_000
#: Ids a part of the sequence holds, at most about; small inputs are cut finer for the sake of all cores.
PART = 64_000_000
# Fixed value: how byte-level tokenizers split text before their merges, for the Latin blocks up to U+024F alone.
LETTER, NUMBER, BLANK = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d\x20\x85\xa0"
SPLIT = (
    f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+"
    f"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)

#: Letters of usual words.
USUAL = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"

MAGIC = b"HUF1"
HEADER = struct.Struct("<4sQI")


class ByteEncoder:
    """Ids of texts for a byte-level tokenizer of the ``tokenizers`` library that splits no run of other characters
    from the one space in front of it: the ids of a text are those of its words, each with the space before it.

    Words, and the runs of letters in them, are remembered; new runs go straight to the library's merges. Texts with
    runs of white space that include spaces, with added tokens, or with characters outside the Latin blocks are encoded
    whole by the library. The results are the tokenizer's own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, splitter = described["model"], described["pre_tokenizer"] or {}
        self.by_word = (
            described["normalizer"] is None
            and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
            and (splitter.get("type"), splitter.get("add_prefix_space"), splitter.get("use_regex")) == ("ByteLevel", False, True)
        )
        self.added = [token["content"] for token in described["added_tokens"]]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.runs = Runs(model) if self.by_word else None
        self.split = re.compile(SPLIT).findall
        self.latin = re.compile("[\x00-\u024f]*").fullmatch
        self.usual = Usual(USUAL, self.added)
        self.words = WordCache(self._words)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words and the space before them; ``WHOLE`` if a word's text has to be encoded whole."""
        if not words:
            return []
        places, stems, marks, others = self.usual(words)
        runs = pc.binary_join_element_wise(pa.scalar(" "), stems, pa.scalar("")).to_numpy(zero_copy_only=False).tolist()
        cut: list[tuple[str, ...]] = []
        for word in (words[i] for i in others):
            fine = word and not word[0].isspace() and self.latin(word) and not any(a in word for a in self.added)
            cut.append(tuple(self.split(" " + word)) if fine else ())
        known = self.runs.learn({*runs, *(own for _, own in marks), *(run for own in cut for run in own)})
        ids = list(map(known.__getitem__, runs))
        for i, own in marks:
            ids[i] += known[own]
        out: list[bytes] = [WHOLE] * len(words)
        for i, one in zip(places, ids):
            out[i] = one
        for i, own in zip(others, cut):
            if own:
                out[i] = b"".join([known[run] for run in own])
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            return list(map(self._whole, texts))
        cut = [text.partition(" ") for text in texts]
        rests = joined_ids([rest.encode() for _, _, rest in cut], self.words)
        # Nothing or other characters than a space stand before the first word of a text.
        alone = [
            bool(self.latin(first)) and not (space and first.isspace()) and not any(a in first for a in self.added)
            for first, space, _ in cut
        ]
        firsts = [tuple(self.split(first)) if fine else () for (first, _, _), fine in zip(cut, alone)]
        known = self.runs.learn({run for runs in firsts for run in runs})
        return [
            self._whole(text)
            if not fine or (space and ids is None)
            else b"".join([known[run] for run in runs]) + (ids if space else b"")
            for text, (_, space, _), fine, runs, ids in zip(texts, cut, alone, firsts, rests)
        ]


_encoders: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


# --- codes ---------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code without codes longer than ``limit`` (package-merge); all counts are above 0."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit into codes of {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        merged = np.argsort(both, kind="stable")
        is_leaf.append(merged < n)
        level = both[merged]
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):  # the cheapest ones: each leaf among them is one bit more
        used = int(flags[:wanted].sum())
        lengths[:used] += 1
        wanted = 2 * (wanted - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of symbols with given lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((symbols, lengths))
        self.symbols, self.sizes = np.asarray(symbols, np.int64)[order], np.asarray(lengths, np.int64)[order]
        self.longest = int(self.sizes[-1]) if len(order) else 1
        # Counted in units of the longest code, a code's first value is the sum of all before it.
        spans = np.int64(1) << (self.longest - self.sizes)
        starts = np.cumsum(spans) - spans
        top = int(self.symbols.max()) + 1 if len(order) else 1
        self.value = np.zeros(top, np.uint64)
        self.length = np.zeros(top, np.int64)
        self.value[self.symbols] = (starts >> (self.longest - self.sizes)).astype(np.uint64)
        self.length[self.symbols] = self.sizes
        table = np.repeat((self.symbols << 5) | self.sizes, spans)
        self.table = np.zeros(1 << self.longest, np.int64)
        self.table[: len(table)] = table

    def image(self, ids: np.ndarray, block: int = BLOCK) -> bytes:
        """The binary image of ids."""
        sizes = self.length[ids]
        if not sizes.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(sizes)
        starts = ends - sizes
        marks = starts[::block].astype("<u8")
        words = np.zeros((int(ends[-1]) + 63) // 64 + 1 if len(ids) else 0, np.uint64)
        if len(ids):
            values, at, inside = self.value[ids], starts >> 6, starts & 63
            room = 64 - inside - sizes  # below zero: the code's last bits go into the next word
            kept = np.where(
                room >= 0, values << np.maximum(room, 0).astype(np.uint64), values >> np.maximum(-room, 0).astype(np.uint64)
            )
            # Every word but the last has a code that begins in it, so the parts of a word follow one another.
            begins = np.flatnonzero(np.diff(at, prepend=-1))
            words[at[begins]] = np.bitwise_or.reduceat(kept, begins)
            over = np.flatnonzero(room < 0)
            words[at[over] + 1] |= values[over] << (64 + room[over]).astype(np.uint64)
        bits = words.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8 if len(ids) else 0]
        return HEADER.pack(MAGIC, len(ids), block) + marks.tobytes() + bits

    def ids(self, image: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` ids of an image from ``first`` on; only the blocks that hold them are decoded."""
        magic, total, block = HEADER.unpack_from(image)
        if magic != MAGIC:
            raise ValueError("not an image of token ids")
        count = total - first if count is None else count
        if count <= 0:
            return np.zeros(0, np.int64)
        if first < 0 or first + count > total:
            raise ValueError(f"ids {first} to {first + count} of {total}")
        blocks = -(-total // block)
        marks = np.frombuffer(image, "<u8", blocks, HEADER.size).astype(np.int64)
        low, high = first // block, -(-(first + count) // block)
        at = marks[low:high].copy()
        begin, until = int(at[0]) // 8, int(marks[high]) // 8 + 1 if high < blocks else None
        data = HEADER.size + 8 * blocks
        raw = np.frombuffer(image[data + begin : None if until is None else data + until] + b"\0" * 4, np.uint8)
        at -= 8 * begin
        wide = raw.astype(np.uint32)
        # Four bytes from every byte on: a look-up reads one number wherever its code begins.
        peek = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
        out = np.empty((block, len(at)), np.int64)
        down, mask, last = 32 - self.longest, (1 << self.longest) - 1, len(peek) - 1
        for step in range(min(block, total)):
            window = peek[np.minimum(at >> 3, last)].astype(np.int64)
            found = self.table[(window >> (down - (at & 7))) & mask]
            out[step] = found >> 5
            at += found & 31
        return out.T.reshape(-1)[first - low * block :][:count]


# --- texts to ids --------------------------------------------------------------------------------------------------


def _narrow(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def token_rows(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0
) -> DataFrame:
    """Per document: id, check (crc32 of the ids as little-endian 32-bit numbers), n_tokens, ids (binary)."""
    source = ids_and_texts(docs, id_col, text_col)
    added = T.StructType.fromDDL("check long, n_tokens long, ids binary")
    schema = T.StructType([source.schema["id"], *added])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(vocabulary)
        narrow = _narrow(max(encode.size, end_id + 1))
        for batch in batches:
            for part in slices(batch, 1):
                checks, sizes, kept = [], [], []
                for ids in encode([text or "" for text in part.column(1).to_pylist()]):
                    ids += end
                    checks.append(zlib.crc32(ids))
                    sizes.append(len(ids) // 4)
                    kept.append(np.frombuffer(ids, "<u4").astype(narrow).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(checks, pa.int64()), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def token_counts(tokens: DataFrame, narrow: str) -> DataFrame:
    """How often each id occurs: counted in arrays by every task, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), narrow)
            own = np.bincount(ids, minlength=len(counts))
            own[: len(counts)] += counts
            counts = own
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], names=["symbol", "n"])

    counted = tokens.select("ids").mapInArrow(run, "symbol int, n long")
    return counted.groupBy("symbol").agg(F.sum("n").alias("n"))


# --- files ---------------------------------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    root: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    limit: int = LIMIT,
) -> None:
    """Encode all texts and write their ids in ascending order of documents.

    Null and empty texts are ``end_id`` alone. Rows without id come first; rows of one id follow one another by their
    ids' check sum and number, equal rows in any order. An empty table gives files without rows. Further columns are
    not read. At most one row per id of the vocabulary and one per part pass through the driver.
    """
    spark = docs.sparkSession
    rows = token_rows(docs, vocabulary, id_col, text_col, end_id)
    tokens = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")
    narrow = _narrow(max(byte_encoder(vocabulary).size, end_id + 1))
    counts = token_counts(tokens, narrow).toPandas()
    lengths = code_lengths(counts["n"].to_numpy(np.int64), limit)
    symbols = counts["symbol"].to_numpy(np.int64)
    codes = pa.table({"symbol": pa.array(symbols, pa.int32()), "length": pa.array(lengths, pa.int32())})
    spark.createDataFrame(codes.to_pandas(), "symbol int, length int").coalesce(1).write.parquet(f"{root}/codes")

    total = int(counts["n"].sum())
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-total // PART), min(cores, -(-total // SEGMENT)))
    keys = ["id", "check", "n_tokens", "row"]
    ordered = tokens.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    held = T.StructType().add("id", tokens.schema["id"].dataType).add("start", "long").add("n_tokens", "long")
    schema = T.StructType.fromDDL("part int, segment int, n_ids long, image binary").add("docs", T.ArrayType(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        code = Code(symbols, lengths)
        types = to_arrow_schema(schema)
        part, segment, before = TaskContext.get().partitionId(), 0, 0
        names, sizes, blobs, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(blobs), narrow)
            starts = before + np.cumsum(sizes) - sizes
            # One array of the segment's documents, built from columns: segments may hold very many short ones.
            rows = pa.StructArray.from_arrays(
                [pa.concat_arrays(names), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=held.names
            )
            whole = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            values = [part, segment, len(ids), code.image(ids)]
            arrays = [pa.array([v], types.field(i).type) for i, v in enumerate(values)]
            return pa.RecordBatch.from_arrays([*arrays, whole.cast(types.field("docs").type)], schema=types)

        for batch in batches:
            begin = 0
            for i, n in enumerate(batch.column(1).to_pylist()):
                sizes.append(n)
                size += n
                if size >= SEGMENT:
                    names.append(batch.column(0).slice(begin, i + 1 - begin))
                    blobs += batch.column(2).slice(begin, i + 1 - begin).to_pylist()
                    yield closed()
                    segment, before, begin = segment + 1, before + size, i + 1
                    names, sizes, blobs, size = [], [], [], 0
            if begin < batch.num_rows:
                names.append(batch.column(0).slice(begin))
                blobs += batch.column(2).slice(begin).to_pylist()
        if size:
            yield closed()

    ordered.select("id", "n_tokens", "ids").mapInArrow(run, schema).write.parquet(f"{root}/segments")
    release(tokens)
    written = spark.read.schema(schema).parquet(f"{root}/segments")
    sums = sorted(map(tuple, written.groupBy("part").agg(F.sum("n_ids")).collect()))
    firsts, before = [], 0
    for part, n in sums:
        firsts.append((part, before))
        before += n
    spark.createDataFrame(firsts, "part int, before long").coalesce(1).write.parquet(f"{root}/parts")


def read_token_files(spark: SparkSession, root: str, with_ids: bool = True) -> DataFrame:
    """Per document, from the files alone: id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ``ids`` are little-endian unsigned 32-bit numbers, the end id included.
    """
    found = spark.read.parquet(f"{root}/codes").toPandas()
    symbols, lengths = found["symbol"].to_numpy(np.int64), found["length"].to_numpy(np.int64)
    segments = spark.read.parquet(f"{root}/segments")
    kind = segments.schema["docs"].dataType.elementType["id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("id", kind)])
    schema = T.StructType([*schema, *T.StructType.fromDDL("start long, n_tokens long, ids_crc32 long")])
    if with_ids:
        schema = T.StructType([*schema, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = None
        for batch in batches:
            code = code or Code(symbols, lengths)
            for i in range(batch.num_rows):
                docs = batch.column(2).slice(i, 1).flatten()
                names, starts, sizes = docs.flatten()
                ids = code.ids(batch.column(1)[i].as_py()).astype("<u4")
                ends = np.cumsum(sizes.to_numpy())
                own = [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                columns = [pa.array(np.full(len(docs), batch.column(0)[i].as_py()), pa.int32()), names, starts, sizes]
                columns.append(pa.array(map(zlib.crc32, own), pa.int64()))
                if with_ids:
                    columns.append(pa.array(own, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    read = segments.select("part", "image", "docs").mapInArrow(run, schema)
    # One row per part of the files.
    parts = spark.read.parquet(f"{root}/parts").withColumnRenamed("part", "of_part")
    placed = read.join(parts, F.col("part") == F.col("of_part"))
    return placed.withColumn("start", F.col("start") + F.col("before")).drop("part", "of_part", "before")


def token_range(spark: SparkSession, root: str, first: int, count: int) -> np.ndarray:
    """``count`` ids of the whole sequence from ``first`` on; reads only segments, and blocks of them, that hold some.

    The range goes to the caller's process: it names the size itself.
    """
    found = spark.read.parquet(f"{root}/codes").toPandas()
    code = Code(found["symbol"].to_numpy(np.int64), found["length"].to_numpy(np.int64))
    parts = spark.read.parquet(f"{root}/parts").withColumnRenamed("part", "of_part")
    segments = spark.read.parquet(f"{root}/segments").join(parts, F.col("part") == F.col("of_part"))
    begin = F.col("before") + F.col("docs")[0]["start"]
    hit = segments.select(begin.alias("begin"), "n_ids", "image")
    hit = hit.where((F.col("begin") < first + count) & (F.col("begin") + F.col("n_ids") > first))
    out = []
    for row in hit.orderBy("begin").toLocalIterator():
        low, high = max(first, row.begin), min(first + count, row.begin + row.n_ids)
        out.append(code.ids(bytes(row.image), low - row.begin, high - low))
    return np.concatenate(out) if out else np.zeros(0, np.int64)
