"""Packs documents into training sequences of a fixed length by linear grouping.

Documents are tokenised and cut into pieces of at most one sequence. Pieces are dealt to shards of bounded size, each
packed on its own: large lengths are rounded up to the longest of their group, with groups of equal cardinality, so
that only a few sizes remain; configurations of these sizes that fill a sequence best are chosen and used as often as
the groups allow; actual pieces then take the places of the rounded ones, and small pieces go where they fit best.
A shard leaves at most about one sequence part-filled beyond what its own pieces force, which is nothing against the
thousands it fills.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm.common import give_back, ids_and_texts, slices
from tablejobs.llm.word_ids import Runs, Usual, WordCache, joined_ids
from tablejobs.storage import materialize, session_setting

#: Pieces a shard packs.
SHARD = 50_000
#: Sizes the large lengths of a shard are rounded to.
GROUPS = 96
#: Pieces up to this share of a sequence are small.
SMALL = 1 / 8
#: Bytes of text a worker encodes at once; arrays over their words and ids take some twenty times as much.
PART = 500_000
#: Words and runs a worker remembers the ids of during a task, and characters of them: fewer than where tokens are all a
#: job makes.
REMEMBERED, REMEMBERED_RUNS = (200_000, 12_000_000), (100_000, 4_000_000)
#: Texts sent to a worker at once, on both sides of which a batch takes memory.
BATCH = 2_000
#: Line breaks and tabs end a word as spaces do.
BLANKS = bytes.maketrans(b"\n\t\r", b"   ")


class WordEncoder:
    """Ids of texts for a tokenizer that never merges over white space, word by word, remembering words.

    ``path`` names a vocabulary file of the ``tokenizers`` library whose normalisation and splitting treat every run
    between white space alone. Words of Latin letters, with marks behind or without, go straight to its merges, all others through the whole tokenizer; the results are the tokenizer's own.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.runs = Runs(described["model"], REMEMBERED_RUNS)
        self.words = WordCache(self._words, REMEMBERED)
        # Letters with one case mapping and one normal form, which normalisation leaves as they are but for the case.
        self.usual = Usual("A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", [token["content"] for token in described["added_tokens"]])

    def _words(self, words: list[str]) -> list[bytes]:
        places, stems, marks, others = self.usual(words)
        stems = pc.utf8_lower(stems).to_numpy(zero_copy_only=False).tolist()
        known = self.runs.learn({*stems, *(own for _, own in marks)})
        ids = list(map(known.__getitem__, stems))
        for i, own in marks:
            ids[i] += known[own]
        out = [b""] * len(words)
        for i, one in zip(places, ids):
            out[i] = one
        for i in others:
            out[i] = array("I", self.tokenizer.encode(words[i], add_special_tokens=False).ids).tobytes()
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned 32-bit numbers."""
        return joined_ids([text.encode().translate(BLANKS) for text in texts], self.words)

    def rest(self) -> None:
        """Give back what only speeds up the next texts: Spark may use a worker for other work."""
        self.words.forget()
        self.runs.known, self.runs.chars = {}, 0
        give_back()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def token_pieces(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 1
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32. A document's ids end with ``end_id``; only longer ones are cut."""
    source = ids_and_texts(docs, id_col, text_col)
    schema = T.StructType([source.schema["id"], *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long")])
    end = np.array([end_id], "<u4").tobytes()
    most = PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, most):
                row, piece, size, crc = [], [], [], []
                for i, ids in enumerate(encode([text or "" for text in part.column(1).to_pylist()])):
                    ids += end
                    for k in range(0, len(ids), 4 * length):
                        own = ids[k : k + 4 * length]
                        row.append(i)
                        piece.append(k // (4 * length))
                        size.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int32())),
                        pa.array(piece, pa.int32()),
                        pa.array([p * length for p in piece], pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=schema.names,
                )
        encode.rest()

    return source.mapInArrow(run, schema)


def configuration(sizes: list[int], counts: list[int], capacity: int) -> tuple[dict[int, int], int]:
    """A way to fill a sequence with the sizes left, and how often the counts allow it.

    It begins with the largest size left and fills the rest by a knapsack over the sizes left, so that the least room
    stays free. Using it as often as possible empties a size, so few configurations serve all pieces.
    """
    left = {i: n for i, n in enumerate(counts) if n}
    first = max(left, key=lambda i: sizes[i])
    room = capacity - sizes[first]
    came: dict[int, tuple[int, int]] = {0: (-1, 0)}  # filled length: the size that was put in last, and what was before
    for i in sorted(left, key=lambda i: -sizes[i]):
        spare = left[i] - (i == first)
        for filled in list(came):
            total, copies = filled, 0
            while copies < spare and total + sizes[i] <= room and total + sizes[i] not in came:
                came[total + sizes[i]] = (i, total)
                total, copies = total + sizes[i], copies + 1
        if room in came:
            break
    chosen = {first: 1}
    at = max(came)
    while at:
        i, at = came[at]
        chosen[i] = min(chosen.get(i, 0) + 1, left[i])
    return chosen, max(1, min(left[i] // copies for i, copies in chosen.items()))


def pack(lengths: np.ndarray, capacity: int, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every length (1 to ``capacity``)."""
    count = len(lengths)
    sequence = np.full(count, -1, np.int64)
    offset = np.zeros(count, np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = order[lengths[order] == capacity]
    sequence[full] = np.arange(len(full))
    used: list[int] = [capacity] * len(full)
    order = order[len(full) :]
    is_large = lengths[order] > capacity * SMALL
    large, small = order[is_large], order[~is_large].tolist()

    # Pieces still to place, by group and by length; a bit for each length that occurs.
    parts = [part for part in np.array_split(large, min(groups, len(large))) if len(part)] if len(large) else []
    sizes = [int(lengths[part[0]]) for part in parts]  # descending: the first of a group is its longest
    group = {int(one): i for i, part in enumerate(parts) for one in part}
    waiting = [part.tolist() for part in parts]
    counts = [len(part) for part in parts]
    by_length: dict[int, list[int]] = defaultdict(list)
    for one in large.tolist():
        by_length[int(lengths[one])].append(one)
    present = sum(1 << length for length in by_length)
    placed = np.zeros(count, bool)

    def put(one: int, number: int, filled: int) -> int:
        nonlocal present
        length = int(lengths[one])
        sequence[one], offset[one], placed[one] = number, filled, True
        counts[group[one]] -= 1
        same = by_length[length]
        while same and placed[same[-1]]:
            same.pop()
        if not same:
            present &= ~(1 << length)
        return filled + length

    def longest(room: int) -> int | None:
        """The longest piece left that fits."""
        nonlocal present
        while fitting := present & ((1 << (room + 1)) - 1):
            length = fitting.bit_length() - 1
            same = by_length[length]
            while same and placed[same[-1]]:
                same.pop()
            if same:
                return same[-1]
            present &= ~(1 << length)
        return None

    while any(counts):
        chosen, uses = configuration(sizes, counts, capacity)
        slots = sorted((i for i, copies in chosen.items() for _ in range(copies)), key=lambda i: -sizes[i])
        for _ in range(uses):
            filled, number = 0, len(used)
            for at, i in enumerate(slots):
                if at and at == len(slots) - 1:
                    break  # the room left by rounding decides who comes last
                while waiting[i] and placed[waiting[i][-1]]:
                    waiting[i].pop()
                if not waiting[i]:
                    break
                filled = put(waiting[i].pop(), number, filled)
            if not filled:
                break
            while (one := longest(capacity - filled)) is not None:
                filled = put(one, number, filled)
            used.append(filled)

    # best fit for the small ones: sequences by the room they have left, and a bit for each room that occurs
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for number, filled in enumerate(used):
        if filled < capacity:
            by_room[capacity - filled].append(number)
            rooms |= 1 << (capacity - filled)
    for one in small:
        length = int(lengths[one])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            number, room = len(used), capacity
            used.append(0)
        sequence[one], offset[one] = number, used[number]
        used[number] += length
        room -= length
        if room:
            by_room[room].append(number)
            rooms |= 1 << room
    return sequence, offset


def pack_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 1
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``start`` is the piece's first id within its document, ``offset`` its place in the sequence. Null and empty texts
    are one piece that holds ``end_id`` only. Repeated rows and rows without id are packed like others; an empty table
    gives no rows. Further columns are not read. Pieces are written to the shared folder before they are dealt, so a
    lost executor cannot change what another task has packed.
    """
    with session_setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
        pieces = materialize(token_pieces(docs, vocabulary, id_col, text_col, length, end_id), "pieces")
    shards = max(1, -(-pieces.count() // SHARD))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(shards)))
    # A document repeated very often would make one shard large: a second key spreads equal rows.
    dealt = dealt.withColumn("shard", F.pmod(F.col("shard") + F.monotonically_increasing_id(), F.lit(shards)))
    schema = T.StructType(pieces.schema.fields).add("sequence_id", "long").add("offset", "long")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        frame = frame.drop(columns="shard").sort_values(["length", "id", "piece"], kind="stable")
        sequence, offset = pack(frame["length"].to_numpy(np.int64), length)
        return frame.assign(sequence_id=(shard << 40) + sequence, offset=offset)

    return dealt.groupBy("shard").applyInPandas(one, schema)
