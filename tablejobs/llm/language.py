"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Four-character sequences are counted over the whole training corpus, in Arrow batches first and then by Spark. Lower
orders follow from the counts: how many different characters come before a sequence. A model is a set of arrays sorted
by the sequence, packed into one 64-bit number, so that a look-up is a binary search over a batch. A text belongs to
the language whose model gives the lowest cross-entropy per character. Texts whose cross-entropy lies far above what
training texts of that language and length have are rejected.

All languages get a model, and a model holds every sequence of its language. Languages are dealt to groups by the size
of their models; a text is held against one group after the other, each sent to the tasks by itself, and carries the
best language so far along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm.common import give_back, slices, whole_row
from tablejobs.storage import materialize

#: Characters in a sequence.
ORDER = 4
#: Sequences a group of models holds, or one language: 16 bytes each and 4 for every language.
GROUP_SIZE = 1_000_000
#: Bytes of text a worker takes apart at once; arrays over their sequences take some fifty times as much.
PART = 500_000
#: Sequences and their numbers, 16 bytes each, that a worker counts before it hands them on.
HELD = 1_000_000
#: Languages up to which the limits of rejection, 64 rows each at most, are sent to every task.
BROADCAST_LANGUAGES = 2_000
#: Standard deviations above the mean cross-entropy of training texts from which a text is rejected.
REJECT = 8.0

_SPACE = 32


def _alphabet() -> np.ndarray:
    """Each character of the basic plane as a model sees it: letters in lower case, all else a space."""
    table = np.full(1 << 16, _SPACE, np.uint64)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 and ord(lower) < 1 << 16 else code
    return table


_table: list[np.ndarray] = []


def characters(text: str | None) -> np.ndarray:
    """The text as a model sees it, with one space around and between words; empty without letters.

    Letters beyond the basic plane are folded into its private area, so they count as letters but may collide.
    """
    if not text:
        return np.zeros(0, np.uint64)
    if not _table:
        _table.append(_alphabet())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    high = codes >= 1 << 16
    seen = _table[0][codes & 0xFFFF]
    if high.any():
        for i in np.flatnonzero(high).tolist():
            seen[i] = 0xE000 + (int(codes[i]) & 0x17FF) if chr(codes[i]).isalpha() else _SPACE
    space = seen == _SPACE
    kept = seen[~(space & np.concatenate([[True], space[:-1]]))]
    if not len(kept):
        return kept
    return np.concatenate([[_SPACE], kept, [_SPACE] if kept[-1] != _SPACE else []]).astype(np.uint64)


def sequences(seen: np.ndarray) -> np.ndarray:
    """Every four characters in a row, packed into one number, the first one highest."""
    if len(seen) < ORDER:
        return np.zeros(0, np.uint64)
    sixteen = np.uint64(16)
    packed = seen[: 1 - ORDER]
    for i in range(1, ORDER):
        packed = (packed << sixteen) | seen[i : len(seen) - ORDER + 1 + i]
    return packed


def count_sequences(rows: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n) over all rows with a language: ``gram`` is a packed sequence, as a signed long."""
    source = rows.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return grams, np.bincount(place, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

        def size():
            return sum(len(p[0]) for parts in held.values() for p in parts)

        def out():
            for name, parts in held.items():
                grams, counts = merged(parts)
                for i in range(0, len(grams), 100_000):
                    own = grams[i : i + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own)), pa.array(own), pa.array(counts[i : i + 100_000])],
                        names=["lang", "gram", "n"],
                    )
            held.clear()

        for batch in batches:
            for part in slices(batch, 1, PART):
                own: dict[str, list[np.ndarray]] = {}
                for name, one in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own.setdefault(name, []).append(sequences(characters(one)))
                for name, found in own.items():
                    parts = held.setdefault(name, [])
                    parts.append(np.unique(np.concatenate(found), return_counts=True))
                    if len(parts) >= 8:
                        parts[:] = [merged(parts)]
                if size() > HELD:
                    held.update({name: [merged(parts)] for name, parts in held.items()})
                    if size() > HELD // 2:
                        yield from out()
        yield from out()

    counted = source.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class KneserNey:
    """Interpolated Kneser-Ney over packed sequences of one language."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        keys, values = grams[order], counts[order].astype(np.float64)
        self.levels = []
        for size in range(ORDER, 0, -1):
            ones, twos = int((values == 1).sum()), int((values == 2).sum())
            discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            context, place = np.unique(keys >> np.uint64(16), return_inverse=True)
            total = np.bincount(place, values, len(context))
            kinds = np.bincount(place, minlength=len(context))
            self.levels.append((keys, (values - discount) / total[place], context, discount * kinds / total))
            mask = np.uint64((1 << (16 * (size - 1))) - 1)
            keys, values = np.unique(keys & mask, return_counts=True)
            values = values.astype(np.float64)
        self.floor = 1.0 / 65_536

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of the last character after the others."""
        probability = np.full(len(grams), self.floor)
        for size in range(1, ORDER + 1):
            keys, own, contexts, spare = self.levels[ORDER - size]
            gram = grams & np.uint64((1 << (16 * size)) - 1) if size < 4 else grams
            at = np.minimum(np.searchsorted(contexts, gram >> np.uint64(16)), len(contexts) - 1)
            known = contexts[at] == gram >> np.uint64(16)
            probability = np.where(known, spare[at] * probability, probability)
            at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            probability += np.where(keys[at] == gram, own[at], 0.0)
        return np.log(probability)


class Models:
    """Models of several languages over one sorted array of sequences, with a logarithm per language."""

    def __init__(self, names: list[str], grams: list[np.ndarray], counts: list[np.ndarray]):
        self.names = names
        self.single = [KneserNey(g, n) for g, n in zip(grams, counts)]
        self.keys = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.logs = np.stack([one(self.keys) for one in self.single], 1).astype(np.float32) if grams else None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sequences per text, and cross-entropy in bits per character for each language."""
        parts = [sequences(characters(text)) for text in texts]
        sizes = np.array([len(part) for part in parts], np.int64)
        sums = np.zeros((len(texts), len(self.names)))
        begin = 0
        while begin < len(parts):
            stop, held = begin, 0
            while stop < len(parts) and (held == 0 or held + sizes[stop] <= 200_000):
                held += int(sizes[stop])
                stop += 1
            filled = [i for i in range(begin, stop) if sizes[i]]
            if filled:
                grams = np.concatenate([parts[i] for i in filled])
                starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                for at in range(0, len(grams), 2_000_000):  # a single very long text
                    self._add(sums, filled, starts, grams[at : at + 2_000_000], at)
            begin = stop
        return sizes, sums / np.maximum(sizes, 1)[:, None] / -np.log(2)

    def _add(self, sums: np.ndarray, filled: list[int], starts: np.ndarray, grams: np.ndarray, at: int) -> None:
        place = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        logs = self.logs[place]
        missing = np.flatnonzero(self.keys[place] != grams)
        if len(missing):
            unseen, back = np.unique(grams[missing], return_inverse=True)
            logs[missing] = np.stack([one(unseen) for one in self.single], 1)[back]
        first = int(np.searchsorted(starts, at, "right")) - 1
        inside = starts[(starts > at) & (starts < at + len(grams))] - at
        totals = np.add.reduceat(logs.astype(np.float64), np.concatenate([[0], inside]).astype(np.int64), axis=0)
        for i, total in enumerate(totals):
            sums[filled[first + i]] += total


def fit(rows: DataFrame, lang: str, text: str, group_size: int = GROUP_SIZE) -> Iterator[Models]:
    """Models of all languages of ``rows``, in groups in the order of the alphabet; rows without language or text teach
    nothing.

    The driver holds one group at a time: ``group_size`` sequences, or those of one language.
    """
    counts = materialize(count_sequences(rows, lang, text), "sequences")
    groups: list[list[str]] = []
    held = group_size
    for name, size in sorted(map(tuple, counts.groupBy("lang").agg(F.count("*")).collect())):
        if held + size > group_size:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += size
    for names in groups:
        table = counts.where(F.col("lang").isin(names)).toArrow()
        lang_of = np.array(table.column("lang").to_pylist(), object)
        grams = table.column("gram").to_numpy().view(np.uint64)
        number = table.column("n").to_numpy()
        yield Models(names, [grams[lang_of == n] for n in names], [number[lang_of == n] for n in names])


def identify(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep_rows: bool = False,
    group_size: int = GROUP_SIZE,
) -> DataFrame:
    """Per row: id, learned, lang_pred, score, entropy, letters, rejected; with ``keep_rows`` also the row itself.

    Models are fitted on all rows for which ``learn`` holds and whose language is not null. ``score`` is the share of
    the best language in the probabilities of the text, taken at 64 characters at most. A text is rejected if its
    cross-entropy exceeds the mean of training texts of its language and length class by ``REJECT`` standard
    deviations. A null text and a text without letters is ``und``, with score 0, and rejected; so is every text when
    nothing can be learned. Ties go to the language first in the alphabet. A null id stays; repeated rows give
    repeated rows; an empty table gives none. Further columns are only carried along.
    """
    spark = docs.sparkSession
    flagged = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), learn.alias("learn")
    )
    groups, languages = [], 0
    for models in fit(flagged.where("learn"), "lang", "text", group_size):
        groups.append(spark.sparkContext.broadcast(models))
        languages += len(models.names)

    names = ("row", "id") if keep_rows else ("id",)
    rows = docs.select(
        whole_row(docs),
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(learn, F.lit(False)).alias("learned"),
    )

    def scored(passed: tuple[str, ...]) -> DataFrame:
        # A row that holds the text as a string carries it, so that no text is sent twice.
        inside = text_col if "row" in passed and dict(docs.dtypes).get(text_col) == "string" else None
        frame = rows.select(*passed) if inside else rows.select(*passed, "text")
        frame = _scored(frame, passed, groups[0] if groups else None, True, len(groups) < 2, inside)
        for i, group in enumerate(groups[1:], 2):
            frame = _scored(frame, passed, group, False, i == len(groups), inside)
        return frame

    small = materialize(scored(("id", "lang", "learned")), "languages")
    # Whole rows are scored once more rather than written beside their scores.
    judged = scored(("row", "id", "lang", "learned")) if keep_rows else small
    return _judged(judged, small, names, languages <= BROADCAST_LANGUAGES)


#: What a text carries from one group of models to the next: its best language and that one's cross-entropy, the sum of
#: all probabilities by that of the best one, and its sequences; none for a text without letters.
_SO_FAR = "lang_pred string, score double, entropy double, letters long"


def _scored(
    frame: DataFrame, passed: tuple[str, ...], group, first: bool, last: bool, inside: str | None = None
) -> DataFrame:
    """Holds the texts against a group of models. The last one turns sums into scores and leaves the text behind.

    Texts are the column ``text``, or with ``inside`` the field of that name in ``row``.
    """
    kept = passed if last or inside else (*passed, "text")
    field = frame.schema["row"].dataType.names.index(inside) if inside else None
    schema = T.StructType([*[frame.schema[name] for name in kept], *T.StructType.fromDDL(_SO_FAR)])
    before = T.StructType.fromDDL(_SO_FAR).names

    def texts_of(batch: pa.RecordBatch) -> pa.Array:
        return batch.column("row").field(field) if inside else batch.column("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = group.value if group else Models([], [], [])
        for batch in batches:
            for part in slices(batch, texts_of(batch), PART):
                texts = texts_of(part).to_pylist()
                made = compared(models, texts, None if first else [part.column(name).to_pylist() for name in before])
                if last:
                    made[1] = [1 / total if total else 0.0 for total in made[1]]
                columns = [part.column(name) for name in kept]
                columns += [pa.array(v, t) for v, t in zip(made, (pa.string(), pa.float64(), pa.float64(), pa.int64()))]
                yield from pa.Table.from_arrays(columns, names=schema.names).to_batches()
        give_back()

    return frame.mapInArrow(run, schema)


def compared(models: Models, texts: list[str | None], before: list[list] | None) -> list[list]:
    """The columns of ``_SO_FAR`` for some texts; ``before`` has them after the groups before."""
    if not models.names:
        none = [0.0] * len(texts)
        return [["und"] * len(texts), none, none, [0] * len(texts)]
    sizes, bits = models.entropies(texts)
    best = bits.argmin(1)
    lowest = bits[np.arange(len(bits)), best]
    counted = np.minimum(sizes, 64)
    total = np.exp2((lowest[:, None] - bits) * counted[:, None]).sum(1)
    names = np.array(models.names, object)[best]
    if before is not None:
        old_names, old_total, old_lowest = (np.array(column, kind) for column, kind in zip(before, (object, float, float)))
        # Both sums by the probability of the better of the two languages; the first one of equals stays.
        better = lowest < old_lowest
        top = np.where(better, lowest, old_lowest)
        total = total * np.exp2((top - lowest) * counted) + old_total * np.exp2((top - old_lowest) * counted)
        names, lowest = np.where(better, names, old_names), top
    lettered = sizes > 0
    for i in np.flatnonzero(~lettered).tolist():  # one or two letters: no sequence of four
        if len(characters(texts[i])):
            lettered[i] = True
    return [
        np.where(lettered, names, "und").tolist(),
        np.where(lettered, total, 0.0).tolist(),
        np.where(sizes > 0, lowest, 0.0).tolist(),
        sizes.tolist(),
    ]


def _judged(scored: DataFrame, known: DataFrame, names: tuple[str, ...], few: bool) -> DataFrame:
    """Rejection against training texts, by a table of at most 64 rows a language: sent to all tasks if these are few."""

    def held(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if few else frame

    size = F.floor(F.log2(F.greatest("letters", F.lit(1)))).alias("size")
    usual = (
        known.where("learned and lang = lang_pred and letters > 0")
        .groupBy(F.col("lang_pred").alias("own"), size)
        .agg(F.avg("entropy").alias("mean"), F.stddev_pop("entropy").alias("spread"), F.count("*").alias("rows"))
    )
    overall = usual.groupBy("own").agg(
        F.max("mean").alias("highest"), F.max("spread").alias("widest")
    )
    judged = scored.withColumn("size", size).join(
        held(usual.where("rows >= 30").withColumnRenamed("size", "own_size")),
        (F.col("lang_pred") == F.col("own")) & (F.col("size") == F.col("own_size")),
        "left",
    )
    judged = judged.join(held(overall.withColumnRenamed("own", "whole")), F.col("lang_pred") == F.col("whole"), "left")
    # A class with few training texts takes the highest mean and the widest spread of its language.
    limit = F.coalesce("mean", "highest") + REJECT * F.greatest(F.coalesce("spread", "widest"), F.lit(0.05))
    rejected = (F.col("lang_pred") == "und") | F.coalesce(F.col("entropy") > limit, F.lit(False))
    return judged.select(*names, "learned", "lang_pred", "score", "entropy", "letters", rejected.alias("rejected"))
