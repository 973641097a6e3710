"""Toxicity by compression distance: how much shorter windows of a text get with a dictionary of toxic text.

Two zstandard dictionaries are trained, one on ordinary text and one on those word beginnings that toxic training
texts have far more often. A window is compressed twice: with the ordinary dictionary alone and with the toxic one in
front of it. Words that only toxic text has shorten the second result. Both get the same known words in front of the
window, so that a single match pays off. A logistic model over how many windows of a text gain how many bytes,
calibrated on training texts that the dictionaries have not seen, gives the score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.common import ids_and_texts, map_texts
from tablejobs.storage import materialize

#: Words in a window.
WINDOW = 8
#: Bytes of the two dictionaries.
ORDINARY_SIZE, TOXIC_SIZE = 4096, 640
#: Labelled rows of each class the model is fitted on at most; rows are chosen by a hash of their id.
FIT_ROWS = {1: 3000, 0: 6000}
#: Characters of a labelled text up to which it may be used for fitting.
FIT_CHARS = 100_000
#: Gains in bytes that are told apart.
GAINS = 12
#: A word beginning is toxic if its frequency in toxic texts lies so many deviations and times above the ordinary.
DEVIATIONS, RATIO = 5.0, 4.0

_KNOWN = 64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def windows(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


def beginnings(word: bytes) -> list[bytes]:
    """Beginnings of a word from four bytes on, and the word itself with the space behind it."""
    return [b" " + word[:k] for k in range(4, min(len(word), 12) + 1)] + [b" " + word[:16] + b" "]


def _dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary's content; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass
class Detector:
    """Dictionaries and weights; compressors are made where they are used."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 * GAINS + 3))

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}

    def _compressor(self, content: bytes):
        parameters = zstandard.ZstdCompressionParameters(
            window_log=13,
            chain_log=12,
            hash_log=11,
            search_log=4,
            min_match=6,
            target_length=32,
            strategy=zstandard.STRATEGY_GREEDY,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters).compress

    def gains(self, words: list[bytes]) -> np.ndarray:
        """Windows of a text by the bytes they gain: 0 or less, 1, .., ``GAINS`` or more."""
        if not hasattr(self, "_pair"):
            self._pair = self._compressor(self.ordinary), self._compressor(self.toxic + self.ordinary)
        plain, both = self._pair
        known = self.ordinary[-_KNOWN:]
        gained = [len(plain(part)) - len(both(part)) for part in (known + window for window in windows(words))]
        return np.bincount(np.clip(gained, 0, GAINS).astype(np.int64), minlength=GAINS + 1) if gained else np.zeros(GAINS + 1)

    def features(self, words: list[bytes]) -> np.ndarray:
        found = self.gains(words)
        above = found[::-1].cumsum()[::-1][1:]  # windows that gain this much or more
        total = max(1.0, float(found.sum()))
        return np.concatenate([[1.0, np.log1p(total), (above > 0).sum() / GAINS], np.sqrt(above / total), np.log1p(above)])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(words_of(text)) @ self.weights, -30, 30))))


def logistic(rows: np.ndarray, labels: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the first column is the constant and goes unpenalised."""
    weights = np.zeros(rows.shape[1])
    ridge = np.full(rows.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - labels) + ridge * weights
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + np.diag(ridge + 1e-9), slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(texts: list[list[bytes]], labels: list[int]) -> Detector:
    """Dictionaries from labelled texts, given as words."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    sizes = Counter(labels)
    for own, label in zip(texts, labels):
        counts[label].update({part for word in set(own) for part in beginnings(word)})

    def excess(part: bytes) -> float:
        expected = counts[0][part] * sizes[1] / max(1, sizes[0]) + 0.5
        return (counts[1][part] - expected) / expected**0.5

    toxic = {
        part: excess(part)
        for part, n in counts[1].items()
        if n >= 3
        and n / sizes[1] >= RATIO * (counts[0][part] + 0.5) / max(1, sizes[0])
        and excess(part) >= DEVIATIONS
    }
    marks = []
    for own, label in zip(texts, labels):
        if label:
            for word in own:
                if found := [part for part in beginnings(word) if part in toxic]:
                    marks.append(max(found, key=lambda part: (toxic[part], len(part))))
    random = np.random.default_rng(0)
    plain = [window for own, label in zip(texts, labels) if not label for window in windows(own)]
    plain = [plain[i] for i in random.permutation(len(plain))[:60_000]]
    samples = [b"".join(marks[i] for i in random.integers(0, len(marks), 24)) for _ in range(400)] if marks else []
    return Detector(
        _dictionary(plain, ORDINARY_SIZE, 48) if plain else b" " * _KNOWN,
        _dictionary(samples, TOXIC_SIZE, 32) if samples else b"",
    )


def fit(texts: list[str | None], labels: list[int]) -> Detector:
    """Dictionaries from all rows; weights from gains that dictionaries of the other half of the rows give.

    With rows of one class only, every score is close to that class.
    """
    words = [words_of(text) for text in texts]
    if len(set(labels)) < 2:
        made = Detector(b" " * _KNOWN, b"")
        made.weights[0] = np.log((sum(labels) + 0.5) / (len(labels) - sum(labels) + 0.5))
        return made
    rows = np.zeros((len(texts), 2 * GAINS + 3))
    seen: Counter = Counter()
    halves = []
    for label in labels:  # both classes in both halves
        halves.append(seen[label] % 2)
        seen[label] += 1
    for half in (0, 1):
        chosen = [i for i, own in enumerate(halves) if own != half]
        other = train([words[i] for i in chosen], [labels[i] for i in chosen])
        for i, own in enumerate(halves):
            if own == half:
                rows[i] = other.features(words[i])
    made, y = train(words, labels), np.array(labels, float)
    made.weights = logistic(rows, y, 1.0)
    # Calibrated so that 0.5 is the threshold with the best F1 on the fitting rows.
    raw = rows @ made.weights
    best = max(np.unique(raw), key=lambda t: (_f1(raw >= t, y), -t))
    below = raw[raw < best]
    made.weights[0] -= (best + below.max()) / 2 if len(below) else best
    return made


def _f1(predicted: np.ndarray, labels: np.ndarray) -> float:
    hit = float((predicted * labels).sum())
    return 2 * hit / max(1.0, float(predicted.sum() + labels.sum()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: dict[int, int]) -> DataFrame:
    """(text, label) of at most ``most`` rows per class, chosen by hashes of id and text; texts up to ``FIT_CHARS``.

    Rows of one id, text and label count once. Only ids and hashes are shuffled: the list of those chosen, bounded by
    ``most``, is broadcast to where the texts are read.
    """
    own = docs.where(learn & (F.length("text") <= FIT_CHARS)).select("id", "text", F.xxhash64("text").alias("hash"))
    marked = labels.select(F.col("id").alias("of"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    narrow = own.select("id", "hash").distinct().join(marked.distinct(), F.col("id") == F.col("of"))
    narrow = materialize(narrow.select("id", "hash", "label"), "labelled")
    parts = [
        narrow.where(F.col("label") == value).orderBy(F.xxhash64("id", F.lit(7)), "hash").limit(count)
        for value, count in sorted(most.items())
    ]
    chosen = parts[0].unionByName(parts[1]).select(F.col("id").alias("of"), F.col("hash").alias("with"), "label")
    found = own.join(F.broadcast(chosen), (F.col("id") == F.col("of")) & (F.col("hash") == F.col("with")))
    return found.groupBy("id", "hash", "label").agg(F.min("text").alias("text")).select("text", "label")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
) -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 if the score is 0.5 or more).

    ``learn`` is a condition on the column ``id`` of the rows that may be learned from. Null and empty texts have no
    windows and get the score of such a text; whole texts are scored, whatever their length. Repeated rows and null
    ids are scored like others, and repeated rows are learned from once; an empty table gives no rows. Without
    labelled rows every score is one half, with one class only near that class. Further columns are not read.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    marks = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).alias("label"))
    sample = sorted(tuple(row) for row in labelled_sample(rows, marks, "label", learn, FIT_ROWS).collect())
    order = np.random.default_rng(0).permutation(len(sample))
    model = fit([sample[i][0] for i in order], [sample[i][1] for i in order])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts):
        found = [shared.value.score(text) for text in texts]
        return [found, [int(one >= 0.5) for one in found]]

    return map_texts(rows, "score double, predicted int", score)
