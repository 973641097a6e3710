"""Document quality learned from preferences: a Bradley-Terry model over features of the text.

A preference says that one document is better than another. The model gives each document a strength, linear in its
features; the probability of a preference is the logistic function of the difference of strengths. Weights minimise the
logistic loss over feature differences of preference pairs: every better labelled row against every worse one. The
threshold is a quantile of the strengths of these rows, and the score is 0.3 exactly there.

No pair is formed. What a pair adds to the slope and the curvature of the loss is a smooth function of two strengths,
which cubics through points ``1 / POINTS`` apart give with a relative error below 1e-6. So each Newton step sums the rows
of a class by such points on Spark, with their features, and the driver combines the points of both classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.common import ids_and_texts, map_texts
from tablejobs.llm.toxicity import logistic
from tablejobs.storage import materialize, release

#: Pairs that each worse document weighs in the loss, however many better ones it is held against.
PAIRS = 25
#: The score at the threshold.
AT_THRESHOLD = 0.3
#: Points a unit of strength is cut into.
POINTS = 16
#: Quantiles of each class that are tried as thresholds, and the accuracy of their ranks (one in so many rows).
QUANTILES, RANKS = 999, 1_000_000

_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_STOPS = b".,;:?'\"()-"
_MARKS = bytes(b for b in range(33, 127) if b not in _LETTERS and b not in _STOPS and not 48 <= b <= 57)


def features(text: str | None) -> list[float]:
    """What the model sees of a text: shares and lengths, none of which grows without bound."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), max(1, len(data))
    lines = [line for line in data.split(b"\n") if line.strip()]

    def share(characters: bytes) -> float:
        return 1 - len(data.translate(None, characters)) / size

    held = max(1, n)
    marks = held and sum(len(data) - len(data.translate(None, bytes([b]))) for b in b"#*$%&|<>!") / held
    repeats = sum(map(bytes.__eq__, words[1:], words)) / held
    distinct = len(set(words))
    return [
        min(marks, 4.0),
        share(_MARKS),
        share(_UPPER),
        share(_STOPS),
        share(_LETTERS),
        share(b"0123456789"),
        repeats,
        np.log1p(n) / 10,
        float(n < 5),
        float(n < 20),
        distinct / held,
        np.log1p(distinct) / np.log1p(held) if n else 0.0,
        1 - len(set(lines)) / max(1, len(lines)),
        min(10.0, (sum(map(len, words)) / held)) / 10,
        float(share(_MARKS) > 0.02),
        float(repeats > 0.05),
        float(distinct / held < 0.35),
    ]


def bradley_terry(better: np.ndarray, worse: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights under which better rows beat worse ones: logistic loss on their differences, by Newton steps.

    For pairs that fit into memory; ``pair_weights`` is for those of whole tables.
    """
    differences = np.concatenate([better - worse, worse - better])
    wins = np.concatenate([np.ones(len(better)), np.zeros(len(better))])
    # The constant cancels in differences; its column stays for the solver and gets weight 0.
    return logistic(np.column_stack([np.zeros(len(differences)), differences]), wins, penalty)[1:]


_N = 17
_COLUMNS = [f"f{k}" for k in range(_N)]


@dataclass
class Ranking:
    """Weights of scaled features, and the strength at the threshold; or a constant score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0
    constant: float | None = None

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) / self.spread

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        """The same for a row whatever rows are beside it."""
        return (self.scaled(rows) * self.weights).sum(1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        odds = np.clip(self.strengths(rows) - self.threshold, -30, 30) + np.log(AT_THRESHOLD / (1 - AT_THRESHOLD))
        return 1 / (1 + np.exp(-odds))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(name).to_numpy() for name in _COLUMNS])


def _between(strengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The four points around each strength, and what each of them counts for in a cubic through them."""
    at = np.floor(strengths * POINTS)
    f = strengths * POINTS - at
    shares = [-f * (f - 1) * (f - 2) / 6, (f + 1) * (f - 1) * (f - 2) / 2, -(f + 1) * f * (f - 2) / 2, (f + 1) * f * (f - 1) / 6]
    return at.astype(np.int64)[:, None] + np.arange(-1, 3), np.column_stack(shares)


def _by_points(learned: DataFrame, model: Ranking) -> list[tuple[np.ndarray, np.ndarray]]:
    """For worse and better rows: points, and beside each the rows and the sums of scaled features that fall to it."""
    names = ["label", "point", "n", *_COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch)
            points, shares = _between(model.strengths(rows))
            values = np.column_stack([np.ones(len(rows)), model.scaled(rows)])
            keys = (2 * points + batch.column("label").to_numpy()[:, None]).ravel()
            values = (shares[:, :, None] * values[:, None, :]).reshape(len(keys), -1)
            order = np.argsort(keys, kind="stable")
            own, first = np.unique(keys[order], return_index=True)
            sums = np.add.reduceat(values[order], first)
            columns = [pa.array(own % 2, pa.int32()), pa.array(own // 2, pa.int64()), *map(pa.array, sums.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "label int, point long, " + ", ".join(f"{name} double" for name in names[2:])
    made = learned.mapInArrow(run, schema).groupBy("label", "point").agg(*[F.sum(c).alias(c) for c in names[2:]])
    found = np.array(sorted(map(tuple, made.collect())))
    return [(found[found[:, 0] == label, 1].astype(np.int64), found[found[:, 0] == label, 2:]) for label in (0, 1)]


def _curvature(learned: DataFrame, model: Ranking, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The sum over all rows of the products of scaled features, each row times what its class's table says of its strength."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_N, _N))
        for batch in batches:
            rows, label = _matrix(batch), batch.column("label").to_numpy()
            points, shares = _between(model.strengths(rows))
            for value, (known, said) in enumerate(tables):
                own = label == value
                factor = (said[np.searchsorted(known, points[own])] * shares[own]).sum(1)
                held = model.scaled(rows[own])
                total += (held * factor[:, None]).T @ held
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["total"])

    parts = learned.mapInArrow(run, "total array<double>").collect()
    return sum((np.array(row[0]) for row in parts), np.zeros(_N * _N)).reshape(_N, _N)


def pair_weights(learned: DataFrame, model: Ranking, penalty: float = 1.0) -> np.ndarray:
    """Weights under which better rows of ``learned`` beat worse ones, over all pairs, by Newton steps from the model's."""
    for _ in range(50):
        (worse, of_worse), (better, of_better) = _by_points(learned, model)
        against_worse, against_better = np.zeros((len(better), 2)), np.zeros((len(worse), 2))
        mixed = np.zeros((_N, _N))
        for at in range(0, len(better), 256):
            some = slice(at, at + 256)
            lost = 1 / (1 + np.exp(np.clip((better[some, None] - worse[None, :]) / POINTS, -500, 500)))
            curved = lost * (1 - lost)
            against_worse[some] = np.column_stack([lost @ of_worse[:, 0], curved @ of_worse[:, 0]])
            against_better += np.column_stack([of_better[some, 0] @ lost, of_better[some, 0] @ curved])
            mixed += of_better[some, 1:].T @ curved @ of_worse[:, 1:]
        # Each pair counts in both directions, as in ``bradley_terry``.
        each = 2 * PAIRS / of_better[:, 0].sum()
        slope = against_better[:, 0] @ of_worse[:, 1:] - against_worse[:, 0] @ of_better[:, 1:]
        own = _curvature(learned, model, [(worse, against_better[:, 1]), (better, against_worse[:, 1])])
        curvature = each * (own - mixed - mixed.T) + np.diag(np.full(_N, penalty + 1e-9))
        step = np.linalg.solve(curvature, each * slope + penalty * model.weights)
        # Rounded, so that the order in which Spark adds up does not show.
        model = Ranking(model.mean, model.spread, np.round(model.weights - step, 9))
        if np.abs(step).max() < 1e-6:
            break
    return model.weights


def _threshold(learned: DataFrame, model: Ranking) -> float:
    """What tells the classes apart best over all rows, by the mean of both accuracies: one of the quantiles of both classes
    or a middle between two neighbours, which leaves room on both sides where no row lies between.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column("label"), pa.array(model.strengths(_matrix(batch)), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "strength"])

    strengths = materialize(learned.mapInArrow(run, "label int, strength double"), "strengths")
    shares = np.linspace(0.001, 0.999, QUANTILES).tolist()
    found = strengths.groupBy("label").agg(F.percentile_approx("strength", shares, RANKS)).collect()
    quantiles = np.unique(np.concatenate([row[1] for row in found]))
    quantiles = np.unique(np.concatenate([quantiles, (quantiles[1:] + quantiles[:-1]) / 2]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, len(quantiles) + 1), np.int64)
        for batch in batches:
            passed = np.searchsorted(quantiles, batch.column("strength").to_numpy(), "right")
            np.add.at(counts, (batch.column("label").to_numpy(), passed), 1)
        label, passed = np.nonzero(counts)
        columns = [pa.array(label, pa.int32()), pa.array(passed, pa.int32()), pa.array(counts[label, passed], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "passed", "n"])

    counted = strengths.mapInArrow(place, "label int, passed int, n long").groupBy("label", "passed").agg(F.sum("n"))
    counts = np.zeros((2, len(quantiles) + 1))
    for label, passed, n in counted.collect():
        counts[label, passed] = n
    release(strengths)
    # A row that has passed k quantiles is at or above the first k of them.
    below = counts.cumsum(1)[:, :-1] / counts.sum(1, keepdims=True)
    accuracy = below[0] + 1 - below[1]
    best = np.flatnonzero(np.isclose(accuracy, accuracy.max()))
    return float(quantiles[best[(len(best) - 1) // 2]])


def fit(learned: DataFrame) -> Ranking:
    """The model of all rows of a table of labels and features."""
    columns = [f(c).alias(f"{k}{c}") for c in _COLUMNS for k, f in (("mean_", F.avg), ("spread_", F.stddev_pop))]
    told = learned.agg(F.count("*").alias("n"), F.sum("label").alias("better"), *columns).first()
    if not told.n or told.better in (0, told.n):
        share = told.better / told.n if told.n else 0.5
        return Ranking(np.zeros(_N), np.ones(_N), np.zeros(_N), constant=min(0.95, max(0.05, share)))
    mean, spread = (np.array([told[f"{k}{c}"] for c in _COLUMNS]) for k in ("mean_", "spread_"))
    model = Ranking(np.round(mean, 12), np.maximum(np.round(spread, 12), 1e-6), np.zeros(_N))
    model.weights = pair_weights(learned, model)
    model.threshold = _threshold(learned, model)
    return model


def labelled_features(table: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """label and features of all rows that may be learned from and have a text; rows of one id, text and label once."""
    marked = labels.select(F.col("id").alias("of"), F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    own = table.where(learn & F.col("hash").isNotNull()).groupBy("id", "hash")
    own = own.agg(*[F.any_value(c).alias(c) for c in _COLUMNS])
    return own.join(marked.distinct(), F.col("id") == F.col("of")).select("label", *_COLUMNS)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 if the score is 0.3 or more).

    ``learn`` is a condition on the column ``id`` of the rows that may be learned from; all of them with a label and a
    text are, whatever their number and length. Null and empty texts have the features of a text without words. Whole
    texts are scored. Repeated rows and null ids are scored like others, and repeated rows are learned from once; an
    empty table gives no rows. Without two classes of labelled rows the score is the share of the better one (one half
    without labels). Further columns are not read.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    rows = rows.withColumn("hash", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    seen = map_texts(
        rows, ", ".join(f"{c} double" for c in _COLUMNS), lambda texts: list(zip(*map(features, texts))), keep=("id", "hash")
    )
    table = materialize(seen, "features")
    marks = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).alias("label"))
    learned = materialize(labelled_features(table, marks, learn), "learned")
    model = fit(learned)
    release(learned)
    kind = table.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch))
            columns = [batch.column("id"), pa.array(found, pa.float64()), pa.array(found >= AT_THRESHOLD).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "predicted"])

    return table.select("id", *_COLUMNS).mapInArrow(score, f"id {kind}, score double, predicted int")
