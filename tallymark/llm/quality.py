"""Document quality by a factorisation machine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import held_out, ship, table
from tallymark.llm.features import EDGES, STATISTICS, Remembered, bucket, labelled_sample, logistic, rows_of, shape, statistics

WORDS = 1 << 15
SHAPES = 1 << 11
BINS = 10
FACTORS = 8
MAX_LABELLED = 8_000  # labelled rows the machine is trained on
EPOCHS = 14
BATCH = 128
RATE = 0.08
THRESHOLD = 0.3

_WORD = Remembered(lambda piece: bucket(piece.strip(EDGES).lower(), WORDS))
_SHAPE = Remembered(lambda piece: bucket(shape(piece), SHAPES, 1))


def raw_features(text: str | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Word buckets, shape buckets with their shares of all words, and statistics. The text's length is its metadata."""
    text = text or ""
    pieces = text.split()
    words = set(map(_WORD.__getitem__, set(pieces)))
    shapes = np.bincount(np.fromiter(map(_SHAPE.__getitem__, pieces), np.int64, len(pieces)), minlength=SHAPES)
    found = np.flatnonzero(shapes)
    columns = np.concatenate([np.sort(np.fromiter(words, np.int32, len(words))), (found + WORDS).astype(np.int32)])
    values = np.concatenate([np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.sqrt(shapes[found] / max(1, len(pieces)))])
    return columns, values.astype(np.float32), statistics(text, pieces, len(set(pieces)))


@dataclass
class FactorisationMachine:
    """Bias, weights and factors of words, shapes and binned statistics; ``edges`` are the bins' inner bounds."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def columns(self, columns: np.ndarray, values: np.ndarray, stats: list[float]) -> tuple[np.ndarray, np.ndarray]:
        bins = WORDS + SHAPES + np.arange(STATISTICS) * BINS + (self.edges < np.asarray(stats)[:, None]).sum(1)
        return np.concatenate([columns, bins.astype(np.int32)]), np.concatenate([values, np.full(STATISTICS, 0.25, np.float32)])

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Pairs of features interact by the product of their factors; all pairs together take one pass over the features:
        half of (square of the sum minus sum of the squares)."""
        if not rows:
            return np.zeros(0)
        index, starts = rows_of(columns for columns, _ in rows)
        x, _ = rows_of(values for _, values in rows)
        scaled = self.factors[index] * x[:, None]
        total, squares = np.add.reduceat(scaled, starts), np.add.reduceat(scaled**2, starts)
        return logistic(self.bias + np.add.reduceat(self.weights[index] * x, starts) + 0.5 * (total**2 - squares).sum(1))


def trained(raw: list[tuple[np.ndarray, np.ndarray, list[float]]], labels: np.ndarray, seed: int = 7) -> FactorisationMachine:
    """Adaptive gradient descent on logistic loss; without both classes only the bias is set."""
    size, rng = WORDS + SHAPES + STATISTICS * BINS, np.random.default_rng(seed)
    stats = np.array([r[2] for r in raw]).reshape(-1, STATISTICS) if raw else np.zeros((1, STATISTICS))
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = FactorisationMachine(edges, float(np.log(share / (1 - share))), np.zeros(size, np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32))
    if len(set(labels.tolist())) < 2:
        return machine
    rows = [machine.columns(*r) for r in raw]
    grown_w, grown_v, grown_b = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            taken = order[at : at + BATCH]
            batch = [rows[i] for i in taken]
            index, starts = rows_of(c for c, _ in batch)
            x, _ = rows_of(v for _, v in batch)
            row = np.repeat(np.arange(len(batch)), np.diff([*starts, len(index)]))
            error = machine.score(batch) - labels[taken]
            factors = machine.factors[index]
            total = np.add.reduceat(factors * x[:, None], starts)
            unique, place = np.unique(index, return_inverse=True)
            step = error[row] * x / len(batch)
            slope_w = np.bincount(place, step) + 1e-5 * machine.weights[unique]
            inner = step[:, None] * (total[row] - factors * x[:, None])
            slope_v = np.stack([np.bincount(place, inner[:, k]) for k in range(FACTORS)], 1) + 1e-5 * machine.factors[unique]
            grown_w[unique] += slope_w**2
            grown_v[unique] += slope_v**2
            grown_b += error.mean() ** 2
            machine.weights[unique] -= RATE * slope_w / np.sqrt(grown_w[unique])
            machine.factors[unique] -= RATE * slope_v / np.sqrt(grown_v[unique])
            machine.bias -= float(RATE * error.mean() / np.sqrt(grown_b))
    return machine


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> FactorisationMachine:
    """Train on at most ``max_labelled`` labelled rows; their features, not their texts, come to the driver."""
    ship(docs.sparkSession)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [raw_features(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "label": batch["label"], "columns": [c.tobytes() for c, _, _ in raw], "x": [v.tobytes() for _, v, _ in raw], "stats": [list(map(float, s)) for _, _, s in raw]}
            )

    sample = labelled_sample(docs, labels, "quality", max_labelled)
    found = sample.mapInPandas(extract, "doc_id long, label int, columns binary, x binary, stats array<double>").toPandas()
    found = found.sort_values(["doc_id", "columns"])
    raw = [(np.frombuffer(c, np.int32), np.frombuffer(x, np.float32), list(s)) for c, x, s in zip(found["columns"], found["x"], found["stats"])]
    return trained(raw, found["label"].to_numpy(float))


def quality(docs: DataFrame, machine: FactorisationMachine) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    The score is the probability of quality 1, and ``predicted`` is 1 from ``THRESHOLD`` on. NULL texts count as empty and
    get the score of a text without words; repeated rows get equal scores; NULL ids are not held out; other columns are
    not read. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            scores = [model.value.score([model.value.columns(*raw_features(t)) for t in texts[at : at + 64]]) for at in range(0, len(texts), 64)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(scores) if scores else []})

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, fit(docs, table(spark, sf_dir, "labels")))
