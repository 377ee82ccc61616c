"""Quality classifier: Naive Bayes support vectors.

n-gram indicators (``features``) are scaled by the log ratio of their class frequencies; a linear hinge-loss model over
them is fitted by dual coordinate descent; its margin becomes a probability by a logistic curve fitted on rows that the
fitting of the margins did not see. Fitting uses a bounded sample of labelled rows (``fit_rows``, by hash of the id);
scoring covers every row and its whole text.

Nulls: null text as empty, which has a score of its own; null label or id: not learned from; without rows of both classes
every score is 0.5. Repeated rows are scored each. Empty table: empty result. Only doc_id and text are read of docs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import batches, held_out, labelled_texts, logistic
from smelter.llm.features import SIZE, indicators

FIT_ROWS = 6000


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = [np.full(SIZE, smooth) for _ in range(2)]
    for slots, y in zip(rows, labels):
        counts[int(y)][slots] += 1
    n = [smooth + (labels == y).sum() for y in range(2)]
    return np.log((counts[1] / n[1]) / (counts[0] / n[0]))


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, c: float, passes: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights over the scaled indicators, and bias, of an L1-loss support vector machine by dual coordinate descent."""
    y = np.where(labels == 1, 1.0, -1.0)
    values = [scale[slots] for slots in rows]
    norms = [float(v @ v) ** 0.5 or 1.0 for v in values]
    values = [v / n for v, n in zip(values, norms)]
    share = np.maximum(1, np.bincount(labels.astype(int), minlength=2))
    upper = c * len(rows) / (2 * share[labels.astype(int)])  # the rarer class costs more
    alpha, w, bias = np.zeros(len(rows)), np.zeros(SIZE), 0.0
    random = np.random.default_rng(seed)
    for _ in range(passes):
        largest = 0.0
        for i in random.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), upper[i])  # a unit row and the bias: curvature 2
            step = (new - alpha[i]) * y[i]
            if step:
                largest = max(largest, abs(step))
                alpha[i] = new
                w[rows[i]] += step * values[i]
                bias += step
        if largest < 1e-3:
            break
    return w, bias


def margins(rows: Iterable[np.ndarray], scale: np.ndarray, w: np.ndarray, bias: float) -> np.ndarray:
    return np.array([w[s] @ scale[s] / (float(scale[s] @ scale[s]) ** 0.5 or 1.0) + bias for s in rows])


@dataclass
class Scorer:
    """The fitted margin and its curve; a row's indicators are scaled and brought to unit length as in fitting."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, texts: list[str]) -> np.ndarray:
        m = margins(map(indicators, texts), self.scale, self.weights, self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -500, 500)))


def fit_arrays(rows: list[np.ndarray], labels: np.ndarray, c: float = 0.3, passes: int = 30, folds: int = 3) -> Scorer | None:
    """None unless both classes have a row for each fold."""
    if min((labels == 0).sum(), (labels == 1).sum()) < folds:
        return None
    fold = np.zeros(len(rows), dtype=int)
    for y in (0, 1):
        fold[labels == y] = np.arange((labels == y).sum()) % folds
    unseen = np.zeros(len(rows))
    for k in range(folds):
        fit = [i for i in range(len(rows)) if fold[i] != k]
        rest = [i for i in range(len(rows)) if fold[i] == k]
        scale = log_count_ratios([rows[i] for i in fit], labels[fit])
        w, b = dual_descent([rows[i] for i in fit], labels[fit], scale, c, passes)
        unseen[rest] = margins([rows[i] for i in rest], scale, w, b)
    slope, shift = (float(v) for v in logistic(unseen[:, None], labels))
    scale = log_count_ratios(rows, labels)
    w, b = dual_descent(rows, labels, scale, c, passes)
    return Scorer(scale, w, b, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", fit_rows: int = FIT_ROWS) -> Scorer | None:
    """Fit on at most fit_rows labelled rows outside the held-out fold; no more than their indicators reach the driver."""
    rows = labelled_texts(docs, labels, label, fit_rows)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 256):
            slots = [indicators(t).astype(np.int32).tobytes() for t in frame.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(slots, pa.binary()), frame.column(2)], names=["doc_id", "slots", "y"])

    found = sorted(rows.mapInArrow(run, "doc_id long, slots binary, y int").collect())
    return fit_arrays([np.frombuffer(r.slots, dtype=np.int32) for r in found], np.array([r.y for r in found], dtype=int))


def score(docs: DataFrame, model: Scorer | None) -> DataFrame:
    """doc_id and score (0 to 1, higher: class 1 likelier) for every row of docs."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 256):
            texts = [t or "" for t in frame.column(1).to_pylist()]
            scores = model.probability(texts) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    scored = score(docs, fit(docs, labels, fit_rows=fit_rows))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold."""
    model = fit(docs, labels, fit_rows=fit_rows)
    names = docs.columns
    fields = docs.select(F.struct("*").alias("row"), F.col("text").alias("body"))

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        found = [t or "" for t in texts]
        return pd.Series(model.probability(found) if model else np.full(len(found), 0.5))

    return fields.where(scored("body") >= threshold).select("row.*").select(*[f"`{n}`" for n in names])
