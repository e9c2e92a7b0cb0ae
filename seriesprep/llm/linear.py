"""Softmax regression over hashed sparse features; gradients are summed over the shards of a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage

SHARDS = 8
SAMPLE_SPACE = 1 << 30


@dataclass(frozen=True)
class Linear:
    """Weights of shape (classes, dims + 1); the last column is the intercept."""

    weights: np.ndarray

    def posteriors(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Class probabilities of rows given as flat features and the position of each row's first one."""
        w, rows = self.weights, len(starts) - 1
        scores = np.zeros((rows, w.shape[0]))
        for k in range(w.shape[0]):
            sums = np.concatenate([[0.0], np.cumsum(w[k, index] * value)])
            scores[:, k] = sums[starts[1:]] - sums[starts[:-1]] + w[k, -1]
        scores -= scores.max(axis=1, keepdims=True) if rows else 0
        p = np.exp(scores)
        return p / p.sum(axis=1, keepdims=True)


def bounded_sample(rows: DataFrame, key, count: int, most: int) -> DataFrame:
    """About ``most`` rows chosen by a hash of ``key``, all rows if there are fewer."""
    limit = min(SAMPLE_SPACE, int(SAMPLE_SPACE * most / max(count, 1)))
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(SAMPLE_SPACE)) < limit)


def fit(features: DataFrame, classes: int, dims: int, steps: int = 40, rate: float = 0.3, decay: float = 1e-4) -> Linear:
    """Fit on rows of ``index`` (array of ints), ``value`` and ``target`` (arrays of floats, ``target`` one per class).

    Full-batch steps with a rate of its own for every weight. Weights are broadcast and let go after each step; at most ``SHARDS``
    tasks return one gradient each.
    """
    context = features.sparkSession.sparkContext
    data = stage(features, "training-rows").coalesce(SHARDS)
    count = data.count()
    weights = np.zeros((classes, dims + 1))
    if not count:
        return Linear(weights)
    seen = np.full_like(weights, 1e-8)

    def gradient(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, total = Linear(shared.value), np.zeros((classes, dims + 1))
            for b in batches:
                lists = b.column(0)
                starts = lists.offsets.to_numpy().astype(np.int64)
                index, value = lists.values.to_numpy(), b.column(1).values.to_numpy().astype(float)
                target = b.column(2).values.to_numpy().reshape(-1, classes)
                index, value, starts = index[starts[0] : starts[-1]], value[starts[0] : starts[-1]], starts - starts[0]
                error = model.posteriors(index, value, starts) - target[: b.num_rows]
                sizes = np.diff(starts)
                for k in range(classes):
                    total[k, :-1] += np.bincount(index, np.repeat(error[:, k], sizes) * value, dims)
                    total[k, -1] += error[:, k].sum()
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["g"])

        return run

    for _ in range(steps):
        shared = context.broadcast(weights)
        parts = data.mapInArrow(gradient(shared), "g BINARY").collect()  # at most SHARDS
        shared.destroy()
        step = sum(np.frombuffer(r["g"]).reshape(weights.shape) for r in parts) / count + decay * weights
        seen += step**2
        weights = weights - rate * step / np.sqrt(seen)
    return Linear(weights.astype(np.float32))
