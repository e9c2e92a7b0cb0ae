"""Isolation forest (Liu, Ting and Zhou 2008): trees on small samples, scored next to the data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.quantiles import exact_quantiles
from seriesprep.functions.scalars import col
from seriesprep.operators.impute import fit_medians, impute_saved
from seriesprep.operators.labels import apply_scale, fit_scale
from seriesprep.workspace import stage

KEY = "_row_key"
GROUPS = 64  # of tasks whose samples are merged first
CHUNK = 4096  # rows scored at a time
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, depth double"


def _mean_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean search depth among n points in a random binary tree."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    harmonic = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, harmonic, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, depth) of one random tree; a leaf has feature -1."""
    nodes: list[tuple] = [()]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        at, rows, depth = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        choices = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(choices):
            nodes[at] = (-1, 0.0, -1, -1, depth + float(_mean_depth(len(rows))))
            continue
        f = int(rng.choice(choices))
        cut = float(rng.uniform(low[f], high[f]))
        goes_left = x[rows, f] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [(), ()]
        nodes[at] = (f, cut, left, right, 0.0)
        todo += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def _scores(forest: dict, raw: np.ndarray) -> np.ndarray:
    """Walk all rows down all trees at once, level by level."""
    x = (raw - forest["mean"]) / forest["spread"]
    flat, width = x.ravel(), x.shape[1]
    base = (np.arange(len(x)) * width)[:, None]
    at = np.broadcast_to(forest["roots"], (len(x), len(forest["roots"])))
    for _ in range(forest["levels"]):
        goes_right = flat.take(base + forest["feature"].take(at)) > forest["cut"].take(at)
        at = forest["children"].take(2 * at + goes_right)
    score = 2.0 ** (-forest["depth"].take(at).mean(axis=1) / forest["norm"])
    return np.where(np.isnan(x).any(axis=1), np.nan, score)


class IsolationForest:
    """Fit on the training rows, flag the share ``contamination`` of them that is easiest to isolate.

    Nulls take the training median, or with ``complete_rows`` only complete rows are used for
    fitting and incomplete ones are never flagged.
    """

    def __init__(self, features: Sequence[str], contamination: float = 0.02, trees: int = 100,
                 sample_rows: int = 256, seed: int = 42, complete_rows: bool = False):
        self.features = list(features)
        self.contamination, self.trees, self.sample_rows = contamination, trees, sample_rows
        self.seed, self.complete_rows = seed, complete_rows

    def fit(self, train: DataFrame) -> IsolationForestModel:
        atomic = [f.name for f in train.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        x = train.select(*[col(c).cast("double").alias(c) for c in self.features], F.xxhash64(*[col(c) for c in atomic]).alias(KEY))
        medians: dict[str, float] = {}
        if self.complete_rows:
            x = x.dropna(subset=[f"`{c}`" for c in self.features])
        else:
            medians = fit_medians(x, self.features)
            x = impute_saved(x, medians)
        scale = fit_scale(x, self.features)
        if set(scale) != set(self.features):
            raise ValueError(f"features without values: {sorted(set(self.features) - set(scale))}")
        x = apply_scale(x, scale)
        n = x.count()
        size = min(self.sample_rows, n)
        if size < 2:
            raise ValueError("the isolation forest needs at least two training rows")
        forest = self._trees(x, n, size)
        model = IsolationForestModel(self.features, medians, scale, forest, size, None)
        scores = stage(model.score(train, "_score").select("_score"), "scores")
        (threshold,) = exact_quantiles(scores, ["_score"], [1.0 - self.contamination])["_score"]
        model.threshold = threshold
        return model

    def _trees(self, x: DataFrame, n: int, size: int) -> pd.DataFrame:
        """Draw ``size`` rows per tree and grow the trees in parallel, one per group.

        A tree takes the rows with the smallest hashes of seed, tree and row. Smallest hashes merge: every task keeps those of
        its rows, some groups of tasks those of their tasks, so a tree's group holds a bounded number of rows and the same rows
        are drawn whatever the layout.
        """
        limit, seed, features, trees = int(np.ceil(np.log2(size))), self.seed, self.features, self.trees

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = [(np.empty(0, np.uint64), np.empty((0, len(features)))) for _ in range(trees)]
            for b in batches:
                data = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))])
                key = b.column(len(features)).to_numpy().view(np.uint64)
                for t in range(trees):
                    kept[t] = _smallest(*kept[t], _mixed(key, seed * trees + t), data, size)
            for t, (h, rows) in enumerate(kept):
                if len(h):
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * len(features), pa.int32()), pa.array(rows.ravel()))
                    yield pa.record_batch([pa.array(np.full(len(h), t), pa.int32()), pa.array(h.view(np.int64)), lists], names=["tree", "h", "x"])

        def fewer(table: pa.Table) -> pa.Table:
            h, rows = _drawn(table, len(features))
            chosen, rows = _smallest(np.empty(0, np.uint64), np.empty((0, len(features))), h, rows, size)
            return pa.table([pa.array(np.full(len(chosen), table.column("tree")[0].as_py()), pa.int32()), pa.array(chosen.view(np.int64)),
                             pa.array(list(rows), pa.list_(pa.float64()))], names=["tree", "h", "x"])

        def grow(table: pa.Table) -> pa.Table:
            tree = table.column("tree")[0].as_py()
            h, rows = _drawn(table, len(features))
            _, rows = _smallest(np.empty(0, np.uint64), np.empty((0, len(features))), h, rows, size)
            nodes = _grow(rows, np.random.default_rng([seed, tree]), limit)
            numbers = [np.full(len(nodes), tree), np.arange(len(nodes)), *np.array(nodes, float).T]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
            return pa.table([pa.array(v).cast(k) for v, k in zip(numbers, kinds, strict=True)],
                            names=["tree", "node", "feature", "cut", "left", "right", "depth"])

        schema = "tree INT, h LONG, x ARRAY<DOUBLE>"
        drawn = x.select(*[col(c) for c in features], KEY).mapInArrow(draw, schema).withColumn("g", F.spark_partition_id() % GROUPS)
        drawn = drawn.groupBy("tree", "g").applyInArrow(lambda t: fewer(t), schema)
        # at most trees * 2 * sample_rows nodes
        return drawn.groupBy("tree").applyInArrow(lambda t: grow(t), NODE_SCHEMA).toPandas()


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of keys under a salt: all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = key + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def _smallest(h: np.ndarray, rows: np.ndarray, more: np.ndarray, data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` smallest hashes of both and their rows, in order."""
    if len(h) == size:
        low = more < h[-1]
        more, data = more[low], data[low]
    h, rows = np.concatenate([h, more]), np.concatenate([rows, data])
    order = np.lexsort((*rows.T, h))[:size]
    return h[order], rows[order]


def _drawn(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    return table.column("h").to_numpy().view(np.uint64), np.array(table.column("x").to_pylist(), float).reshape(-1, width)


class IsolationForestModel:
    """A grown forest: scores rows in Arrow batches, flags scores above the threshold."""

    def __init__(self, features, medians, scale, nodes: pd.DataFrame, size: int, threshold: float | None):
        self.features, self.medians, self.scale = features, medians, scale
        self.nodes, self.size, self.threshold = nodes, size, threshold

    def score(self, df: DataFrame, name: str = "an_score") -> DataFrame:
        """Anomaly score in (0, 1); null where a feature stays null."""
        nodes = self.nodes.sort_values(["tree", "node"])
        start = np.concatenate([[0], np.cumsum(nodes.groupby("tree").size().to_numpy())])
        offset = np.repeat(start[:-1], np.diff(start))
        at = np.arange(len(nodes))
        leaf = nodes["feature"].to_numpy() < 0
        # one flat table of nodes; a leaf leads back to itself
        forest = {
            "roots": start[:-1],
            "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
            "cut": nodes["cut"].to_numpy(),
            "children": np.where(leaf[:, None], at[:, None], nodes[["left", "right"]].to_numpy() + offset[:, None]).ravel(),
            "depth": nodes["depth"].to_numpy(),
            "levels": int(np.ceil(np.log2(self.size))),
            "mean": np.array([self.scale[c][0] for c in self.features]),
            "spread": np.array([self.scale[c][1] for c in self.features]),
            "norm": float(_mean_depth(self.size)),
        }
        shared = df.sparkSession.sparkContext.broadcast(forest)

        @F.pandas_udf("double")
        def path_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for pdf in batches:
                x = pdf.to_numpy(dtype=float)
                parts = [_scores(shared.value, x[i:i + CHUNK]) for i in range(0, len(x), CHUNK)]
                yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        inputs = [
            F.coalesce(col(c).cast("double"), F.lit(self.medians.get(c)).cast("double")).alias(f"c{i}")
            for i, c in enumerate(self.features)
        ]
        complete = inputs[0].isNotNull()
        for c in inputs[1:]:
            complete = complete & c.isNotNull()
        return df.withColumn(name, path_score(F.struct(*inputs))).withColumn(
            name, F.when(complete & ~F.isnan(name), F.col(name))
        )

    def transform(self, df: DataFrame, flag: str = "an_iso") -> DataFrame:
        scored = self.score(df, "_score")
        hit = F.coalesce(F.col("_score") > F.lit(self.threshold), F.lit(False))
        return scored.withColumn(flag, hit.cast("int")).drop("_score")
