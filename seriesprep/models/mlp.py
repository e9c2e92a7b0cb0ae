"""Multilayer perceptrons trained by summed gradients, several at once.

Training rows are dealt to mini-batches and shards by a hash of the row, and packed into blocks of ``BLOCK_ROWS`` rows in a
fixed order. A mini-batch is one Spark job: tasks return the gradients of their blocks, which are added up in a fixed
order, and the driver takes one Adam step. What comes out is plain mini-batch training, whatever the layout of
the input and the number of tasks. A mini-batch has ``Net.batch`` rows, or more if an epoch would need more than
``Net.most_steps`` jobs. The first job of an epoch also scores the validation rows with the weights it starts from. If no
mini-batch has more than one block, there is nothing to add up: then one task reads the blocks of an epoch in turn
and takes the same steps, in one job, or of some epochs if it can hold the blocks.

Several nets over the same features (cells, for example one per target and horizon) share the blocks and the jobs:
each has its own labels, fill values, scales and early stop, and a job carries the gradients of all that still train. Only
weights and gradients travel.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.scalars import col
from seriesprep.models.estimators import Preparation
from seriesprep.operators.labels import fit_scale
from seriesprep.workspace import fresh_path, stage

Weights = list[np.ndarray]
BLOCK_ROWS = 1024
FAN = 64  # sums are added up by so many
EPOCHS_HELD, HELD_BYTES = 10, 64 << 20  # of one task
VALIDATION = -1  # number of the validation rows among the mini-batches


@dataclass(frozen=True)
class Net:
    """Hidden layers with ReLU; Huber loss on linear outputs, or softmax cross entropy."""

    task: str = "regression"  # or "class"
    hidden: tuple[int, ...] = (64, 32)
    dropout: float = 0.4  # after the first hidden layer
    l2: float = 1e-4
    rate: float = 1e-3
    batch: int = 512
    most_steps: int = 64  # mini-batches of an epoch; they grow if there are more rows
    epochs: int = 200
    patience: int = 100
    slow_after: int = 10  # epochs without gain before the rate is halved
    least_rate: float = 1e-6
    seed: int = 0


# Settings of the three kinds of run.
REGRESSION = Net()
MULTI = Net(patience=50, slow_after=8, least_rate=1e-5)
CLASSES = Net("class", (32,), 0.0, patience=50, slow_after=5, least_rate=1e-5)


def _start(net: Net, n_in: int, n_out: int) -> Weights:
    rng = np.random.default_rng(net.seed)
    sizes = [n_in, *net.hidden, n_out]
    out: Weights = []
    for a, b in zip(sizes, sizes[1:]):
        limit = np.sqrt(6.0 / (a + b))
        out += [rng.uniform(-limit, limit, (a, b)), np.zeros(b)]
    return out


def _forward(w: Weights, x: np.ndarray, net: Net, rng: np.random.Generator | None = None):
    acts, masks, h = [x], [], x
    layers = len(w) // 2
    for i in range(layers - 1):
        h = np.maximum(h @ w[2 * i] + w[2 * i + 1], 0.0)
        mask = None
        if rng is not None and i == 0 and net.dropout > 0:
            mask = (rng.random(h.shape) >= net.dropout) / (1.0 - net.dropout)
            h = h * mask
        masks.append(mask)
        acts.append(h)
    z = h @ w[-2] + w[-1]
    if net.task == "class":
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z = z / z.sum(axis=1, keepdims=True)
    return z, acts, masks


def _loss(z: np.ndarray, y: np.ndarray, weight: np.ndarray, net: Net) -> tuple[float, np.ndarray]:
    """Summed loss of the batch and its gradient at the output, averaged over the batch."""
    n = len(z)
    if net.task == "class":
        label = y[:, 0].astype(int)
        picked = np.clip(z[np.arange(n), label], 1e-12, None)
        grad = z.copy()
        grad[np.arange(n), label] -= 1.0
        return float((-np.log(picked) * weight).sum()), grad * weight[:, None] / n
    gap = z - y
    small = np.abs(gap) <= 1.0
    loss = np.where(small, 0.5 * gap * gap, np.abs(gap) - 0.5).mean(axis=1)
    return float((loss * weight).sum()), np.clip(gap, -1.0, 1.0) * weight[:, None] / (n * y.shape[1])


def _gradient(w: Weights, x, y, weight, net: Net, rng) -> Weights:
    z, acts, masks = _forward(w, x, net, rng)
    _, delta = _loss(z, y, weight, net)
    grads: Weights = [None] * len(w)
    for i in reversed(range(len(w) // 2)):
        hidden = i < len(w) // 2 - 1
        grads[2 * i] = acts[i].T @ delta + (2.0 * net.l2 * w[2 * i] if hidden else 0.0)
        grads[2 * i + 1] = delta.sum(axis=0)
        if i:
            delta = delta @ w[2 * i].T
            if masks[i - 1] is not None:
                delta = delta * masks[i - 1]
            delta = delta * (acts[i] > 0)
    return grads


@dataclass
class State:
    """Weights with the two Adam moments and the number of steps taken."""

    w: Weights
    m: Weights
    v: Weights
    steps: float = 0.0

    @classmethod
    def fresh(cls, w: Weights) -> State:
        return cls(w, [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w])

    def step(self, grads: Weights, rate: float) -> None:
        self.steps += 1
        for i, g in enumerate(grads):
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            m = self.m[i] / (1 - 0.9**self.steps)
            v = self.v[i] / (1 - 0.999**self.steps)
            self.w[i] = self.w[i] - rate * m / (np.sqrt(v) + 1e-7)


@dataclass
class MlpModel:
    """Weights of the best epoch with the preparation and target scaling they were trained on."""

    net: Net
    prep: Preparation
    targets: list[str]
    target_scale: dict[str, tuple[float, float]] | None
    weights: Weights
    history: list[tuple[int, float, float, float]] = field(default_factory=list)

    def transform(self, df: DataFrame, name: str = "p__{t}") -> DataFrame:
        """Forecasts in original units per target (``prediction`` for one), or the class index."""
        net, weights, n = self.net, self.weights, len(self.targets)
        shared = df.sparkSession.sparkContext.broadcast(weights)

        @F.pandas_udf("array<double>")
        def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for pdf in batches:
                z, _, _ = _forward(shared.value, pdf.to_numpy(dtype=float), net)
                yield pd.Series(list(z))

        columns = [c.alias(f"c{i}") for i, c in enumerate(_prepared(self.prep))]
        out = df.withColumn("_z", forward(F.struct(*columns)))
        if net.task == "class":
            best = (F.array_position("_z", F.array_max("_z")) - 1).cast("int")
            return out.withColumn("prediction", best).drop("_z")
        names = ["prediction"] if n == 1 else [name.format(t=t) for t in self.targets]
        scaled = {}
        for i, (t, new) in enumerate(zip(self.targets, names)):
            mean, spread = self.target_scale[t]
            scaled[new] = F.col("_z")[i] * F.lit(spread) + F.lit(mean)
        return out.withColumns(scaled).drop("_z")

    def losses(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.history, "epoch int, loss double, val_loss double, rate double"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {
            "net": self.net.__dict__ | {"hidden": list(self.net.hidden)}, "prep": self.prep.to_json(),
            "targets": self.targets, "target_scale": self.target_scale,
            "weights": [w.tolist() for w in self.weights],
        }
        table = spark.createDataFrame([(json.dumps(meta),)], "value string")
        table.coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> MlpModel:
        js = json.loads(spark.read.text(path).first()[0])
        net = Net(**(js["net"] | {"hidden": tuple(js["net"]["hidden"])}))
        scale = {k: tuple(v) for k, v in js["target_scale"].items()} if js["target_scale"] else None
        return cls(net, Preparation.from_json(js["prep"]), js["targets"], scale,
                   [np.array(w) for w in js["weights"]])


def _prepared(prep: Preparation):
    """Filled and scaled feature expressions in order."""
    out = []
    for c in prep.features:
        mean, spread = prep.scale[c] if prep.scale else (0.0, 1.0)
        out.append((F.coalesce(col(c).cast("double"), F.lit(prep.fill[c])) - F.lit(mean)) / F.lit(spread))
    return out


@dataclass(frozen=True)
class Labels:
    """What one net learns: the label column of each target, and the column of the training rows' weights."""

    columns: dict[str, str]
    weight: str | None = None


class Course:
    """One net in training: its place in the blocks, its weights and the course of its losses."""

    def __init__(self, net: Net, prep: Preparation, task: Labels, scale, features: Sequence[str], labels: list[str], weights: list[str], n_out: int):
        self.net, self.prep, self.task, self.scale = net, prep, task, scale
        at = {c: i for i, c in enumerate(dict.fromkeys([*features, *labels, *weights]))}
        self.x = np.array([at[c] for c in prep.features], int)
        self.fill = np.array([prep.fill[c] for c in prep.features])
        self.mean, self.spread = (np.array([prep.scale[c][k] for c in prep.features]) for k in (0, 1))
        self.y = np.array([at[c] for c in task.columns.values()], int)
        shift = [scale[t] if scale else (0.0, 1.0) for t in task.columns]
        self.y_mean, self.y_spread = (np.array([p[k] for p in shift]) for k in (0, 1))
        self.weight = at[task.weight] if task.weight else None
        self.state = State.fresh(_start(net, len(self.x), n_out))
        self.rate, self.best, self.best_w, self.since, self.slow = net.rate, np.inf, self.state.w, 0, 0
        self.history: list[tuple[int, float, float, float]] = []
        self.done = False

    def shared(self) -> tuple:
        """What tasks need."""
        return self.x, self.fill, self.mean, self.spread, self.y, self.y_mean, self.y_spread, self.weight, self.state.w

    def sizes(self) -> int:
        return sum(w.size for w in self.state.w) + 4

    def penalty(self) -> float:
        return self.net.l2 * sum(float((w * w).sum()) for w in self.state.w[:-2:2])

    def step(self, total: np.ndarray) -> None:
        """One Adam step along the summed gradient of a mini-batch."""
        n = total[-3]
        if not n:
            return
        grads, at = [], 0
        for i, w in enumerate(self.state.w):
            own = total[at : at + w.size].reshape(w.shape) / n
            hidden = i % 2 == 0 and i < len(self.state.w) - 2
            grads.append(own + 2.0 * self.net.l2 * w if hidden else own)
            at += w.size
        self.state.step(grads, self.rate)

    def course(self) -> tuple:
        """What an epoch changes, as plain values."""
        state = self.state
        return (state.w, state.m, state.v, state.steps), self.rate, self.best, self.best_w, self.since, self.slow, self.history, self.done

    def follow(self, course: tuple) -> None:
        state, self.rate, self.best, self.best_w, self.since, self.slow, self.history, self.done = course
        self.state = State(*state)

    def judge(self, epoch: int, loss: float, val_loss: float) -> None:
        """Keep the best weights, halve the rate without gain, stop without patience."""
        self.history.append((epoch, float(loss), float(val_loss), self.rate))
        if val_loss < self.best:
            self.best, self.best_w, self.since, self.slow = val_loss, list(self.state.w), 0, 0
            return
        self.since, self.slow = self.since + 1, self.slow + 1
        if self.slow >= self.net.slow_after:
            self.rate, self.slow = max(self.rate * 0.5, self.net.least_rate), 0
        self.done = self.since >= self.net.patience

    def model(self) -> MlpModel:
        return MlpModel(self.net, self.prep, list(self.task.columns), self.scale, self.best_w, self.history)


@dataclass
class Blocks:
    """Packed rows by mini-batch, and how many blocks each mini-batch has."""

    df: DataFrame
    counts: dict[int, int]
    steps: int

    @classmethod
    def deal(cls, rows: DataFrame, columns: Sequence[str], net: Net) -> Blocks:
        """Deal staged rows, which have ``_train`` (1 or 0) and ``_key``, to mini-batches, shards and blocks."""
        n = rows.filter("_train = 1").count()
        steps = max(1, min(net.most_steps, math.ceil(n / net.batch)))
        shards = max(1, math.ceil(n / steps / BLOCK_ROWS))
        step = F.when(F.col("_train") == 1, F.pmod("_key", F.lit(steps))).otherwise(VALIDATION).cast("int")
        shard = F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int")
        dealt = rows.select(step.alias("step"), shard.alias("shard"), "_key", *[col(c) for c in columns])
        # rows of one key are equal but for the input's order, so the order within a block is fixed
        dealt = dealt.repartition("step", "shard").sortWithinPartitions("step", "shard", "_key")

        def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, seq, held, size = None, 0, [], 0

            def block():
                data = np.concatenate(held)
                return pa.record_batch([
                    pa.array([own[0]], pa.int32()), pa.array([own[1] * 2**32 + seq], pa.int64()), pa.array([data.tobytes()], pa.binary())],
                    names=["step", "block", "data"])

            for rb in frames:
                if not rb.num_rows:
                    continue
                at, shard = (rb.column(k).to_numpy() for k in (0, 1))
                data = np.column_stack([rb.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(3, rb.num_columns)])
                cuts = np.flatnonzero((at[1:] != at[:-1]) | (shard[1:] != shard[:-1])) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                    if own != (int(at[lo]), int(shard[lo])):
                        if held:
                            yield block()
                        own, seq, held, size = (int(at[lo]), int(shard[lo])), 0, [], 0
                    while lo < hi:
                        part = data[lo : min(hi, lo + BLOCK_ROWS - size)]
                        held.append(part)
                        lo, size = lo + len(part), size + len(part)
                        if size == BLOCK_ROWS:
                            yield block()
                            seq, held, size = seq + 1, [], 0
            if held:
                yield block()

        packed = dealt.mapInArrow(pack, "step INT, block LONG, data BINARY")
        path = fresh_path(rows.sparkSession, "mlp-blocks")
        packed.write.partitionBy("step").parquet(path)
        stored = rows.sparkSession.read.schema("block LONG, data BINARY, step INT").parquet(path)
        counts = {r["step"]: r["count"] for r in stored.groupBy("step").count().collect()}  # a row per mini-batch
        return cls(stored, counts, steps)

    def sums(self, steps: Sequence[int], courses: list[Course], width: int, epoch: int) -> list[np.ndarray]:
        """Per net: the summed gradient of the mini-batches, and loss, rows, and the same of the validation rows.

        The last four numbers are training loss, training rows, validation loss and validation rows.
        """
        count = sum(self.counts.get(s, 0) for s in steps)
        if not count:
            return [np.zeros(c.sizes()) for c in courses]
        spark = self.df.sparkSession
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(([c.net for c in courses], [c.shared() for c in courses])))

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nets, cells = cloudpickle.loads(shared.value)
            for rb in frames:
                for block, data, step in zip(*(rb.column(k).to_pylist() for k in range(3)), strict=True):
                    matrix = np.frombuffer(data).reshape(-1, width)
                    total = np.concatenate([_cell_sums(matrix, n, c, step, [n.seed, epoch, step + 1, block]) for n, c in zip(nets, cells, strict=True)])
                    yield pa.record_batch([
                        pa.array([step], pa.int32()), pa.array([block], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                        names=["step", "block", "sum"])

        parts = self.df.filter(F.col("step").isin(list(steps))).select("block", "data", "step").mapInArrow(run, "step INT, block LONG, sum BINARY")
        while count > FAN:
            count = math.ceil(count / FAN)
            parts = _added(parts, count)
        found = sorted(parts.collect(), key=lambda r: (r["step"], r["block"]))  # at most FAN
        shared.destroy()
        total = sum(np.frombuffer(r["sum"]) for r in found)
        cuts = np.cumsum([c.sizes() for c in courses])
        return np.split(total, cuts[:-1])


def _cell_sums(matrix: np.ndarray, net: Net, cell: tuple, step: int, seed: list[int]) -> np.ndarray:
    at, fill, mean, spread, y_at, y_mean, y_spread, weight_at, w = cell
    y = matrix[:, y_at]
    there = np.isfinite(y).all(axis=1)
    x, y = matrix[there][:, at], (y[there] - y_mean) / y_spread
    x = (np.where(np.isnan(x), fill, x) - mean) / spread
    n, train = len(x), step != VALIDATION
    if not n:
        return np.zeros(sum(v.size for v in w) + 4)
    weight = matrix[there, weight_at] if train and weight_at is not None else np.ones(n)
    loss = _loss(_forward(w, x, net)[0], y, weight, net)[0]
    if not train:
        return np.concatenate([np.zeros(sum(v.size for v in w)), [0.0, 0.0, loss, n]])
    grads = _gradient(w, x, y, weight, replace(net, l2=0.0), np.random.default_rng(seed))
    return np.concatenate([*[g.ravel() * n for g in grads], [loss, n, 0.0, 0.0]])


def _added(parts: DataFrame, groups: int) -> DataFrame:
    """Sums of ``groups`` groups of blocks, each added up in the order of the blocks."""
    def add(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("step", "block", "sum")), strict=True), key=lambda r: r[:2])
        total = sum(np.frombuffer(r[2]) for r in rows)
        return pa.table([pa.array([rows[0][0]], pa.int32()), pa.array([rows[0][1]], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                        names=["step", "block", "sum"])

    grouped = parts.withColumn("g", F.pmod(F.xxhash64("step", "block"), F.lit(groups))).groupBy("g")
    return grouped.applyInArrow(lambda t: add(t.drop_columns(["g"])), "step INT, block LONG, sum BINARY")


def fit_cells(
    train: DataFrame, val: DataFrame, features: Sequence[str], tasks: dict, net: Net = REGRESSION, classes: int = 3, parallel: int = 4,
) -> dict:
    """A net per task, by its name, all trained in the same jobs; each keeps the weights of its best epoch.

    ``tasks`` maps names to :class:`Labels`. A net learns from the rows that have all its labels. Features take the
    training mean where null and are scaled; regression targets are normalised on train.
    """
    labels = list(dict.fromkeys(c for t in tasks.values() for c in t.columns.values()))
    weights = list(dict.fromkeys(t.weight for t in tasks.values() if t.weight))
    keyed = [f.name for f in train.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    key = lambda df: F.xxhash64(*[col(c) for c in keyed if c in df.columns])
    number = lambda c: col(c).cast("double").alias(c)
    rows = [df.select(
        *map(number, dict.fromkeys([*features, *labels])), *[number(w) if w in df.columns else F.lit(1.0).alias(w) for w in weights],
        F.lit(kind).alias("_train"), key(df).alias("_key")) for df, kind in ((train, 1), (val, 0))]
    staged = stage(rows[0].unionByName(rows[1]), "mlp-rows")
    n_out = lambda t: classes if net.task == "class" else len(t.columns)

    def start(task: Labels) -> Course:
        own = staged.filter("_train = 1").dropna(subset=[f"`{c}`" for c in task.columns.values()])
        prep = Preparation.fit(own, features, "mean", scale=True)
        scale = None
        if net.task == "regression":
            found = fit_scale(own, list(task.columns.values()), tiny=1e-6)
            scale = {t: found[c] for t, c in task.columns.items()}
        return Course(net, prep, task, scale, features, labels, weights, n_out(task))

    blocks = Blocks.deal(staged, list(dict.fromkeys([*features, *labels, *weights])), net)
    with ThreadPoolExecutor(parallel) as pool:
        courses = dict(zip(tasks, pool.map(start, tasks.values()), strict=True))
    width = len(dict.fromkeys([*features, *labels, *weights]))
    _train(blocks, list(courses.values()), width, net)
    return {name: c.model() for name, c in courses.items()}


def _epoch(courses: list[Course], epoch: int, steps: int, last: bool, losses: list[list[float]], sums) -> None:
    """Judge the epoch before, unless this is the first, and take the steps of this one, unless all are done.

    ``sums(read, active)`` gives the sums of mini-batches; ``losses`` holds each net's training loss and rows.
    """
    active = [k for k, c in enumerate(courses) if not c.done]
    for step in range(1 if last else steps):
        read = [VALIDATION] if last else [step, VALIDATION] if step == 0 and epoch > 1 else [step]
        totals = sums(read, [courses[k] for k in active])
        if step == 0 and epoch > 1:
            for k, total in zip(active, totals, strict=True):
                c, (loss, n) = courses[k], losses[k]
                trained = loss / max(n, 1) + c.penalty()
                c.judge(epoch - 1, trained, total[-2] / total[-1] + c.penalty() if total[-1] else trained)
                losses[k] = [0.0, 0.0]
        if last:
            return
        for k, total in zip(active, totals, strict=True):
            if not courses[k].done:
                losses[k] = [losses[k][0] + float(total[-4]), losses[k][1] + float(total[-3])]
                courses[k].step(total)
        active = [k for k in active if not courses[k].done]
        if not active:
            return


def _train(blocks: Blocks, courses: list[Course], width: int, net: Net) -> None:
    losses = [[0.0, 0.0] for _ in courses]
    single = max((n for s, n in blocks.counts.items() if s != VALIDATION), default=0) <= 1 and blocks.counts.get(VALIDATION, 0) <= FAN
    rows = sum(n for n in blocks.counts.values()) * BLOCK_ROWS
    together = EPOCHS_HELD if rows * width * 8 <= HELD_BYTES else 1  # a task that can hold the blocks reads them once for some epochs
    epoch = 1
    while epoch <= net.epochs + 1 and not all(c.done for c in courses):
        if single:
            upto = min(epoch + together, net.epochs + 2)
            losses = _epochs_in_a_task(blocks, courses, width, range(epoch, upto), net.epochs, losses)
            epoch = upto
        else:
            _epoch(courses, epoch, blocks.steps, epoch > net.epochs, losses, lambda read, active, e=epoch: blocks.sums(read, active, width, e))
            epoch += 1


def _epochs_in_a_task(blocks: Blocks, courses: list[Course], width: int, epochs: range, last: int, losses: list[list[float]]) -> list[list[float]]:
    """The same epochs taken by one task, which reads block after block; the nets follow."""
    shared = blocks.df.sparkSession.sparkContext.broadcast(cloudpickle.dumps((courses, losses)))
    steps = blocks.steps

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lost = cloudpickle.loads(shared.value)
        stream = (r for rb in frames for r in zip(*(rb.column(k).to_pylist() for k in range(3)), strict=True))
        held = list(stream) if len(epochs) > 1 else stream

        def one(epoch: int) -> None:
            rows = iter(held)
            ahead = [next(rows, None)]

            def sums(read: Sequence[int], active: list[Course]) -> list[np.ndarray]:
                totals = [np.zeros(c.sizes()) for c in active]
                while ahead[0] is not None and ahead[0][2] <= max(read):  # blocks come by step, validation first
                    block, data, step = ahead[0]
                    if step in read:
                        matrix = np.frombuffer(data).reshape(-1, width)
                        totals = [t + _cell_sums(matrix, c.net, c.shared(), step, [c.net.seed, epoch, step + 1, block])
                                  for t, c in zip(totals, active, strict=True)]
                    ahead[0] = next(rows, None)
                return totals

            _epoch(own, epoch, steps, epoch > last, lost, sums)

        for epoch in epochs:
            if not all(c.done for c in own):
                one(epoch)
        for _ in stream:
            pass
        yield pa.record_batch([pa.array([cloudpickle.dumps(([c.course() for c in own], lost))], pa.binary())], names=["left"])

    ordered = blocks.df.coalesce(1).sortWithinPartitions("step", "block")
    (row,) = ordered.mapInArrow(run, "left BINARY").collect()
    shared.destroy()
    left, losses = cloudpickle.loads(row["left"])
    for c, course in zip(courses, left, strict=True):
        c.follow(course)
    return losses


def fit_mlp(
    train: DataFrame, val: DataFrame, features: Sequence[str], labels: dict[str, str],
    net: Net = REGRESSION, classes: int = 3, weight: str | None = None,
) -> MlpModel:
    """Train one net on ``train``, stop early on ``val``; ``labels`` maps each target to its label column."""
    return fit_cells(train, val, features, {0: Labels(labels, weight)}, net, classes)[0]
