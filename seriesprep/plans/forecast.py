"""Training and scoring runs over one table and its splits: slice, purge, label, fit, compare with naive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep import metrics
from seriesprep.functions.scalars import col
from seriesprep.models import mlp
from seriesprep.operators import labels
from seriesprep.operators.cleaning import feature_columns
from seriesprep.operators.splits import Splits, split_rows
from seriesprep.spec import SeriesSpec


@dataclass(frozen=True)
class Task:
    """What to forecast: one value, several values, or the class of one value."""

    kind: str
    targets: tuple[str, ...]
    horizon: int
    edges: tuple[float, ...] = labels.CO_EDGES

    def label(self, df: DataFrame, spec: SeriesSpec, scoring: bool = False) -> DataFrame:
        """Labels inside each split; scoring several targets keeps rows without a current value."""
        keyed = spec.keyed("split")
        if self.kind == "regression":
            return labels.label_regression(df, keyed, self.targets[0], self.horizon)
        if self.kind == "multi":
            return labels.label_multi(df, keyed, self.targets, self.horizon, require_current=not scoring)
        if self.kind == "class":
            return labels.label_class(df, keyed, self.targets[0], self.horizon, self.edges)
        raise ValueError(f"unknown task {self.kind!r}")

    @property
    def label_columns(self) -> dict[str, str]:
        if self.kind == "multi":
            return {t: f"y__{t}" for t in self.targets}
        return {self.targets[0]: "y"}

    @property
    def net(self) -> mlp.Net:
        return {"regression": mlp.REGRESSION, "multi": mlp.MULTI, "class": mlp.CLASSES}[self.kind]


def train(
    df: DataFrame, spec: SeriesSpec, splits: Splits, task: Task, net: mlp.Net | None = None,
    tokens: Sequence[str] | None = None,
) -> tuple[mlp.MlpModel, DataFrame]:
    """Fit a perceptron on train (purged), stop on val; returns it with the scores per split."""
    rows = split_rows(df, spec, splits, exclude_purge=True)
    features = feature_columns(df, [spec.ts, *spec.by, *spec.tiebreak], tokens)
    labeled = task.label(rows, spec)
    fit_on = labeled.filter(F.col("split") == "train")
    weight = None
    if task.kind == "class":
        classes = len(task.edges) + 1
        fit_on = labels.with_class_weights(fit_on, labels.class_weights(fit_on, "y", classes))
        weight = "weight"
    model = mlp.fit_mlp(
        fit_on, labeled.filter(F.col("split") == "val"), features, task.label_columns,
        net or task.net, classes=len(task.edges) + 1, weight=weight,
    )
    return model, scores(model.transform(labeled), task, ["split"])


def evaluate(
    model, df: DataFrame, spec: SeriesSpec, splits: Splits, task: Task, split: str = "test"
) -> tuple[DataFrame, DataFrame]:
    """Scores and forecasts of a saved model on one split, next to the naive forecast."""
    rows = split_rows(df, spec, splits, exclude_purge=False).filter(F.col("split") == split)
    missing = [c for c in model.prep.features if c not in rows.columns]
    if missing:
        raise ValueError(f"{len(missing)} features of the model are missing, e.g. {missing[:5]}")
    predicted = model.transform(task.label(rows, spec, scoring=True))
    return scores(predicted, task, ["split"]), predictions(predicted, spec, task)


def scores(predicted: DataFrame, task: Task, group: Sequence[str] = ()) -> DataFrame:
    """(group, target, forecast, score columns): the model and the naive forecast side by side."""
    if task.kind == "class":
        both = F.array(*[
            F.struct(F.lit(n).alias("forecast"), col(c).cast("int").alias("p"))
            for n, c in (("model", "prediction"), ("naive", "y_naive"))
        ])
        long = predicted.select(*group, "y", F.explode(both).alias("_f")).select(*group, "y", "_f.*")
        return metrics.macro_scores(long, group=[*group, "forecast"])
    cells = []
    for t, y in task.label_columns.items():
        model = "prediction" if len(task.label_columns) == 1 else f"p__{t}"
        naive = "y_naive" if task.kind == "regression" else f"y_naive__{t}"
        for n, c in (("model", model), ("naive", naive)):
            cells.append(F.struct(
                F.lit(t).alias("target"), F.lit(n).alias("forecast"), col(y).alias("y_true"), col(c).alias("y_pred")))
    long = predicted.select(*group, F.explode(F.array(*cells)).alias("_f")).select(*group, "_f.*")
    per_target = metrics.rmse_finite(long, group=[*group, "target", "forecast"])
    if task.kind == "regression":
        return per_target
    macro = metrics.macro_rmse(per_target, [*group, "forecast"]).select(
        *group, F.lit("macro").alias("target"), "forecast", F.lit(None).cast("long").alias("n"),
        F.col("macro_rmse").alias("rmse"))
    return per_target.unionByName(macro)


def predictions(predicted: DataFrame, spec: SeriesSpec, task: Task) -> DataFrame:
    """The forecast table: wide for one target, long for several, classes as integers."""
    if task.kind == "regression":
        return metrics.prediction_table(predicted, spec.ts, keys=spec.by)
    if task.kind == "class":
        return metrics.prediction_table_class(predicted, spec.ts, keys=spec.by)
    single = len(task.targets) == 1
    return metrics.prediction_table_long(
        predicted, spec.ts, task.targets, p="prediction" if single else "p__{t}", keys=spec.by)
