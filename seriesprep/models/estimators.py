"""Spark ML estimators with the settings of the forecasting study, and the fitted preparation.

A :class:`Preparation` (imputation and scaling fitted on train) plus a Spark ML model make a
:class:`Forecaster`. Trees split on binned values (``max_bins``), so they agree with
exact-split libraries in kind, not bit for bit.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col
from seriesprep.operators.impute import fit_means, fit_medians, impute_saved
from seriesprep.operators.labels import apply_scale, fit_scale
from seriesprep.spec import safe_names

DEEPEST = 30  # the deepest tree Spark ML grows; stands in for "unlimited"


@dataclass
class Preparation:
    """Fill values and scaling per feature. Features without any training value are left out."""

    features: list[str]
    fill: dict[str, float]
    scale: dict[str, tuple[float, float]] | None = None
    dropped: list[str] = field(default_factory=list)

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str], impute: str = "mean", scale: bool = False):
        fill = {"mean": fit_means, "median": fit_medians}[impute](train, features)
        usable = [c for c in features if c in fill]
        params = fit_scale(impute_saved(train, fill), usable) if scale else None
        return cls(usable, fill, params, [c for c in features if c not in fill])

    def transform(self, df: DataFrame) -> DataFrame:
        """Filled and scaled copies of the features as one vector column ``features``."""
        safe = safe_names(self.features)
        inputs = {c: f"_x_{s}" for c, s in safe.items()}
        work = df.withColumns({x: col(c).cast("double") for c, x in inputs.items()})
        work = impute_saved(work, {inputs[c]: v for c, v in self.fill.items() if c in inputs})
        if self.scale:
            work = apply_scale(work, {inputs[c]: v for c, v in self.scale.items()})
        assembler = VectorAssembler(inputCols=list(inputs.values()), outputCol="features")
        return assembler.transform(work).drop(*inputs.values())

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "fill": self.fill, "scale": self.scale, "dropped": self.dropped})

    @classmethod
    def from_json(cls, text: str) -> Preparation:
        js = json.loads(text)
        scale = {k: tuple(v) for k, v in js["scale"].items()} if js["scale"] else None
        return cls(js["features"], js["fill"], scale, js.get("dropped", []))


@dataclass
class Forecaster:
    """Preparation and model; ``transform`` adds ``prediction``."""

    prep: Preparation
    model: Model

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(self.prep.transform(df))
        return out.drop("features", "rawPrediction", "probability")

    def feature_importance(self, spark: SparkSession, top: int | None = 10) -> DataFrame:
        """Importance per feature, largest first; one row per feature."""
        values = self.model.featureImportances.toArray()
        rows = [(f, float(v)) for f, v in zip(self.prep.features, values)]
        table = spark.createDataFrame(rows, "feature string, importance double")
        table = table.orderBy(F.desc("importance"), "feature")
        return table.limit(top) if top else table

    def save(self, spark: SparkSession, path: str) -> None:
        PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        meta = spark.createDataFrame([(self.prep.to_json(),)], "value string")
        meta.coalesce(1).write.mode("overwrite").text(f"{path}/prep")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forecaster:
        model = PipelineModel.load(f"{path}/model").stages[0]
        return cls(Preparation.from_json(spark.read.text(f"{path}/prep").first()[0]), model)


def _fit(estimator, prep: Preparation, train: DataFrame, label: str) -> Forecaster:
    rows = prep.transform(train).select("features", col(label).cast("double").alias("label"))
    return Forecaster(prep, estimator.setFeaturesCol("features").setLabelCol("label").fit(rows))


def fit_logistic(train: DataFrame, prep: Preparation, label: str = "y", max_iter: int = 1000, c: float = 1.0) -> Forecaster:
    """Multinomial logistic regression with an L2 penalty of ``1/c`` on the summed loss."""
    n = train.filter(col(label).isNotNull()).count()
    lr = LogisticRegression(
        family="multinomial", maxIter=max_iter, regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0,
        standardization=False,
    )
    return _fit(lr, prep, train, label)


def tree_classifier(depth: int = 7, leaf: int = 30, seed: int = 42, max_bins: int = 128) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, seed=seed, maxBins=max_bins, maxMemoryInMB=512)


def fit_tree_classifier(train: DataFrame, prep: Preparation, label: str = "y", depth: int = 7, leaf: int = 30,
                        seed: int = 42, max_bins: int = 128) -> Forecaster:
    return _fit(tree_classifier(depth, leaf, seed, max_bins), prep, train, label)


def fit_forest_classifier(train: DataFrame, prep: Preparation, label: str = "y", trees: int = 300,
                          depth: int = DEEPEST, seed: int = 42, max_bins: int = 128) -> Forecaster:
    return _fit(RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, maxBins=max_bins, maxMemoryInMB=512,
    ), prep, train, label)


def fit_forest_regressor(train: DataFrame, prep: Preparation, label: str = "y", trees: int = 300,
                         depth: int = DEEPEST, seed: int = 0, max_bins: int = 128) -> Forecaster:
    return _fit(RandomForestRegressor(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed, maxBins=max_bins, maxMemoryInMB=512,
    ), prep, train, label)


def fit_gbt_regressor(train: DataFrame, prep: Preparation, label: str = "y", stages: int = 300, rate: float = 0.05,
                      depth: int = 3, subsample: float = 0.9, seed: int = 42, max_bins: int = 128) -> Forecaster:
    return _fit(GBTRegressor(
        maxIter=stages, stepSize=rate, maxDepth=depth, subsamplingRate=subsample, minInstancesPerNode=2,
        seed=seed, maxBins=max_bins, maxMemoryInMB=512,
    ), prep, train, label)
