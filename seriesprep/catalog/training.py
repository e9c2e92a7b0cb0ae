"""Model fits. Their own scores have no SQL counterpart and are checked by properties in the tests.

Queries with SQL return what it knows of a fit: the rows of each split and cell and the scores of the baseline, and whether the fitted
scores stand where they must. Perceptrons, logistic regression, trees and their grid run with the estimators' defaults; forests and
boosting have fewer trees than these (20 or 10 of 300), so that a run takes seconds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    EDGES, HORIZONS, SIGNALS, SPLIT_SQL, Registry, hourly, hourly_splits, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.catalog.labeling import ahead, left_class, right_class
from seriesprep.functions.scalars import bin_left_closed
from seriesprep.models import estimators as est
from seriesprep.models import mlp, sweep
from seriesprep.operators import anomaly, labels
from seriesprep.plans import forecast
from seriesprep.plans.feature_store import boosting_features, feature_store, tree_features
from seriesprep.sources.hourly import HOURLY
from seriesprep.workspace import fresh_path

registry = Registry()
KEYED = HOURLY.keyed("split")
FEATURES = (*SIGNALS, "hour", "weekday", "click_lag_1", "click_lag_24", "click_ma_3", "click_ma_24")
LAGS = (1, 24)
WINDOWS = (3, 24)


def prepared(spark, folder):
    return tree_features(hourly_with_split(spark, folder), KEYED, "click", LAGS, WINDOWS)


def class_sweep(spark, folder, fit, **options):
    return rounded(sweep.classification_sweep(prepared(spark, folder), HOURLY, "click", FEATURES, fit, EDGES, **options)[0])


def _class_sql(extra: str) -> str:
    """Test rows of each horizon and the scores of the current class; ``extra`` is what the fit must fulfil."""
    cells = " UNION ALL ".join(f"SELECT split, {h} AS horizon, {right_class(ahead('click', h))} AS y, {right_class('click')} AS p FROM splitted" for h in HORIZONS)
    return f"""WITH {SPLIT_SQL}, f AS (SELECT * FROM ({cells}) WHERE split = 'test' AND y IS NOT NULL),
      c AS (SELECT horizon, k, count(*) FILTER (y = k AND p = k) AS tp, count(*) FILTER (y = k) AS s, count(*) FILTER (p = k) AS q
        FROM f, (VALUES (0), (1), (2)) AS ks(k) WHERE p IS NOT NULL GROUP BY ALL),
      b AS (SELECT horizon, CAST(sum(s) AS BIGINT) AS n_baseline, {r6('sum(tp) / sum(s)', 'baseline_acc')},
        {r6('avg(coalesce(2.0 * tp / nullif(q + s, 0), 0))', 'baseline_f1')} FROM c WHERE s + q > 0 GROUP BY horizon)
      SELECT CAST(horizon AS INTEGER) AS horizon, n_test, n_baseline, baseline_acc, baseline_f1, {extra}
      FROM (SELECT horizon, count(*) AS n_test FROM f GROUP BY 1) JOIN b USING (horizon)"""


def _scored(*names: str):
    return F.lit(True) if not names else F.coalesce(F.expr(" AND ".join(f"{n} BETWEEN 0 AND 1" for n in names)), F.lit(False)).alias("scored")


KNOWN = ("horizon", "n_test", "n_baseline", "baseline_acc", "baseline_f1")


@registry("fit_logistic", _class_sql("true AS scored"))
def _(spark, folder):
    return class_sweep(spark, folder, est.fit_logistic, scale=True).select(*KNOWN, _scored("val_acc", "val_f1", "test_acc", "test_f1"))


@registry("fit_tree_classifier", _class_sql("true AS scored"))
def _(spark, folder):
    out = class_sweep(spark, folder, est.fit_tree_classifier, impute="median", refit=False)
    return out.select(*KNOWN, _scored("val_acc", "val_f1", "test_acc", "test_f1"))


@registry("tuned_tree_sweep", _class_sql("true AS scored, true AS best_of_grid"))
def _(spark, folder):
    scores, grid = sweep.tuned_tree_sweep(prepared(spark, folder), HOURLY, "click", FEATURES, EDGES)
    most = grid.groupBy("horizon").agg(F.max("val_acc").alias("most"), F.count(F.lit(1)).alias("cells"), F.count_if("best").alias("chosen"))
    out = rounded(scores.join(most, "horizon").withColumn("best_of_grid", F.expr("val_acc = most AND cells = 16 AND chosen = 1")))
    return out.select(*KNOWN, _scored("val_acc", "test_acc", "test_f1"), "best_of_grid")


@registry("tune_tree")
def _(spark, folder):
    df = labels.label_horizons(prepared(spark, folder), KEYED, ["click"], (1,), EDGES, "y_{h}h").dropna(subset=["y_1h"])
    return rounded(sweep.tune_tree(df, FEATURES, "y_1h", depths=(3, 5), leaves=(10, 30))[1])


@registry("fit_forest_classifier")
def _(spark, folder):
    fit = lambda train, prep, label: est.fit_forest_classifier(train, prep, label, trees=20, depth=10)
    return class_sweep(spark, folder, fit, horizons=(1, 6))


@registry("fit_forest_regressor")
def _(spark, folder):
    fit = lambda train, prep, label: est.fit_forest_regressor(train, prep, label, trees=20, depth=10)
    return rounded(sweep.regression_sweep(prepared(spark, folder), HOURLY, ["click", "error"], FEATURES, fit, (1,))[0])


@registry("fit_gbt_regressor")
def _(spark, folder):
    fit = lambda train, prep, label: est.fit_gbt_regressor(train, prep, label, stages=20)
    return rounded(sweep.regression_sweep(
        prepared(spark, folder), HOURLY, ["click"], FEATURES, fit, (1, 6), impute="median", refit=False, seasonal=True)[0])


@registry("refit_train_val")
def _(spark, folder):
    df = labels.label_single(prepared(spark, folder), KEYED, "click", 1)
    prep = est.Preparation.fit(sweep.rows_of(df, "train"), FEATURES)
    fit = lambda train, prep, label: est.fit_forest_regressor(train, prep, label, trees=10, depth=6)
    model = sweep.refit_train_val(fit, df, prep, "click_target")
    predicted = model.transform(df)
    return predicted.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_predicted"))


@registry("feature_importance")
def _(spark, folder):
    df = labels.label_single(prepared(spark, folder), KEYED, "click", 1)
    train = sweep.rows_of(df, "train")
    prep = est.Preparation.fit(train, FEATURES, "median")
    model = est.fit_gbt_regressor(train, prep, "click_target", stages=10)
    return rounded(model.feature_importance(spark, 10))


@registry("save_load_model")
def _(spark, folder):
    df = labels.label_single(prepared(spark, folder), KEYED, "click", 1)
    train = sweep.rows_of(df, "train")
    model = est.fit_tree_classifier(
        train.withColumn("y", bin_left_closed(F.col("click_target"), EDGES)), est.Preparation.fit(train, FEATURES), "y")
    path = fresh_path(spark, "model")
    model.save(spark, path)
    again = est.Forecaster.load(spark, path)
    return again.transform(df).groupBy("split", "prediction").agg(F.count(F.lit(1)).alias("n"))


@registry("fit_on_order_lines")
def _(spark, folder):
    items = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    late = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    train = items.filter(~late)
    prep = est.Preparation.fit(train, ["l_quantity", "l_discount", "l_tax"], scale=True)
    model = est.fit_gbt_regressor(train, prep, "l_extendedprice", stages=10)
    predicted = model.transform(items.filter(late))
    gap = F.col("l_extendedprice") - F.col("prediction")
    return rounded(predicted.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse")))


QUICK = dict(epochs=15, rate=5e-3, batch=64)


def _regression_sql(labels: str) -> str:
    """Rows and persistence of each split; a perceptron must do better than persistence."""
    return f"""WITH {SPLIT_SQL}, led AS ({labels}), known AS (SELECT * FROM led WHERE y IS NOT NULL AND y_naive IS NOT NULL)
      SELECT *, true AS better FROM (SELECT split, target, horizon, count(*) AS n, {r6('sqrt(avg((y - y_naive) * (y - y_naive)))', 'rmse_naive')} FROM known GROUP BY ALL)"""


def _cell(t: str, h: int) -> str:
    return f"SELECT split, '{t}' AS target, CAST({h} AS INTEGER) AS horizon, {ahead(t, h)} AS y, {t} AS y_naive FROM splitted"


def _better(scores, *keys: str):
    return rounded(scores).select(*keys, "n", "rmse_naive", (F.col("rmse") < F.col("rmse_naive")).alias("better"))


@registry("fit_mlp_regression", _regression_sql(_cell("click", 1)))
def _(spark, folder):
    df = labels.label_regression(prepared(spark, folder), KEYED, "click", 1)
    model = mlp.fit_mlp(sweep.rows_of(df, "train"), sweep.rows_of(df, "val"), FEATURES, {"click": "y"})
    out = _scores(model.transform(df), "y").withColumns({"target": F.lit("click"), "horizon": F.lit(1)})
    return _better(out, "split", "target", "horizon")


@registry("mlp_sweep", _regression_sql(" UNION ALL ".join(_cell(t, h) for t in HOURLY.targets for h in HORIZONS)))
def _(spark, folder):
    scores, _ = sweep.mlp_sweep(prepared(spark, folder), HOURLY, HOURLY.targets, FEATURES)
    return _better(scores, "split", "target", "horizon")


def _multi_sql() -> str:
    led = many(f"{ahead(t, 1)} AS y_{t}" for t in HOURLY.targets)
    keep = " AND ".join(f"y_{t} IS NOT NULL AND {t} IS NOT NULL" for t in HOURLY.targets)
    cells = " UNION ALL ".join(
        f"SELECT split, '{t}' AS target, count(*) AS n, {r6(f'sqrt(avg((y_{t} - {t}) * (y_{t} - {t})))', 'rmse_naive')} FROM known GROUP BY split" for t in HOURLY.targets)
    return f"WITH {SPLIT_SQL}, led AS (SELECT *, {led} FROM splitted), known AS (SELECT * FROM led WHERE {keep}) SELECT *, true AS better FROM ({cells})"


@registry("fit_mlp_multi", _multi_sql())
def _(spark, folder):
    df = labels.label_multi(prepared(spark, folder), KEYED, HOURLY.targets, 1)
    model = mlp.fit_mlp(
        sweep.rows_of(df, "train"), sweep.rows_of(df, "val"), FEATURES, {t: f"y__{t}" for t in HOURLY.targets}, mlp.MULTI)
    long = model.transform(df).select("split", F.explode(F.array(*[F.struct(
        F.lit(t).alias("target"), F.col(f"y__{t}").alias("y"), F.col(f"p__{t}").alias("prediction"), F.col(f"y_naive__{t}").alias("y_naive"))
        for t in HOURLY.targets])).alias("_c")).select("split", "_c.*")
    gap, naive = F.col("y") - F.col("prediction"), F.col("y") - F.col("y_naive")
    return _better(long.groupBy("split", "target").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.sqrt(F.avg(naive * naive)).alias("rmse_naive")), "split", "target")


@registry("fit_mlp_class", f"""WITH {SPLIT_SQL}, led AS (SELECT split, {left_class('click')} AS p, {left_class(ahead('click', 1))} AS y FROM splitted)
    SELECT split, count(*) AS n, true AS scored FROM led WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY split""")
def _(spark, folder):
    df = labels.label_class(prepared(spark, folder), KEYED, "click", 1, EDGES)
    train = sweep.rows_of(df, "train")
    weighted = labels.with_class_weights(train, labels.class_weights(train))
    model = mlp.fit_mlp(weighted, sweep.rows_of(df, "val"), FEATURES, {"click": "y"}, mlp.CLASSES, weight="weight")
    hit = (F.col("y") == F.col("prediction")).cast("int")
    return model.transform(df).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")).select("split", "n", _scored("accuracy"))


def _scores(predicted, y):
    gap = F.col(y) - F.col("prediction")
    naive = F.col(y) - F.col("y_naive")
    return rounded(predicted.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.sqrt(F.avg(naive * naive)).alias("rmse_naive")))


@registry("forecast_sweep")
def _(spark, folder):
    df, features = boosting_features(hourly_with_split(spark, folder), KEYED, HOURLY.targets)
    kept = anomaly.anomaly_filter(anomaly.anomaly_flags(hourly_with_split(spark, folder), HOURLY, HOURLY.features, isolation=False))
    clean, _ = boosting_features(kept.select("ts", "split", *SIGNALS), KEYED, HOURLY.targets)
    fit = lambda train, prep, label: est.fit_gbt_regressor(train, prep, label, stages=10)
    return rounded(sweep.forecast_sweep(
        {"vanilla": df, "clean": clean}, HOURLY, ["click"], features, fit, (1,), "median", refit=False, seasonal=True))


@registry("train_and_evaluate")
def _(spark, folder):
    df = feature_store(hourly(spark, folder), HOURLY, max_lag=3, roll=(3, 24), spans=(6,))
    splits = hourly_splits(df, purge_hours=24)
    task = forecast.Task("multi", ("click", "error"), 1)
    model, _ = forecast.train(df, HOURLY, splits, task, mlp.Net(**QUICK))
    path = fresh_path(spark, "mlp")
    model.save(spark, path)
    scores, _ = forecast.evaluate(mlp.MlpModel.load(spark, path), df, HOURLY, splits, task)
    return rounded(scores)
