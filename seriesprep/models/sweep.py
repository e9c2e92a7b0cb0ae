"""One model per (target, horizon) cell: tuning on validation, refit on train and val, score tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.scalars import bin_right_closed, col
from seriesprep.metrics import compare_datasets, macro_scores, rmse_finite
from seriesprep.models import estimators, mlp
from seriesprep.models.estimators import Forecaster, Preparation
from seriesprep.operators.labels import HORIZONS, baseline_seasonal, label_horizons
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import stage

Fit = Callable[[DataFrame, Preparation, str], Forecaster]


def rows_of(df: DataFrame, *names: str, split: str = "split") -> DataFrame:
    return df.filter(col(split).isin(*names))


def refit_train_val(fit: Fit, labeled: DataFrame, prep: Preparation, label: str, split: str = "split") -> Forecaster:
    """Fit again on train and validation; the preparation stays the one fitted on train."""
    return fit(rows_of(labeled, "train", "val", split=split), prep, label)


def tune_tree(
    labeled: DataFrame, features: Sequence[str], label: str, depths: Sequence[int] = (5, 7, 9, 11),
    leaves: Sequence[int] = (10, 20, 30, 50), seed: int = 42, split: str = "split",
) -> tuple[tuple[int, int], DataFrame]:
    """Grid search scored on the validation split, never on a random part; first best wins.

    Returns the best (depth, leaf) and the table of all scores.
    """
    train, val = rows_of(labeled, "train", split=split), rows_of(labeled, "val", split=split)
    prep = Preparation.fit(train, features, "median")
    cells = [(d, leaf) for d in depths for leaf in leaves]

    def score(cell: tuple[int, int]) -> float:
        model = estimators.fit_tree_classifier(train, prep, label, *cell, seed=seed)
        hit = (col("prediction") == col(label)).cast("int")
        return model.transform(val).agg(F.avg(hit)).first()[0]

    with ThreadPoolExecutor(4) as pool:
        scores = list(pool.map(score, cells))
    best, best_score = cells[0], -1.0
    for cell, s in zip(cells, scores):
        if s is not None and s > best_score:
            best, best_score = cell, s
    rows = [(d, leaf, s, (d, leaf) == best) for (d, leaf), s in zip(cells, scores)]
    table = labeled.sparkSession.createDataFrame(rows, "depth int, leaf int, val_acc double, best boolean")
    return best, table


@dataclass
class Cell:
    """The outcome of one (target, horizon): the row of the result table and the test forecasts."""

    row: dict
    model: Forecaster
    predictions: DataFrame


def regression_sweep(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], features: Sequence[str], fit: Fit,
    horizons: Sequence[int] = HORIZONS, impute: str = "mean", refit: bool = True, parallel: int = 4,
    seasonal: bool = False, split: str = "split",
) -> tuple[DataFrame, dict[tuple[str, int], Cell]]:
    """One regressor per target and horizon; cells with an empty split are skipped.

    All labels come from one window pass, staged once. ``refit`` fits again on train and
    validation before scoring test. The baseline uses the rows that have a current value, and
    both row counts are reported. ``seasonal`` adds the RMSE of the value 24 rows ago.
    """
    name = "{t}_tplus_{h}"
    labeled = stage(label_horizons(df, spec.keyed(split), targets, horizons, name=name), "labeled")
    season = _seasonal_scores(labeled, spec, targets, horizons, split) if seasonal else {}

    def run(target: str, h: int) -> Cell | None:
        label = name.format(t=target, h=h)
        rows = labeled.filter(col(label).isNotNull())
        sizes = {r[split]: r["count"] for r in rows.groupBy(split).count().collect()}
        if not all(sizes.get(s) for s in ("train", "val", "test")):
            return None
        train = rows_of(rows, "train", split=split)
        prep = Preparation.fit(train, features, impute)
        model = fit(train, prep, label)
        rmse_val = _rmse(model.transform(rows_of(rows, "val", split=split)), label)[0]
        if refit:
            model = refit_train_val(fit, rows, prep, label, split)
        predicted = model.transform(rows_of(rows, "test", split=split))
        rmse_test, n_test = _rmse(predicted, label)
        baseline, n_baseline = _rmse(predicted, label, target)
        row = {
            "target": target, "horizon": h, "rmse_val": rmse_val, "rmse_test": rmse_test,
            "baseline_rmse": baseline, "n_test": n_test, "n_baseline": n_baseline,
            "rmse_season": season.get((target, h)),
        }
        forecasts = predicted.select(
            *spec.by, col(spec.ts), F.lit(target).alias("target"), F.lit(h).alias("horizon"),
            col(label).alias("y_true"), "prediction", col(target).alias("y_naive"),
        )
        return Cell(row, model, forecasts)

    cells = _run_cells(run, [(t, h) for t in targets for h in horizons], parallel)
    schema = (
        "target string, horizon int, rmse_val double, rmse_test double, baseline_rmse double, "
        "n_test long, n_baseline long, rmse_season double"
    )
    return _result_table(df, cells, schema), cells


def forecast_sweep(datasets: dict[str, DataFrame], *args, **options) -> DataFrame:
    """The regression sweep on several versions of the data, for example with and without anomalies."""
    return compare_datasets({name: regression_sweep(df, *args, **options)[0] for name, df in datasets.items()})


def _seasonal_scores(labeled, spec, targets, horizons, split) -> dict[tuple[str, int], float]:
    keyed = spec.keyed(split)
    scores = baseline_seasonal(labeled, keyed, targets, horizons, group=[split])
    return {(r["target"], r["horizon"]): r["rmse"] for r in rows_of(scores, "test", split=split).collect()}


def _rmse(df: DataFrame, y: str, p: str = "prediction") -> tuple[float | None, int]:
    row = rmse_finite(df, y, p).first()
    return row["rmse"], row["n"]


def classification_sweep(
    df: DataFrame, spec: SeriesSpec, target: str, features: Sequence[str], fit: Fit,
    edges: Sequence[float], horizons: Sequence[int] = HORIZONS, impute: str = "mean", scale: bool = False,
    refit: bool = True, refit_prep: bool = False, parallel: int = 4, split: str = "split",
) -> tuple[DataFrame, dict[tuple[str, int], Cell]]:
    """One classifier of the future class per horizon, with the current class as baseline.

    ``refit_prep`` fits imputation and scaling again together with the final model.
    """
    name = "y_{h}h"
    labeled = label_horizons(df, spec.keyed(split), [target], horizons, edges, name)
    labeled = stage(labeled.withColumn("y_now", bin_right_closed(col(target), edges)), "labeled")

    def run(target: str, h: int) -> Cell | None:
        label = name.format(h=h)
        rows = labeled.filter(col(label).isNotNull())
        sizes = {r[split]: r["count"] for r in rows.groupBy(split).count().collect()}
        if not all(sizes.get(s) for s in ("train", "val", "test")):
            return None
        train = rows_of(rows, "train", split=split)
        prep = Preparation.fit(train, features, impute, scale)
        model = fit(train, prep, label)
        val = macro_scores(_as_int(model.transform(rows_of(rows, "val", split=split))), label, "prediction").first()
        if refit:
            if refit_prep:
                prep = Preparation.fit(rows_of(rows, "train", "val", split=split), features, impute, scale)
            model = refit_train_val(fit, rows, prep, label, split)
        predicted = _as_int(model.transform(rows_of(rows, "test", split=split)))
        test = macro_scores(predicted, label, "prediction").first()
        base = macro_scores(predicted.dropna(subset=["y_now"]), label, "y_now").first()
        row = {
            "horizon": h, "val_acc": val["accuracy"], "val_f1": val["macro_f1"],
            "test_acc": test["accuracy"], "test_f1": test["macro_f1"],
            "baseline_acc": base["accuracy"] if base["n"] else None,
            "baseline_f1": base["macro_f1"] if base["n"] else None,
            "n_test": test["n"], "n_baseline": base["n"] or 0,
        }
        forecasts = predicted.select(
            *spec.by, col(spec.ts), F.lit(h).alias("horizon"), col(label).alias("y"), "prediction", "y_now",
        )
        return Cell(row, model, forecasts)

    cells = _run_cells(run, [(target, h) for h in horizons], parallel)
    schema = (
        "horizon int, val_acc double, val_f1 double, test_acc double, test_f1 double, "
        "baseline_acc double, baseline_f1 double, n_test long, n_baseline long"
    )
    return _result_table(df, cells, schema), cells


def tuned_tree_sweep(
    df: DataFrame, spec: SeriesSpec, target: str, features: Sequence[str], edges: Sequence[float], horizons: Sequence[int] = HORIZONS,
    depths: Sequence[int] = (5, 7, 9, 11), leaves: Sequence[int] = (10, 20, 30, 50), seed: int = 42, parallel: int = 4, split: str = "split",
) -> tuple[DataFrame, DataFrame]:
    """Per horizon: a tree tuned on validation, fitted again on train and validation, scored on test next to the current class.

    A horizon's rows are prepared (fill values of train) and staged once for all its fits, and the validation rows
    meet all trees of the grid in one job. Of equal accuracies the first of the grid wins. Returns the scores and the grid.
    """
    name = "y_{h}h"
    labeled = label_horizons(df, spec.keyed(split), [target], horizons, edges, name)
    labeled = stage(labeled.withColumn("y_now", bin_right_closed(col(target), edges)), "labeled")
    grid = [(d, leaf) for d in depths for leaf in leaves]

    def run(h: int) -> tuple[tuple, list[tuple]] | None:
        label = name.format(h=h)
        rows = labeled.filter(col(label).isNotNull())
        sizes = {r[split]: r["count"] for r in rows.groupBy(split).count().collect()}
        if not all(sizes.get(s) for s in ("train", "val", "test")):
            return None
        prep = Preparation.fit(rows_of(rows, "train", split=split), features, "median")
        ready = stage(prep.transform(rows).select(col(split).alias(split), "features", col(label).cast("double").alias("label"), "y_now"), "prepared")
        train, val = rows_of(ready, "train", split=split), rows_of(ready, "val", split=split)

        def fit(cell: tuple[int, int], data: DataFrame, p: str):
            return estimators.tree_classifier(*cell, seed=seed).setPredictionCol(p).setProbabilityCol("").setRawPredictionCol("").fit(data)

        with ThreadPoolExecutor(parallel) as pool:
            models = list(pool.map(lambda k: fit(grid[k], train, f"p{k}"), range(len(grid))))
        judged = val
        for m in models:
            judged = m.transform(judged)
        hits = judged.agg(*[F.avg((F.col(f"p{k}") == F.col("label")).cast("int")).alias(f"p{k}") for k in range(len(grid))]).first()
        best = max(range(len(grid)), key=lambda k: (hits[k], -k))
        final = fit(grid[best], rows_of(ready, "train", "val", split=split), "prediction")
        predicted = _as_int(final.transform(rows_of(ready, "test", split=split))).withColumn("label", col("label").cast("int"))
        test = macro_scores(predicted, "label", "prediction").first()
        base = macro_scores(predicted.dropna(subset=["y_now"]), "label", "y_now").first()
        row = (h, *grid[best], hits[best], test["accuracy"], test["macro_f1"], base["accuracy"] if base["n"] else None,
               base["macro_f1"] if base["n"] else None, test["n"], base["n"] or 0)
        return row, [(h, *cell, hits[k], k == best) for k, cell in enumerate(grid)]

    done = [r for r in map(run, horizons) if r is not None]
    spark = df.sparkSession
    scores = spark.createDataFrame([r for r, _ in done], (
        "horizon int, depth int, leaf int, val_acc double, test_acc double, test_f1 double, baseline_acc double, baseline_f1 double, "
        "n_test long, n_baseline long"))
    cells = spark.createDataFrame([c for _, cs in done for c in cs], "horizon int, depth int, leaf int, val_acc double, best boolean")
    return scores, cells


def mlp_sweep(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], features: Sequence[str], horizons: Sequence[int] = HORIZONS,
    net: mlp.Net = mlp.REGRESSION, split: str = "split",
) -> tuple[DataFrame, dict[tuple[str, int], mlp.MlpModel]]:
    """A perceptron per target and horizon, all trained in the same jobs, with their scores by split next to persistence.

    Each cell learns from the rows that have its label and its current value. Cells with an empty split are skipped.
    """
    name = "{t}_tplus_{h}"
    labeled = stage(label_horizons(df, spec.keyed(split), targets, horizons, name=name), "labeled")
    cells = [(t, h) for t in targets for h in horizons]
    label = {c: name.format(t=c[0], h=c[1]) for c in cells}
    known = {c: col(label[c]).isNotNull() & col(c[0]).isNotNull() for c in cells}
    sizes = labeled.groupBy(split).agg(*[F.count_if(known[c]).alias(f"_{k}") for k, c in enumerate(cells)]).collect()
    have = {r[split]: r for r in sizes}
    cells = [c for k, c in enumerate(cells) if all(s in have and have[s][f"_{k}"] for s in ("train", "val", "test"))]
    # a label counts where the current value is known
    usable = labeled.withColumns({label[c]: F.when(known[c], col(label[c])) for c in cells})
    models = mlp.fit_cells(rows_of(usable, "train", split=split), rows_of(usable, "val", split=split), features,
                           {c: mlp.Labels({c[0]: label[c]}) for c in cells}, net)
    scored = rows_of(usable, "train", "val", "test", split=split)
    for k, c in enumerate(cells):
        scored = models[c].transform(scored).withColumnRenamed("prediction", f"_p{k}")
    long = scored.select(col(split).alias("split"), F.explode(F.array(*[F.struct(
        F.lit(t).alias("target"), F.lit(h).alias("horizon"), col(label[t, h]).alias("y"), F.when(col(label[t, h]).isNotNull(), F.col(f"_p{k}")).alias("p"),
        col(t).cast("double").alias("now")) for k, (t, h) in enumerate(cells)])).alias("_c")).select("split", "_c.*").filter("y IS NOT NULL")
    gap, naive = F.col("y") - F.col("p"), F.col("y") - F.col("now")
    return long.groupBy("split", "target", "horizon").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.sqrt(F.avg(naive * naive)).alias("rmse_naive")), models


def _as_int(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", col("prediction").cast("int"))


def _run_cells(run, keys, parallel: int) -> dict[tuple[str, int], Cell]:
    """Fit several cells at a time; each is a series of Spark jobs."""
    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(lambda k: run(*k), keys))
    return {k: c for k, c in zip(keys, done) if c is not None}


def _result_table(df: DataFrame, cells: dict[tuple[str, int], Cell], schema: str) -> DataFrame:
    names = T.StructType.fromDDL(schema).fieldNames()
    return df.sparkSession.createDataFrame([tuple(c.row[n] for n in names) for c in cells.values()], schema)
