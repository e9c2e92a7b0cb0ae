"""Estimators by their properties: planted signals are found, planted outliers flagged."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SPEC
from seriesprep.models import estimators as est
from seriesprep.models import mlp, sweep
from seriesprep.models.isolation import IsolationForest
from seriesprep.operators import anomaly, labels
from seriesprep.spec import SeriesSpec

SERIES = SeriesSpec(ts="ts", targets=("v",), features=("s",), layout="direct")
FEATURES = ["v", "s", "hour"]


@pytest.fixture(scope="module")
def frame(spark):
    """A daily wave whose next value is announced by the feature ``s``."""
    rng = np.random.default_rng(4)
    n = 700
    noise = rng.normal(0, 3, n + 1)
    v = 10 + 4 * np.sin(np.arange(n + 1) * 2 * np.pi / 24) + noise
    rows = [
        (datetime(2024, 1, 1) + timedelta(hours=i), float(v[i]), None if i % 17 == 0 else float(v[i + 1] + rng.normal(0, 0.3)),
         i % 24, "train" if i < 480 else "val" if i < 590 else "test")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, v double, s double, hour int, split string").repartition(3).cache()


@pytest.mark.parametrize("fit", [
    lambda t, p, y: est.fit_forest_regressor(t, p, y, trees=5, depth=6),
    lambda t, p, y: est.fit_gbt_regressor(t, p, y, stages=15, rate=0.3),
])
def test_regressors_beat_persistence(frame, fit):
    table, cells = sweep.regression_sweep(frame, SERIES, ["v"], FEATURES, fit, (1,), seasonal=True)
    (row,) = table.collect()
    assert row["rmse_test"] < 0.6 * row["baseline_rmse"] and row["rmse_season"] > row["rmse_test"]
    assert row["n_test"] == row["n_baseline"] == 109
    top = cells["v", 1].model.feature_importance(frame.sparkSession, 2).collect()
    assert top[0]["feature"] == "s" and len(top) == 2


@pytest.mark.parametrize("fit,scale", [
    (lambda t, p, y: est.fit_logistic(t, p, y, max_iter=50), True),
    (lambda t, p, y: est.fit_tree_classifier(t, p, y, depth=5, leaf=5), False),
    (lambda t, p, y: est.fit_forest_classifier(t, p, y, trees=8, depth=6), False),
])
def test_classifiers_beat_persistence(frame, fit, scale):
    table, _ = sweep.classification_sweep(frame, SERIES, "v", FEATURES, fit, (8.0, 12.0), (1,), scale=scale)
    (row,) = table.collect()
    assert row["test_acc"] > row["baseline_acc"] + 0.1 and row["test_f1"] > row["baseline_f1"]


def test_tuning_keeps_the_first_best(frame):
    df = labels.label_horizons(frame, SERIES.keyed("split"), ["v"], (1,), (8.0, 12.0), "y_{h}").dropna(subset=["y_1"])
    best, table = sweep.tune_tree(df, FEATURES, "y_1", (2, 4), (5, 10))
    rows = table.collect()
    top = max(r["val_acc"] for r in rows)
    assert best == next((r["depth"], r["leaf"]) for r in rows if r["val_acc"] == top)
    assert sum(r["best"] for r in rows) == 1


def test_tuned_trees_are_fitted_again_and_scored(frame):
    scores, grid = sweep.tuned_tree_sweep(frame, SERIES, "v", FEATURES, (8.0, 12.0), (1, 109, 110), (2, 4), (5, 10))
    rows, cells = scores.collect(), grid.collect()
    assert [r["horizon"] for r in rows] == [1, 109]
    for r in rows:
        own = [c for c in cells if c["horizon"] == r["horizon"]]
        assert len(own) == 4 and sum(c["best"] for c in own) == 1
        best = max(own, key=lambda c: c["val_acc"])  # the first of the best
        assert best["best"] and (r["depth"], r["leaf"], r["val_acc"]) == (best["depth"], best["leaf"], best["val_acc"])
    assert rows[0]["test_acc"] > rows[0]["baseline_acc"] + 0.1 and rows[0]["n_test"] == rows[0]["n_baseline"] == 109
    # the same tree as the plain steps give: tuned on validation, fitted again on train and validation
    df = labels.label_horizons(frame, SERIES.keyed("split"), ["v"], (1,), (8.0, 12.0), "y_{h}").dropna(subset=["y_1"])
    (depth, leaf), _ = sweep.tune_tree(df, FEATURES, "y_1", (2, 4), (5, 10))
    prep = est.Preparation.fit(sweep.rows_of(df, "train"), FEATURES, "median")
    model = sweep.refit_train_val(lambda t, p, y: est.fit_tree_classifier(t, p, y, depth, leaf), df, prep, "y_1")
    hit = (F.col("prediction") == F.col("y_1")).cast("int")
    assert rows[0]["test_acc"] == pytest.approx(model.transform(sweep.rows_of(df, "test")).agg(F.avg(hit)).first()[0])


def test_perceptrons_of_a_sweep_beat_persistence(frame):
    net = mlp.Net(hidden=(16,), dropout=0.0, rate=0.01, batch=64, epochs=30)
    scores, models = sweep.mlp_sweep(frame, SERIES, ["v"], FEATURES, (1, 6, 110), net)
    rows = {(r["split"], r["horizon"]): r for r in scores.collect()}
    assert set(models) == {("v", 1), ("v", 6)} and len(rows) == 6
    assert rows["test", 1]["rmse"] < 0.7 * rows["test", 1]["rmse_naive"] and rows["test", 1]["n"] == 109
    assert rows["test", 6]["n"] == 104


def test_a_cell_with_an_empty_split_is_skipped(frame):
    fit = lambda t, p, y: est.fit_tree_classifier(t, p, y, depth=2, leaf=5)
    table, _ = sweep.classification_sweep(frame, SERIES, "v", FEATURES, fit, (8.0, 12.0), (1, 109, 110))
    assert [r["horizon"] for r in table.collect()] == [1, 109]


def test_preparation(frame, spark, tmp_path):
    train = frame.filter("split = 'train'").withColumn("void", F.lit(None).cast("double"))
    prep = est.Preparation.fit(train, [*FEATURES, "void"], "median", scale=True)
    assert prep.features == FEATURES
    labeled = labels.label_single(train, SERIES, "v", 1)
    model = est.fit_forest_regressor(labeled, prep, "v_target", trees=3, depth=4)
    model.save(spark, str(tmp_path / "m"))
    again = est.Forecaster.load(spark, str(tmp_path / "m"))
    a = model.transform(frame).agg(F.sum("prediction")).first()[0]
    assert again.prep == prep and again.transform(frame).agg(F.sum("prediction")).first()[0] == a


def test_mlp_regression(frame, spark, tmp_path):
    df = labels.label_regression(frame, SERIES.keyed("split"), "v", 1)
    net = mlp.Net(hidden=(16,), dropout=0.0, rate=0.01, batch=32, epochs=25)
    train, val, test = (df.filter(F.col("split") == s) for s in ("train", "val", "test"))
    model = mlp.fit_mlp(train, val, FEATURES, {"v": "y"}, net)
    losses = model.losses(spark).orderBy("epoch").toPandas()
    assert losses["val_loss"].min() < 0.5 * losses["val_loss"].iloc[0]
    gap, naive = F.col("y") - F.col("prediction"), F.col("y") - F.col("y_naive")
    row = model.transform(test).agg(F.sqrt(F.avg(gap * gap)), F.sqrt(F.avg(naive * naive))).first()
    assert row[0] < 0.7 * row[1]
    model.save(spark, str(tmp_path / "mlp"))
    again = mlp.MlpModel.load(spark, str(tmp_path / "mlp"))
    total = [m.transform(test).agg(F.sum("prediction")).first()[0] for m in (model, again)]
    assert total[0] == pytest.approx(total[1])


def test_mlp_classes_and_early_stop(frame):
    df = labels.label_class(frame, SERIES.keyed("split"), "v", 1, (8.0, 12.0))
    train, val = (df.filter(F.col("split") == s) for s in ("train", "val"))
    weighted = labels.with_class_weights(train, labels.class_weights(train))
    net = mlp.Net("class", (16,), 0.0, rate=0.02, batch=32, epochs=60, patience=4, slow_after=2)
    model = mlp.fit_mlp(weighted, val, FEATURES, {"v": "y"}, net, weight="weight")
    assert len(model.history) < 60 and min(r for *_, r in model.history) < net.rate
    acc = model.transform(val).agg(F.avg((F.col("y") == F.col("prediction")).cast("int"))).first()[0]
    assert acc > 0.6


def test_mlp_gradient():
    net = mlp.Net(hidden=(5, 4), dropout=0.0, l2=0.0)
    rng = np.random.default_rng(0)
    x, y, weight = rng.normal(size=(7, 3)), rng.normal(size=(7, 2)) * 2, rng.random(7)
    w = [a + 0.1 * rng.normal(size=a.shape) for a in mlp._start(net, 3, 2)]  # off the kinks of ReLU
    grads = mlp._gradient(w, x, y, weight, net, None)
    for i in range(len(w)):
        at = tuple(0 for _ in w[i].shape)
        step = np.zeros_like(w[i])
        step[at] = 1e-6
        up, down = ([a + s * step if j == i else a for j, a in enumerate(w)] for s in (1, -1))
        loss = [mlp._loss(mlp._forward(v, x, net)[0], y, weight, net)[0] / len(x) for v in (up, down)]
        assert grads[i][at] == pytest.approx((loss[0] - loss[1]) / 2e-6, abs=1e-6)


def test_mlp_does_not_depend_on_the_layout(frame):
    """Weights are those of one stream of mini-batches, whatever the partitions, blocks and levels of sums."""
    df = labels.label_regression(frame, SERIES.keyed("split"), "v", 1)
    net = mlp.Net(hidden=(8, 4), batch=100, epochs=6)
    train, val = (df.filter(F.col("split") == s) for s in ("train", "val"))
    models = [mlp.fit_mlp(train.repartition(n), val.repartition(n), FEATURES, {"v": "y"}, net) for n in (1, 4, 64)]
    for other in models[1:]:
        np.testing.assert_allclose(other.history, models[0].history, rtol=1e-8)
        for a, b in zip(models[0].weights, other.weights, strict=True):
            np.testing.assert_allclose(a, b, rtol=1e-8)


def test_mlp_equals_plain_mini_batch_training(frame, monkeypatch):
    """Without dropout a mini-batch is nothing but the gradient of its rows; blocks and sums change only the last digits."""
    df = labels.label_regression(frame, SERIES.keyed("split"), "v", 1)
    net = mlp.Net(hidden=(6,), dropout=0.0, batch=10**6, epochs=5, rate=0.01)
    train, val = (df.filter(F.col("split") == s) for s in ("train", "val"))
    monkeypatch.setattr(mlp, "BLOCK_ROWS", 7)
    monkeypatch.setattr(mlp, "FAN", 3)
    model = mlp.fit_mlp(train, val, FEATURES, {"v": "y"}, net)
    prep, (mean, spread) = model.prep, model.target_scale["v"]
    data = train.select(*FEATURES, "y").toPandas().to_numpy(float)
    x = np.where(np.isnan(data[:, :3]), [prep.fill[c] for c in FEATURES], data[:, :3])
    x = (x - [prep.scale[c][0] for c in FEATURES]) / [prep.scale[c][1] for c in FEATURES]
    y = (data[:, 3:] - mean) / spread
    state = mlp.State.fresh(mlp._start(net, 3, 1))
    seen = []
    for _ in range(5):
        state.step(mlp._gradient(state.w, x, y, np.ones(len(x)), net, None), net.rate)
        seen.append([w.copy() for w in state.w])
    best = min(range(len(model.history)), key=lambda k: model.history[k][2])
    for a, b in zip(model.weights, seen[best], strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-9)


def test_one_task_takes_the_same_steps_as_many(frame, monkeypatch):
    df = labels.label_regression(frame, SERIES.keyed("split"), "v", 1)
    net = mlp.Net(hidden=(8, 4), batch=150, epochs=5, patience=2, slow_after=1, rate=0.02)
    train, val = (df.filter(F.col("split") == s) for s in ("train", "val"))
    one = mlp.fit_mlp(train, val, FEATURES, {"v": "y"}, net)

    def by_jobs(blocks, courses, width, epochs, last, losses):
        for e in epochs:
            if not all(c.done for c in courses):
                mlp._epoch(courses, e, blocks.steps, e > last, losses, lambda read, active, e=e: blocks.sums(read, active, width, e))
        return losses

    monkeypatch.setattr(mlp, "_epochs_in_a_task", by_jobs)
    many = mlp.fit_mlp(train, val, FEATURES, {"v": "y"}, net)
    np.testing.assert_allclose(one.history, many.history, rtol=1e-8)
    for a, b in zip(one.weights, many.weights, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-8)


def test_cells_train_together_as_alone(frame):
    wide = labels.label_horizons(frame, SERIES.keyed("split"), ["v"], (1, 6), name="{t}_{h}")
    net = mlp.Net(hidden=(6,), dropout=0.0, batch=200, epochs=8, rate=0.01, patience=3, slow_after=2)
    train, val = (wide.filter(F.col("split") == s) for s in ("train", "val"))
    tasks = {h: mlp.Labels({"v": f"v_{h}"}) for h in (1, 6)}
    both = mlp.fit_cells(train, val, FEATURES, tasks, net)
    for h in (1, 6):
        alone = mlp.fit_cells(train, val, FEATURES, {h: tasks[h]}, net)[h]
        assert len(alone.history) == len(both[h].history)
        for a, b in zip(alone.weights, both[h].weights, strict=True):
            np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-9)


def test_mlp_with_repeated_rows_and_without_validation_rows(frame):
    df = labels.label_regression(frame, SERIES.keyed("split"), "v", 1).filter("split = 'train'")
    same = df.limit(1).crossJoin(df.sparkSession.range(300)).drop("id")
    model = mlp.fit_mlp(df.unionByName(same), df.limit(0), FEATURES, {"v": "y"}, mlp.Net(hidden=(4,), epochs=2))
    assert len(model.history) == 2 and all(np.isfinite(w).all() for w in model.weights)


def test_isolation_forest_flags_outliers(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(3000, 2))
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(data)]
    rows += [(9000, 12.0, -12.0), (9001, -15.0, 15.0), (9002, None, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(4)
    train = df.filter("id < 9000")
    model = IsolationForest(["a", "b"], contamination=0.05, trees=40).fit(train)
    out = model.transform(df)
    assert out.filter("id in (9000, 9001)").agg(F.min("an_iso")).first()[0] == 1
    assert out.filter("id = 9002").first()["an_iso"] == 0
    share = out.filter("id < 9000").agg(F.avg("an_iso")).first()[0]
    assert share == pytest.approx(0.05, abs=0.01)
    scores = model.score(df).toPandas().set_index("id")["an_score"]
    assert scores[9000] > scores[:3000].quantile(0.999)
    strict = IsolationForest(["a", "b"], trees=5, complete_rows=True).fit(df)
    assert strict.score(df).filter("id = 9002").first()["an_score"] is None


def test_isolation_forest_on_many_rows_thins_them_out(spark):
    df = spark.range(60000).select((F.col("id") % 1000).cast("double").alias("a"), F.rand(3).alias("b"))
    model = IsolationForest(["a", "b"], trees=4, contamination=0.02).fit(df)
    assert model.nodes["tree"].nunique() == 4 and model.size == 256
    assert model.transform(df).agg(F.avg("an_iso")).first()[0] <= 0.021


def test_forest_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(2000, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    models = [IsolationForest(["a", "b"], trees=7, sample_rows=64).fit(df.repartition(n)) for n in (1, 9)]
    a, b = (m.nodes.sort_values(["tree", "node"]).reset_index(drop=True) for m in models)
    assert (a[["tree", "node", "feature", "left", "right"]] == b[["tree", "node", "feature", "left", "right"]]).all().all()
    np.testing.assert_allclose(a["cut"], b["cut"], rtol=1e-9)
    assert models[0].threshold == pytest.approx(models[1].threshold)


def test_residual_flag_needs_eleven_values(spark):
    def flags(n):
        rows = [("x", i, datetime(2024, 1, 1) + timedelta(hours=i), 100.0 if i == n - 1 else 0.0, 0.0) for i in range(n)]
        df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double")
        spec = SPEC.using(layout="direct")
        return [r[0] for r in anomaly.residual_flag(df, spec, ["a"], min_periods=1).orderBy("id").select("an_resid_a").collect()]

    assert sum(flags(10)) == 0
    assert flags(11)[-1] == 1


def test_anomaly_chain(frame):
    spec = SERIES.using(features=("s",))
    flagged = anomaly.anomaly_flags(frame, spec, ["s"], seed=1)
    counts = {r["split"]: r for r in anomaly.anomaly_counts(flagged).collect()}
    assert set(counts) == {"train", "val", "test"}
    assert all(r["kept"] + r["dropped"] == r["rows"] for r in counts.values())
    assert anomaly.anomaly_filter(flagged).count() == sum(r["kept"] for r in counts.values())
    assert anomaly.any_flag(flagged).filter("an_any != greatest(an_resid_v, an_iso)").count() == 0


def test_features_without_values_are_reported(spark):
    from seriesprep.models.estimators import Preparation

    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = Preparation.fit(df, ["a", "b"])
    assert got.features == ["a"] and got.dropped == ["b"]
