"""Training and scoring runs from table to scores."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from seriesprep.models import mlp, sweep
from seriesprep.models import estimators as est
from seriesprep.operators.splits import split_by_ratio
from seriesprep.plans import forecast
from seriesprep.plans.feature_store import boosting_features
from seriesprep.spec import SeriesSpec

SPEC = SeriesSpec(ts="ts", targets=("u", "v"), features=("s",), layout="direct")
NET = dict(hidden=(16,), dropout=0.0, rate=0.01, batch=32, epochs=12)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(8)
    v = 10 + 4 * np.sin(np.arange(501) * 2 * np.pi / 24) + rng.normal(0, 2, 501)
    rows = [
        (datetime(2024, 1, 1) + timedelta(hours=i), None if i % 40 == 7 else float(20 - v[i]), float(v[i]),
         None if i % 9 == 0 else float(v[i + 1]))
        for i in range(500)
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, u double, v double, s double").repartition(2).cache()


@pytest.fixture(scope="module")
def splits(frame):
    return split_by_ratio(frame, SPEC, purge_hours=24)


@pytest.mark.parametrize("kind,targets", [("regression", ("v",)), ("multi", ("u", "v")), ("class", ("v",))])
def test_train_save_evaluate(spark, frame, splits, tmp_path, kind, targets):
    task = forecast.Task(kind, targets, 1, (8.0, 12.0))
    net = mlp.Net("class" if kind == "class" else "regression", **NET)
    model, scores = forecast.train(frame, SPEC, splits, task, net)
    model.save(spark, str(tmp_path / kind))
    again, table = forecast.evaluate(mlp.MlpModel.load(spark, str(tmp_path / kind)), frame, SPEC, splits, task)
    rows = {(r["split"], r["forecast"], r["target"] if kind != "class" else "v"): r for r in scores.collect()}
    assert {k[0] for k in rows} == {"train", "val", "test"}
    test = {(r["forecast"], r["target"] if kind != "class" else "v"): r for r in again.collect()}
    if kind == "class":
        assert test["model", "v"]["accuracy"] > test["naive", "v"]["accuracy"]
    else:
        assert test["model", "v"]["rmse"] < test["naive", "v"]["rmse"]
    if kind == "multi":
        assert test["model", "macro"]["rmse"] == pytest.approx((test["model", "u"]["rmse"] + test["model", "v"]["rmse"]) / 2)
        assert set(table.columns) == {"ts", "target", "y_true", "y_pred", "y_naive", "residual"}
    assert table.count() > 60
    if kind == "regression":
        assert rows["test", "naive", "v"]["rmse"] == pytest.approx(test["naive", "v"]["rmse"])
        with pytest.raises(ValueError, match="missing"):
            forecast.evaluate(model, frame.drop("s"), SPEC, splits, task)


def test_boosting_on_two_datasets(frame, splits):
    from seriesprep.operators.splits import split_rows

    keyed = SPEC.keyed("split")
    rows = split_rows(frame, SPEC, splits)
    full, features = boosting_features(rows, keyed, ("v",))
    assert features == ["s", "v_lag1", "hour", "weekday", "month"]
    assert full.filter("s is null or v_lag1 is null").count() == 0
    assert full.filter("u is null").count() == rows.filter("u is null").count()
    fit = lambda t, p, y: est.fit_gbt_regressor(t, p, y, stages=5)
    out = sweep.forecast_sweep({"vanilla": full, "clean": full.filter("hour != 3")}, SPEC, ["v"], features, fit, (1,), refit=False)
    assert sorted(r["dataset"] for r in out.collect()) == ["clean", "vanilla"]
