"""Quantiles, fitted imputation and scaling, labels and class weights."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import SPEC, by_id, per_series, series_frame
from seriesprep.functions.quantiles import exact_quantiles
from seriesprep.operators import impute, labels

KEYED = SPEC.using(by=("split",), layout="direct")


@pytest.fixture(scope="module")
def frame(spark):
    df = series_frame(spark, 240, keys=("x",), seed=11)
    split = F.when(F.col("id") < 150, "train").when(F.col("id") < 200, "val").otherwise("test")
    return df.withColumn("split", split).cache()


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    data = pd.DataFrame({
        "u": rng.normal(size=5000), "few": rng.integers(0, 4, 5000).astype(float), "same": 2.5,
        "hot": np.where(rng.random(5000) < 0.4, 1.0, rng.normal(size=5000)), "ints": rng.integers(0, 10**9, 5000),
    })
    probs = [0.0, 0.25, 0.5, 0.98, 1.0]
    df = spark.createDataFrame(data).withColumn("none", F.lit(None).cast("double")).repartition(7)
    got = exact_quantiles(df, [*data.columns, "none"], probs)
    for c in data.columns:
        np.testing.assert_allclose(got[c], np.quantile(data[c], probs), rtol=1e-12)
    assert got["none"] == [None] * 5


def test_quantiles_of_extreme_columns(spark):
    """Two values with the rank at their border, one value only, infinities, and NaN as missing."""
    n = 20_000
    data = pd.DataFrame({
        "two": np.where(np.arange(n) < n // 2, 1.0, 2.0), "same": np.full(n, 7.5), "wide": np.exp(np.linspace(-700, 700, n)),
        "ends": np.r_[[-np.inf, np.inf], np.arange(n - 2)], "holes": np.where(np.arange(n) % 3 == 0, np.nan, np.arange(n))})
    df = spark.createDataFrame(data.sample(frac=1, random_state=1)).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.500025, 0.9999, 1.0]
    got = exact_quantiles(df, list(data.columns), probs)
    for c in ("two", "same", "wide", "holes"):
        np.testing.assert_allclose(got[c], np.nanquantile(data[c], probs), rtol=1e-12)
    assert got["ends"][0] == -np.inf and got["ends"][-1] == np.inf and got["ends"][2] == np.quantile(data["ends"][2:], 0.5)


def test_quantiles_with_nulls(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, None)], "v double")
    assert exact_quantiles(df, ["v"], [0.5])["v"] == [2.5]


def test_imputers_fit_on_train_only(frame):
    train = frame.filter("split = 'train'")
    pdf = frame.toPandas()
    fit = pdf[pdf.split == "train"]
    for op, expected in ((impute.impute_mean, fit.a.mean()), (impute.impute_median, fit.a.median())):
        out, params = op(frame, train, ["a"])
        assert params["a"] == pytest.approx(expected)
        got = by_id(out)["a"].to_numpy(float)
        want = pdf.sort_values("id")["a"].fillna(expected).to_numpy(float)
        np.testing.assert_allclose(got, want)


def test_empty_columns_have_no_parameters(frame):
    train = frame.withColumn("void", F.lit(None).cast("double"))
    assert set(impute.fit_means(train, ["a", "void"])) == {"a"}
    assert set(impute.fit_medians(train, ["a", "void"])) == {"a"}


def test_scaling_on_train(frame):
    train = frame.filter("split = 'train'")
    scaled, _ = labels.standard_scale(frame.withColumn("one", F.lit(1.0)), train.withColumn("one", F.lit(1.0)), ["a", "one"])
    row = scaled.filter("split = 'train'").agg(F.avg("a"), F.stddev_pop("a"), F.max("one")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_target_scaling_goes_back(frame):
    train = frame.filter("split = 'train'")
    out, params = labels.normalize_target(frame, train, ["a"])
    back = by_id(labels.undo_scale(out, {"a_n": "a"}, params))
    np.testing.assert_allclose(back["a_n"].to_numpy(float), back["a"].to_numpy(float))
    flat = train.withColumn("a", F.lit(3.0))
    assert labels.normalize_target(flat, flat, ["a"])[1]["a"] == (3.0, 1.0)


def test_labels_stay_inside_the_split(frame):
    h = 5
    out = by_id(labels.label_single(frame, KEYED, "a", h, keep_unlabeled=True))
    pdf = frame.toPandas().sort_values(["ts", "id"]).reset_index(drop=True)
    pdf["want"] = pdf.groupby("split").a.shift(-h)
    want = pdf.sort_values("id")["want"].to_numpy(float)
    np.testing.assert_allclose(out["a_target"].to_numpy(float), want)
    for _, g in pdf.groupby("split"):
        assert g["want"].tail(h).isna().all()


def test_label_rows(frame):
    pdf = frame.toPandas().sort_values(["ts", "id"])
    ahead = {c: pdf.groupby("split")[c].shift(-2) for c in "ab"}
    assert labels.label_regression(frame, KEYED, "a", 2).count() == (ahead["a"].notna() & pdf.a.notna()).sum()
    both = ahead["a"].notna() & ahead["b"].notna()
    now = pdf.a.notna() & pdf.b.notna()
    assert labels.label_multi(frame, KEYED, ["a", "b"], 2).count() == (both & now).sum()
    assert labels.label_multi(frame, KEYED, ["a", "b"], 2, require_current=False).count() == both.sum()
    assert labels.label_class(frame, KEYED, "a", 2, (9, 11)).filter("y is null or y_naive is null").count() == 0


def test_baselines(frame):
    pdf = frame.toPandas().sort_values(["ts", "id"])
    g = pdf.groupby("split").a
    for op, naive in ((labels.baseline_persistence, pdf.a), (labels.baseline_seasonal, g.shift(24))):
        for r in op(frame, KEYED, ["a"], (1, 6)).collect():
            gap = (g.shift(-r["horizon"]) - naive).dropna()
            assert r["n"] == len(gap) and r["rmse"] == pytest.approx(np.sqrt((gap**2).mean()))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(2,)] * 3, "y int")
    got = {r["y"]: r["weight"] for r in labels.class_weights(df).collect()}
    assert got == {0: 9 / 18, 2: 9 / 9}
    weighted = labels.with_class_weights(df, labels.class_weights(df))
    assert weighted.count() == 9 and weighted.agg(F.sum("weight")).first()[0] == pytest.approx(6.0)


def test_interpolation_against_pandas(frame):
    def fn(g):
        s = g.set_index("ts").a
        s = s[~s.index.duplicated()]
        return s.interpolate(method="time").ffill().bfill().rename("a").reset_index()

    unique = frame.dropDuplicates(["ts"])
    out = impute.interpolate_time(unique, SPEC.using(layout="blocked", block_rows=9), ["a"]).toPandas().sort_values("ts")
    want = fn(unique.toPandas().sort_values("ts"))
    np.testing.assert_allclose(out["a"].to_numpy(float), want["a"].to_numpy(float))


def test_quantiles_do_not_depend_on_the_counters(spark, monkeypatch):
    """Few counters mean more passes with fewer bits each; the values stay the same, also for zeros, ties and the ends of the range."""
    from seriesprep.functions import quantiles

    rng = np.random.default_rng(8)
    data = pd.DataFrame({"a": rng.normal(0, 1e-300, 501), "b": rng.integers(-3, 3, 501).astype(float), "c": np.where(rng.random(501) < 0.5, -0.0, 0.0),
                         "d": rng.choice([-np.inf, -1.5e308, 5e-324, 1e308, np.inf, np.nan], 501)})
    df = spark.createDataFrame(data).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    want = quantiles.exact_quantiles(df, list(data.columns), probs)
    for c in "abc":
        np.testing.assert_allclose(want[c], np.quantile(data[c], probs), rtol=1e-12, atol=0)
    monkeypatch.setattr(quantiles, "CELLS", 100)
    assert quantiles.exact_quantiles(df, list(data.columns), probs) == want


def test_many_columns_and_ranks_at_once(spark):
    from seriesprep.functions import quantiles

    rng = np.random.default_rng(9)
    data = pd.DataFrame(rng.normal(size=(60, 300)), columns=[f"c{i}" for i in range(300)])
    data[data > 1.5] = np.nan
    probs = [0.05, 0.25, 0.5, 0.75]
    got = quantiles.exact_quantiles(spark.createDataFrame(data), list(data.columns), probs)
    for c in data:
        np.testing.assert_allclose(got[c], np.nanquantile(data[c], probs), rtol=1e-12)


def test_correlations_of_many_columns_equal_those_of_pandas(spark, monkeypatch):
    from seriesprep.operators import profile

    rng = np.random.default_rng(10)
    data = pd.DataFrame(rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)), columns=[f"c{i}" for i in range(40)])
    data["c3"] += 1e7
    data["c4"] = 0.1
    data[rng.random(data.shape) < 0.2] = np.nan
    data["c5"] = np.where(np.arange(400) < 399, np.nan, 1.0)
    monkeypatch.setattr(profile, "BAND_BYTES", 10_000)
    out = profile.correlation_matrix(spark.createDataFrame(data).repartition(7)).toPandas()
    assert len(out) == 1600
    got = out.pivot(index="x", columns="y", values="corr").astype(float).loc[list(data), list(data)]
    want = data.corr()
    want.loc["c4"] = want["c4"] = np.nan
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-7, atol=1e-7)
    plan = profile.correlation_matrix(spark.createDataFrame(data))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
