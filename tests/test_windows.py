"""Window operators against pandas, and the rule that features look at the past only."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import SPEC, by_id, per_series, series_frame
from seriesprep.operators import windows
from seriesprep.operators.ewm import ewm_mean
from seriesprep.operators.anomaly import residual_flag
from seriesprep.operators.timeframes import rolling_time
from seriesprep.plans.feature_store import feature_store
from seriesprep.spec import SeriesSpec

DIRECT = SPEC.using(layout="direct")
BLOCKS = SPEC.using(layout="blocked", block_rows=30)


@pytest.fixture(scope="module")
def frame(spark):
    return series_frame(spark, 300, seed=5).cache()


def check(df, expected):
    pd.testing.assert_frame_equal(by_id(df), expected, check_dtype=False, rtol=1e-9, atol=1e-9)


def test_lags_and_differences(frame):
    def fn(g):
        return g.assign(a_lag_1=g.a.shift(1), a_lag_4=g.a.shift(4), a_diff_1=g.a.diff(1))

    out = windows.diff1(windows.lag_features(frame, BLOCKS, ["a"], (1, 4)), DIRECT, ["a"])
    check(out, per_series(frame.toPandas(), fn))


def test_rolling_past(frame):
    def fn(g):
        s = g.a.shift(1)
        for w in (3, 6):
            r = s.rolling(w, min_periods=1)
            g[f"a_roll{w}_mean"], g[f"a_roll{w}_std"] = r.mean(), r.std(ddof=0)
        return g

    check(windows.rolling_past(frame, BLOCKS, ["a"], (3, 6)), per_series(frame.toPandas(), fn))


def test_moving_averages(frame):
    def fn(g):
        return g.assign(a_MA4=g.a.rolling(4, min_periods=1).mean(), a_ma_4=g.a.rolling(4).mean())

    out = windows.moving_average(frame, DIRECT, ["a"], (4,))
    out = windows.moving_average(out, BLOCKS, ["a"], (4,), strict=True, name="{c}_ma_{w}")
    check(out, per_series(frame.toPandas(), fn))


@pytest.mark.parametrize("spec", [DIRECT, BLOCKS, SPEC.using(layout="blocked", block_rows=3)])
def test_ewm(frame, spec):
    def fn(g):
        for s in (3, 24):
            g[f"a_ewm{s}_mean"] = g.a.shift(1).ewm(span=s, adjust=False, min_periods=1).mean()
        return g

    check(ewm_mean(frame, spec, ["a"], (3, 24)), per_series(frame.toPandas(), fn))


def test_ewm_over_long_gaps_and_empty_blocks(spark):
    n = 200
    values = [None] * n
    for i in (3, 4, 90, 199):
        values[i] = float(i)
    times = pd.date_range("2024-01-01", periods=n, freq="h")
    rows = [("x", i, times[i].to_pydatetime(), values[i], None) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double")
    got = by_id(ewm_mean(df, SPEC.using(layout="blocked", block_rows=8), ["a", "b"], (6,)))
    expected = pd.Series(values, dtype=float).shift(1).ewm(span=6, adjust=False).mean()
    np.testing.assert_allclose(got["a_ewm6_mean"].to_numpy(float), expected, rtol=1e-12)
    assert got["b_ewm6_mean"].isna().all()


def test_zscore_cases(spark):
    times = pd.date_range("2024-01-01", periods=40, freq="h")
    flat = [0.1] * 30 + [0.1, 0.2] + [0.1] * 8
    rows = [("x", i, times[i].to_pydatetime(), flat[i], None if i < 38 else 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double")
    out = by_id(windows.zscore_flag_past(df, DIRECT, ["a", "b"]))
    flags = out["a_is_anom"].to_numpy(float)
    assert np.isnan(flags[:12]).all()  # fewer than 12 values before
    assert np.isnan(flags[30])  # no spread, same value: undecided
    assert flags[31] == 1.0  # no spread, other value
    assert flags[32] == 0.0
    assert out["b_is_anom"].isna().all()


def _features(df):
    return by_id(feature_store(df, SPEC.using(layout="direct"), 4, (3,), (5,), 12))


def test_features_look_at_the_past_only(frame):
    cut = 150
    changed = frame.withColumns({c: F.when(F.col("id") >= cut, F.lit(99.0)).otherwise(F.col(c)) for c in "ab"})
    before, after = _features(frame), _features(changed)
    past = [c for c in before.columns if "_lag_" in c or "_roll" in c or "_ewm" in c]
    assert past
    rows = before["id"] <= cut
    first_changed = before[before["id"] >= cut].groupby("k", dropna=False)["id"].min()
    rows = before.apply(lambda r: r["id"] <= first_changed.get(r["k"], np.inf) if r["k"] else r["id"] < cut, axis=1)
    pd.testing.assert_frame_equal(before.loc[rows, past], after.loc[rows, past])
    older = before["id"] < cut
    pd.testing.assert_frame_equal(before.loc[older], after.loc[older])


def test_feature_table_width(spark):
    df = series_frame(spark, 30, keys=("x", "y"))
    wide = SeriesSpec(
        ts="ts", by=("k",), tiebreak=("id",), targets=tuple(f"t{i}" for i in range(5)),
        features=tuple(f"f{i}" for i in range(8)), layout="direct",
    )
    df = df.select("k", "id", "ts", *[F.col("a").alias(c) for c in wide.signals])
    assert len(feature_store(df, wide).columns) == 3 + 803


# --- time frames --------------------------------------------------------------------------------

def time_frame(spark, n=300, seed=1):
    df = series_frame(spark, n, seed=seed, nulls=0.3)
    return df.dropDuplicates(["k", "ts"]).cache()


def by_time(g):
    s = g.set_index("ts").a.rolling("24h", min_periods=3)
    return g.assign(a_mean_24h=s.mean().to_numpy(), a_std_24h=s.std().to_numpy())


@pytest.mark.parametrize("layout", ["direct", "auto", "blocked"])
def test_rolling_time(spark, layout):
    df = time_frame(spark)
    out = rolling_time(df, SPEC.using(layout=layout, block_rows=40), ["a"], 24, 3)
    pd.testing.assert_frame_equal(by_id(out), per_series(df.toPandas(), by_time), check_dtype=False, rtol=1e-7, atol=1e-7)


def test_rolling_time_counts_all_rows_of_a_time(spark):
    df = series_frame(spark, 200, seed=9)
    df = df.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")).cache()
    want = df.toPandas().assign(key=lambda d: d.k.fillna("none"))

    def frame(row):
        own = want[(want.key == row.key) & (want.ts <= row.ts) & (want.ts > row.ts - pd.Timedelta("24h"))].a
        return own.mean(), own.std()

    out = by_id(rolling_time(df, SPEC, ["a"], 24, 1))
    got = out.merge(want.assign(want=want.apply(frame, axis=1))[["id", "k", "want"]], on=["id", "k"])
    assert len(got) == len(want)
    for c, i in (("a_mean_24h", 0), ("a_std_24h", 1)):
        pd.testing.assert_series_equal(got[c].astype(float), got.want.str[i].astype(float), check_names=False, rtol=1e-7, atol=1e-7)


def test_frames_of_equal_values_have_no_spread(spark):
    times = pd.date_range("2024-01-01", periods=60, freq="h")
    rows = [("x", i, times[i].to_pydatetime(), 0.1 if i < 55 else 7.3, 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double")
    out = by_id(rolling_time(df, SPEC, ["a"], 24, 1))
    assert (out["a_std_24h"][1:55] == 0).all() and out["a_std_24h"][55] > 0


def test_shifted_stretch_and_infinity_give_the_flags_of_pandas(spark):
    """Values near 0 with a stretch near a million, where sums of squares would lose the spread, and one infinity."""
    rng = np.random.default_rng(7)
    times = pd.date_range("2024-01-01", periods=400, freq="37min")
    a = rng.normal(0, 0.1, 400)
    a[120:300] += 1e6
    a[[60, 200, 350]] += 5
    a[310] = np.inf
    df = spark.createDataFrame([("x", i, times[i].to_pydatetime(), float(a[i]), 0.0) for i in range(400)], "k string, id long, ts timestamp_ntz, a double, b double")
    series = pd.Series(np.where(np.isinf(a), np.nan, a), times)
    mean, std = (getattr(series.rolling("24h", min_periods=12), f)() for f in ("mean", "std"))
    out = by_id(residual_flag(df, SPEC, ["a"]))
    sure = ~np.isclose(np.abs(a - mean), 3 * std, rtol=1e-4)  # pandas itself loses digits in the stretch
    want = (np.abs(a - mean) > 3 * std).fillna(False).astype(int).to_numpy()
    exact = [(np.nanmean(w), np.nanstd(w, ddof=1)) for w in (series[(times > t - pd.Timedelta("24h")) & (times <= t)] for t in times)]
    plain = np.array([int(abs(v - m) > 3 * s) if k >= 12 and np.isfinite(s) else 0 for k, (v, (m, s)) in enumerate(zip(a, exact, strict=True))])
    assert (out["an_resid_a"].to_numpy() == plain)[12:].all() and (plain == want)[12:][sure[12:]].mean() > 0.97


@pytest.mark.parametrize("block", [7, 64])
def test_a_crowded_day_is_cut_into_blocks(spark, block):
    """Two thirds of the rows lie in one day, some at the very same time; spans go over many blocks and blocks over many spans."""
    rng = np.random.default_rng(11)
    day = pd.Timestamp("2024-03-05")
    crowd = day + pd.to_timedelta(rng.integers(0, 86_400, 400) // 30 * 30, unit="s")
    rest = day + pd.to_timedelta(rng.integers(-40 * 24, 40 * 24, 200), unit="h")
    times = [*crowd, *rest, *[pd.Timestamp("1969-12-31 23:30")] * 3]
    a = rng.normal(0, 1, len(times)) + np.where(rng.random(len(times)) < 0.2, 1e5, 0.0)
    a = [None if rng.random() < 0.1 else float(v) for v in a]
    rows = [("x" if i % 50 else None, i, t.to_pydatetime(), v, 0.0) for i, (t, v) in enumerate(zip(times, a, strict=True))]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double").repartition(6)
    out = rolling_time(df, SPEC.using(block_rows=block), ["a", "b"], 24, 2).toPandas().sort_values("id")
    data = pd.DataFrame({"k": [r[0] or "" for r in rows], "ts": times, "a": [np.nan if v is None else v for v in a]})
    for r, (_, own) in zip(out.itertuples(), data.iterrows(), strict=True):
        w = data[(data.k == own.k) & (data.ts <= own.ts) & (data.ts > own.ts - pd.Timedelta("24h"))].a.dropna()
        if len(w) < 2:
            assert pd.isna(r.a_mean_24h) and pd.isna(r.a_std_24h)
        else:
            assert r.a_mean_24h == pytest.approx(w.mean(), rel=1e-9, abs=1e-9) and r.a_std_24h == pytest.approx(w.std(), rel=1e-9, abs=1e-9)
    assert (out.b_std_24h.dropna() == 0).all()


def test_windows_of_time_frames_are_blocks(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    df = rolling_time(events, SeriesSpec(ts="ts", tiebreak=("event_id",)), ["value"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Window [" in line]
    assert lines and all("_block" in line for line in lines)
