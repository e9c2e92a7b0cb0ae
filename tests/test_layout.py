"""Results must not depend on the layout, the block size or the input partitioning."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import SPEC, assert_same, by_id, series_frame
from seriesprep import layout
from seriesprep.operators import impute, labels, windows
from seriesprep.operators.ewm import ewm_mean
from seriesprep.plans.feature_store import feature_store, temporal_features
from seriesprep.spec import SeriesSpec

OPERATORS = {
    "lags": lambda df, s: windows.lag_features(df, s, ["a", "b"], (1, 5)),
    "leads": lambda df, s: windows.lead_target(df, s, ["a"], (1, 7)),
    "rolling_past": lambda df, s: windows.rolling_past(df, s, ["a"], (3, 8)),
    "moving_average": lambda df, s: windows.moving_average(df, s, ["a"], (3, 6), strict=True),
    "rolling_stats": lambda df, s: windows.rolling_stats(df, s, "a", 6, 3),
    "diff1": lambda df, s: windows.diff1(df, s, ["b"]),
    "zscore": lambda df, s: windows.zscore_flag_past(df, s, ["a"], 8, 4, 1.5),
    "ffill": lambda df, s: impute.ffill(df, s, ["a", "b"]),
    "bfill": lambda df, s: impute.bfill(df, s, ["a", "b"]),
    "interpolate": lambda df, s: impute.interpolate_time(df, s, ["a", "b"]),
    "fill_rolling": lambda df, s: impute.fill_rolling(df, s, ["a", "b"], 4),
    "ewm": lambda df, s: ewm_mean(df, s, ["a", "b"], (3, 10)),
    "row_index": lambda df, s: layout.row_index(df, s),
    "running_sums": lambda df, s: layout.running_sums(df, s, {"total": F.col("a"), "n": F.when(F.col("b") > 0, 1)}),
    "labels": lambda df, s: labels.label_horizons(df, s, ["a"], (1, 4)),
    "baseline": lambda df, s: labels.baseline_seasonal(df, s, ["a"], (1, 4), 6, group=["k"]).withColumn(
        "id", F.concat_ws("/", "k", "horizon")),
    "features": lambda df, s: feature_store(df, s, 3, (2, 4), (4,), 6),
    "temporal": lambda df, s: temporal_features(df, s, (1, 3), (2, 4)),
}


@pytest.fixture(scope="module")
def frame(spark):
    return series_frame(spark).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_blocks_equal_direct(frame, name):
    op = OPERATORS[name]
    direct = op(frame, SPEC.using(layout="direct"))
    for size in (8, 61):
        blocked = op(frame, SPEC.using(layout="blocked", block_rows=size))
        assert layout.POS not in blocked.columns and layout.BLOCK not in blocked.columns
        assert_same(direct, blocked)


@pytest.mark.parametrize("name", ["lags", "ewm", "interpolate", "row_index", "running_sums"])
def test_single_series_blocks_equal_direct(spark, name):
    df = series_frame(spark, 150, keys=("only",), seed=3)
    spec = SPEC.using(by=())
    op = OPERATORS[name]
    assert_same(op(df, spec.using(layout="direct")), op(df, spec.using(layout="blocked", block_rows=9)))


def test_input_partitioning_does_not_matter(frame):
    spec = SPEC.using(layout="blocked", block_rows=16)
    assert_same(OPERATORS["lags"](frame.repartition(1), spec), OPERATORS["lags"](frame.repartition(13, "b"), spec))


def test_placed_table_serves_several_operators(frame):
    placed, how = layout.place(frame, SPEC.using(layout="blocked", block_rows=32), reach=8)
    out = windows.rolling_past(windows.lag_features(placed, how, ["a"], (1,)), how, ["a"], (4,))
    assert layout.POS in out.columns
    direct = SPEC.using(layout="direct")
    expected = windows.rolling_past(windows.lag_features(frame, direct, ["a"], (1,)), direct, ["a"], (4,))
    assert_same(out.drop(layout.POS), expected)


def test_positions_are_dense_and_in_time_order(frame):
    placed, _ = layout.place(frame, SPEC.using(layout="blocked"))
    pdf = placed.toPandas().sort_values(layout.POS)
    assert list(pdf[layout.POS]) == list(range(len(pdf)))
    for _, g in pdf.groupby("k", dropna=False):
        assert list(zip(g["ts"], g["id"])) == sorted(zip(g["ts"], g["id"]))


def test_auto_goes_by_the_longest_series(frame):
    assert layout.place(frame, SPEC)[1].layout == "direct"
    assert layout.place(frame, SPEC.using(max_direct_rows=50))[1].layout == "indexed"
    assert layout.place(frame, SPEC.using(by=(), max_direct_rows=399))[1].layout == "indexed"
    assert layout.place(frame, SPEC.using(by=(), max_direct_rows=400))[1].layout == "direct"


def test_block_must_hold_the_reach(frame):
    placed, how = layout.place(frame, SPEC.using(layout="blocked", block_rows=4), reach=4)
    with pytest.raises(ValueError):
        windows.lag_features(placed, how, ["a"], (9,))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocked_plans_have_no_single_task_and_no_cross_join(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    spec = SeriesSpec(ts="ts", tiebreak=("event_id",), layout="blocked")
    for op in (
        lambda: windows.lag_features(events, spec, ["value"], (1, 48)),
        lambda: layout.row_index(events, spec.using(by=("event_type",))),
        lambda: impute.bfill(events, spec.using(by=("event_type",)), ["value"]),
    ):
        plan = _plan(op())
        assert "SinglePartition" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_table_of_parts_can_stay_distributed(frame, monkeypatch):
    spec = SPEC.using(layout="blocked", block_rows=32)
    expected = by_id(layout.place(frame, spec)[0])
    monkeypatch.setattr(layout, "MAX_COLLECTED_PARTS", 0)
    pd.testing.assert_frame_equal(by_id(layout.place(frame, spec)[0]), expected)


def test_time_slice_reaches_the_scan(spark):
    from datetime import datetime

    from seriesprep.operators.cleaning import slice_time

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    plan = _plan(slice_time(events, SeriesSpec(ts="ts"), datetime(2024, 1, 3), datetime(2024, 1, 4)).select("value"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "event_type" not in plan.split("ReadSchema")[1]


def test_rows_equal_in_all_keys_are_kept(spark):
    rows = [("x", 1, pd.Timestamp("2024-01-01").to_pydatetime(), 1.0, 2.0)] * 50
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, a double, b double")
    out = by_id(layout.row_index(df, SPEC.using(layout="blocked", block_rows=7)), keys=("rn",))
    assert list(out["rn"]) == list(range(1, 51))
