"""Metrics and profile tables on hand-made rows and against pandas."""

import numpy as np
import pandas as pd
import pytest

from helpers import SPEC, series_frame
from seriesprep import metrics as op
from seriesprep.operators import profile


@pytest.fixture(scope="module")
def classes(spark):
    # class 2 is predicted but never seen, class 1 seen but never predicted
    return spark.createDataFrame([(0, 0)] * 5 + [(0, 2)] * 2 + [(1, 0)] * 3, "y int, p int")


def test_class_scores(classes):
    got = {r["label"]: r.asDict() for r in op.class_scores(classes).collect()}
    assert got[0]["precision"] == 5 / 8 and got[0]["recall"] == 5 / 7 and got[0]["support"] == 7
    assert (got[1]["precision"], got[1]["recall"], got[1]["f1"], got[1]["support"]) == (0, 0, 0, 3)
    assert (got[2]["precision"], got[2]["recall"], got[2]["f1"], got[2]["support"]) == (0, 0, 0, 0)
    m = op.macro_scores(classes).first()
    assert m["n"] == 10 and m["accuracy"] == 0.5
    assert m["macro_f1"] == pytest.approx(got[0]["f1"] / 3) and m["macro_recall"] == pytest.approx(5 / 21)


def test_confusion_matrix_is_full(classes):
    got = [tuple(r) for r in op.confusion_matrix(classes).orderBy("y").collect()]
    assert got == [(0, 5, 0, 2), (1, 3, 0, 0), (2, 0, 0, 0)]


def test_report_rows(classes):
    got = {r["label"]: r for r in op.classification_report(classes).collect()}
    assert set(got) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert got["weighted avg"]["recall"] == pytest.approx(0.5) and got["accuracy"]["f1"] == 0.5


def test_rmse_skips_what_is_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, 3.0), (2.0, None), (nan, 1.0), (4.0, inf), (0.0, 0.0)], "y_true double, y_pred double")
    row = op.rmse_finite(df).first()
    assert row["n"] == 2 and row["rmse"] == pytest.approx(np.sqrt(2.0))
    assert op.rmse_finite(df.filter("y_pred is null")).first()["rmse"] is None


def test_result_tables(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 3.0), ("a", 6, 4.0, 3.0), ("b", 1, 1.0, 1.5)], "target string, horizon int, m double, base double")
    gain = {(r["target"], r["horizon"]): r["improvement"] for r in op.improvement(df, "m", "base").collect()}
    assert gain == {("a", 1): 1.0, ("a", 6): -1.0, ("b", 1): 0.5}
    assert op.improvement(df, "m", "base", higher_is_better=True).first()["improvement"] == -1.0
    wide = {r["target"]: (r["h1"], r["h6"]) for r in op.pivot_horizon(df, "m", (1, 6)).collect()}
    assert wide == {"a": (2.0, 4.0), "b": (1.0, None)}
    assert op.compare_datasets({"x": df, "y": df}).groupBy("dataset").count().count() == 2


# --- profile ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def frame(spark):
    return series_frame(spark, 300, seed=2).cache()


def test_describe(frame):
    pdf = frame.toPandas()
    got = {r["column"]: r for r in profile.describe_all(frame).collect()}
    want = pdf.describe(include="all")
    for f, name in (("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "max")):
        assert got["a"][name] == pytest.approx(want.loc[f, "a"])
    assert got["k"]["top"] == "x" and got["k"]["distinct"] == 2
    assert got["k"]["count"] == pdf.k.notna().sum() and got["k"]["freq"] == (pdf.k == "x").sum()
    assert got["ts"]["ts_min"].startswith(str(pdf.ts.min())[:16]) and got["ts"]["mean"] is None


def test_text_summary_prefers_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "s string")
    r = profile.text_summary(df, ["s"]).first()
    assert (r["count"], r["distinct"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_missing_rates(frame):
    got = {r["column"]: r["missing_rate"] for r in profile.missing_rate(frame).collect()}
    for c, rate in frame.toPandas().isna().mean().items():
        assert got[c] == pytest.approx(rate)
    assert [r["column"] for r in profile.top_missing(frame, 2).collect()] == sorted(
        got, key=lambda c: (-got[c], c))[:2]


def test_histogram(frame, spark):
    values = frame.toPandas()["a"].dropna()
    want, edges = np.histogram(values, bins=20)
    got = profile.histogram(frame, "a", 20).orderBy("bin").toPandas()
    assert list(got["n"]) == list(want)
    np.testing.assert_allclose(got["lower"], edges[:-1])
    flat = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert profile.histogram(flat, "v", 10).agg({"n": "sum"}).first()[0] == 4
    assert profile.histogram(flat.filter("v > 5"), "v").count() == 0


def test_correlations(frame):
    from pyspark.sql import functions as F

    df = frame.withColumns({"c": F.col("a") * 2 + F.col("b"), "flat": F.lit(1.0)})
    got = {(r["x"], r["y"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b", "c", "flat"]).collect()}
    want = df.toPandas()[["a", "b", "c"]].corr()
    for (x, y), value in got.items():
        if "flat" in (x, y):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[x, y])


def test_means_by_hour_and_day(frame):
    pdf = frame.toPandas()
    hours = {r["hour"]: r["a"] for r in profile.mean_by_hour(frame, SPEC, ["a"]).collect()}
    days = {r["dow"]: r["a"] for r in profile.mean_by_dow(frame, SPEC, ["a"]).collect()}
    pd.testing.assert_series_equal(pd.Series(hours).sort_index(), pdf.groupby(pdf.ts.dt.hour).a.mean(), check_names=False, check_dtype=False, check_index_type=False)
    pd.testing.assert_series_equal(pd.Series(days).sort_index(), pdf.groupby(pdf.ts.dt.dayofweek).a.mean(), check_names=False, check_dtype=False, check_index_type=False)
