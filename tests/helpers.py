"""Small frames and comparisons."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from seriesprep.spec import SeriesSpec

SPEC = SeriesSpec(ts="ts", by=("k",), tiebreak=("id",), targets=("a",), features=("b",))


def series_frame(spark, n=400, keys=("x", "y", None), seed=0, nulls=0.2, hot=0.7):
    """Several series, one of them with most of the rows, with gaps, nulls and repeated times."""
    rng = np.random.default_rng(seed)
    weights = [hot] + [(1 - hot) / (len(keys) - 1)] * (len(keys) - 1) if len(keys) > 1 else [1.0]
    k = rng.choice(len(keys), n, p=weights)
    start = pd.Timestamp("2024-01-01")
    minutes = np.sort(rng.integers(0, n * 20, n))
    a, b = rng.normal(10, 3, n).round(3), rng.normal(0, 1, n).round(3)
    rows = [
        (keys[k[i]], i, (start + pd.Timedelta(minutes=int(minutes[i]))).to_pydatetime(),
         None if rng.random() < nulls else float(a[i]), None if rng.random() < nulls else float(b[i]))
        for i in range(n)
    ]
    order = rng.permutation(n)
    schema = "k string, id long, ts timestamp_ntz, a double, b double"
    return spark.createDataFrame([rows[i] for i in order], schema).repartition(5)


def by_id(df: DataFrame, keys=("id",)) -> pd.DataFrame:
    pdf = df.toPandas().sort_values(list(keys), kind="stable").reset_index(drop=True)
    return pdf[sorted(pdf.columns)]


def assert_same(left: DataFrame, right: DataFrame, keys=("id",), rtol=1e-9):
    a, b = by_id(left, keys), by_id(right, keys)
    assert list(a.columns) == list(b.columns)
    pd.testing.assert_frame_equal(a, b, rtol=rtol, atol=1e-9, check_dtype=False)


def per_series(pdf: pd.DataFrame, fn) -> pd.DataFrame:
    """Apply ``fn`` to each series in time order, with pandas."""
    parts = [fn(g.sort_values(["ts", "id"]).copy()) for _, g in pdf.groupby("k", dropna=False)]
    out = pd.concat(parts).sort_values("id").reset_index(drop=True)
    return out[sorted(out.columns)]
