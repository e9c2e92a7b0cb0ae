"""The driver contract: names, SQL, and the flagship query; results are compared with DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "anomalous_hours_per_day", "dedup_first", "lag_features_long", "ewm_mean_long", "rolling_time_dense",
    "interpolate_time_long", "feature_store_long", "split_by_ratio", "classification_report", "describe_all", "check_drift",
)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 120


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["day", "signal", "n_anomalies", "n_known"] and out.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.sql(contract.oracle_sql()[name]).df()
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert sorted(got.columns) == sorted(want.columns)

    def plain(v):
        if v is None or (not isinstance(v, str) and pd.isna(v)):
            return None
        if hasattr(v, "year"):
            return str(pd.Timestamp(v))
        return v if isinstance(v, str) else float(v)

    def canonical(df):
        return sorted(([plain(v) for v in row] for row in df[sorted(df.columns)].values.tolist()), key=repr)

    assert canonical(got) == canonical(want)
