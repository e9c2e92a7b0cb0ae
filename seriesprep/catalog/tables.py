"""Readers, writers and column order."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    HOURLY_SQL, RAW_SQL, SIGNALS, SPLIT_SQL, Registry, hourly, hourly_splits, many, r6, rounded, table,
)
from seriesprep.operators.splits import export_splits
from seriesprep.sources.hourly import HOURLY, raw_text_table
from seriesprep.sources.io import (
    drop_empty_columns, normalize_names, order_columns, read_delimited, read_table, write_table,
)
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import fresh_path

registry = Registry()
ORDERS = SeriesSpec(ts="o_orderdate", tiebreak=("o_orderkey",), targets=("o_totalprice",))


def write_raw(spark, folder) -> str:
    path = fresh_path(spark, "raw")
    raw = raw_text_table(hourly(spark, folder), SIGNALS)
    raw.write.csv(path, sep=";", header=True)
    return path


@registry("read_delimited", f"WITH {RAW_SQL} SELECT \"Date\", \"Time\", {many(SIGNALS)} FROM raw")
def _(spark, folder):
    return read_delimited(spark, write_raw(spark, folder), sep=";")


@registry("drop_empty_columns", "SELECT event_id, event_type, value FROM events")
def _(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.lit("  ").alias("blank"), "event_type", F.lit(None).cast("string").alias("nothing"), "value"
    )
    return drop_empty_columns(events)[0]


@registry("normalize_names", "SELECT event_id, value AS pt08_s1_co, user_id AS co_gt FROM events")
def _(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("event_id").alias(" event_id "), F.col("value").alias("PT08.S1(CO)"), F.col("user_id").alias("CO(GT)")
    )
    return normalize_names(events, safe=True)[0]


@registry("read_table", """
    SELECT o_orderdate, o_orderkey, o_totalprice, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn = 1""")
def _(spark, folder):
    df = read_table(spark, f"{folder}/orders.parquet", ORDERS)
    return df.select("o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus")


@registry("write_table", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, folder):
    events = table(spark, folder, "events").drop("props")
    path = write_table(events, fresh_path(spark, "events"), "parquet", SeriesSpec(ts="ts"))[0]
    return spark.read.parquet(path)


@registry("order_columns", "SELECT l_shipdate, l_quantity, l_orderkey, l_linenumber, l_discount FROM lineitem")
def _(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_shipdate", "l_discount")
    return order_columns(items, ["l_shipdate", "l_quantity", "absent"])


@registry("export_splits", f"""WITH {SPLIT_SQL}, edges AS (SELECT min(ts) FILTER (split = 'val') AS v,
      min(ts) FILTER (split = 'test') AS t FROM splitted)
    SELECT ts, split, {many(r6(c, c) for c in SIGNALS)} FROM splitted, edges
    WHERE NOT (split = 'train' AND ((ts >= v - INTERVAL 24 HOUR AND ts < v) OR (ts >= t - INTERVAL 24 HOUR AND ts < t)))""")
def _(spark, folder):
    df = hourly(spark, folder)
    splits = hourly_splits(df, purge_hours=24)
    path = export_splits(df, HOURLY, splits, fresh_path(spark, "export"), "hourly", exclude_purge=True)[0]
    return rounded(spark.read.parquet(path).select("ts", "split", *SIGNALS))


@registry("hourly_table", f"WITH {HOURLY_SQL} SELECT ts, {many(r6(c, c) for c in SIGNALS)} FROM hourly")
def _(spark, folder):
    return rounded(hourly(spark, folder))
