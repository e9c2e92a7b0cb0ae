"""Time keys, duplicates, number parsing and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    CLEAN_SQL, HOURLY_SQL, RAW_SQL, SIGNALS, Registry, hourly, many, r6, rounded, table,
)
from seriesprep.operators import cleaning as op
from seriesprep.operators.labels import label_horizons
from seriesprep.operators.validate import side_by_side
from seriesprep.sources.hourly import HOURLY, raw_text_table
from seriesprep.spec import SeriesSpec

registry = Registry()
ITEMS = SeriesSpec(
    ts="l_shipdate", by=("l_suppkey",), tiebreak=("l_orderkey", "l_linenumber", "l_partkey"),
    targets=("l_quantity",),
)
ORDERS = SeriesSpec(ts="o_orderdate", tiebreak=("o_orderkey",))


@registry("build_timestamp", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE o_orderdate + INTERVAL (o_orderkey % 24) HOUR END AS stamp
    FROM orders""")
def _(spark, folder):
    hour = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 == 7, F.lit("31/02/2004"))
        .otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "dd/MM/yyyy"))).alias("Date"),
        F.concat(hour, F.lit(".00.00 ")).alias("Time"),
    )
    return op.build_timestamp(raw, out="stamp")


@registry("parse_timestamp", """
    SELECT event_id, CASE WHEN event_id % 40 = 3 THEN NULL ELSE ts END AS stamp FROM events""")
def _(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 40 == 3, F.lit("not a time")).otherwise(F.col("ts").cast("string")).alias("stamp"),
    )
    return op.parse_timestamp(raw, "stamp")


@registry("drop_null_timestamp", """
    SELECT count(*) AS rows_before, count(*) FILTER (event_id % 40 = 3) AS rows_bad_timestamp,
      count(*) FILTER (event_id % 40 <> 3) AS rows_after FROM events""")
def _(spark, folder):
    spec = SeriesSpec(ts="stamp")
    raw = table(spark, folder, "events").select(F.when(F.col("event_id") % 40 != 3, F.col("ts")).alias("stamp"))
    kept = op.drop_null_timestamp(raw, spec).agg(F.count(F.lit(1)).alias("rows_after"))
    return side_by_side(op.count_null_timestamp(raw, spec), kept)


@registry("dedup_first", """
    SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
        ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return op.dedup_first(items, ITEMS)


@registry("count_duplicates", "SELECT count(*) - count(DISTINCT o_orderdate) AS duplicates_removed FROM orders")
def _(spark, folder):
    return op.count_duplicates(table(spark, folder, "orders"), ORDERS)


@registry("coerce_numeric", """
    SELECT event_id, CASE WHEN event_id % 30 = 4 THEN NULL ELSE value END AS reading, event_type AS kind FROM events""")
def _(spark, folder):
    text = F.concat(F.lit(" "), F.translate(F.col("value").cast("string"), ".", ","))
    raw = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 30 == 4, F.lit("n/k")).otherwise(text).alias("reading"),
        F.col("event_type").alias("kind"),
    )
    return op.coerce_numeric(raw)[0]


@registry("sentinel_to_null", f"WITH {CLEAN_SQL} SELECT ts, {many(SIGNALS)} FROM clean")
def _(spark, folder):
    raw = op.build_timestamp(raw_text_table(hourly(spark, folder), SIGNALS), out="ts")
    numbers, _, _ = op.coerce_numeric(raw)
    return op.sentinel_to_null(numbers).select("ts", *SIGNALS)


@registry("sentinel_counts", f"""WITH {RAW_SQL}
    SELECT {many(f"count(*) FILTER ({c} = '-200') AS {c}" for c in SIGNALS)} FROM raw""")
def _(spark, folder):
    raw = op.build_timestamp(raw_text_table(hourly(spark, folder), SIGNALS), out="ts")
    numbers, _, _ = op.coerce_numeric(raw)
    return numbers.agg(*op.sentinel_counts(numbers, columns=SIGNALS))


@registry("drop_all_missing", f"""WITH {HOURLY_SQL} SELECT ts, {many(r6(c, c) for c in HOURLY.targets)} FROM hourly
    WHERE click IS NOT NULL OR error IS NOT NULL OR purchase IS NOT NULL""")
def _(spark, folder):
    return rounded(op.drop_all_missing(hourly(spark, folder), HOURLY.targets).select("ts", *HOURLY.targets))


@registry("dropna_any", f"""WITH {HOURLY_SQL} SELECT ts, {many(r6(c, c) for c in HOURLY.targets)} FROM hourly
    WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL""")
def _(spark, folder):
    return rounded(op.dropna_any(hourly(spark, folder), HOURLY.targets).select("ts", *HOURLY.targets))


@registry("drop_columns", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def _(spark, folder):
    return op.drop_columns(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority", "absent"])


@registry("select_present", "SELECT o_totalprice, o_orderkey FROM orders")
def _(spark, folder):
    return op.select_present(table(spark, folder, "orders"), ["o_totalprice", "absent", "o_orderkey"])


@registry("slice_time", """
    SELECT event_id, ts, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return op.slice_time(events, SeriesSpec(ts="ts"), datetime(2024, 1, 5), datetime(2024, 1, 20, 12))


@registry("exclude_purge", """
    SELECT event_id, ts FROM events WHERE NOT (
      (ts >= TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR AND ts < TIMESTAMP '2024-01-20') OR
      (ts >= TIMESTAMP '2024-01-25' - INTERVAL 24 HOUR AND ts < TIMESTAMP '2024-01-25'))""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return op.exclude_purge(events, SeriesSpec(ts="ts"), datetime(2024, 1, 20), datetime(2024, 1, 25), 24)


@registry("filter_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_discount > 0.05 AS INTEGER) AS an_any FROM lineitem WHERE l_discount <= 0.05""")
def _(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") > 0.05).cast("int").alias("an_any"))
    return op.filter_flag(items, "an_any", 0)


@registry("feature_target_frame", f"""WITH {HOURLY_SQL}, led AS (SELECT *, lead(click, 6) OVER (ORDER BY ts) AS y_6 FROM hourly)
    SELECT {many(r6(c, c) for c in SIGNALS)}, {r6('y_6', 'y_6')} FROM led WHERE y_6 IS NOT NULL""")
def _(spark, folder):
    df = label_horizons(hourly(spark, folder), HOURLY, ["click"], [1, 6], name="y_{h}")
    return rounded(op.feature_target_frame(df, "y_6", exclude=["ts", "y_1"])[0])


@registry("feature_target_frame_tokens", f"""WITH {HOURLY_SQL}, led AS (SELECT *, lead(click, 1) OVER (ORDER BY ts) AS y FROM hourly)
    SELECT {many(r6(c, c) for c in ('click', 'purchase', 'signup', 'volume', 'peak'))}, {r6('y', 'y')} FROM led WHERE y IS NOT NULL""")
def _(spark, folder):
    df = label_horizons(hourly(spark, folder), HOURLY, ["click"], [1], name="y")
    return rounded(op.feature_target_frame(df, "y", exclude=["ts"], tokens=["cl", "p", "vol"])[0])
