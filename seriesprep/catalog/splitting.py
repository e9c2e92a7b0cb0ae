"""Temporal splits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.catalog.common import HOURLY_SQL, SPLIT_SQL, Registry, hourly, hourly_splits, many, r6, rounded, table
from seriesprep.operators import splits as op
from seriesprep.plans.preprocess import assemble_clean
from seriesprep.sources.hourly import EVENTS, HOURLY
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import fresh_path

registry = Registry()
ORDERS = SeriesSpec(ts="o_orderdate", tiebreak=("o_orderkey",), layout="blocked")
DAY = datetime(2024, 1, 1)
TRAIN = (datetime(2023, 12, 30), datetime(2024, 1, 20, 23, 59, 59))
VAL = (datetime(2024, 1, 21), datetime(2024, 1, 25, 23, 59, 59))
TEST = (datetime(2024, 1, 26), datetime(2024, 2, 15))
WINDOWS = (
    ((datetime(2024, 1, 1), datetime(2024, 1, 9, 23)), (datetime(2024, 1, 10), datetime(2024, 1, 12))),
    ((datetime(2024, 1, 4), datetime(2024, 1, 19, 23)), (datetime(2024, 1, 20), datetime(2024, 3, 1))),
)


def sql_ts(t: datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def left(t: datetime, source: str = "events", ts: str = "ts") -> str:
    return f"(SELECT coalesce(max({ts}) FILTER ({ts} <= {sql_ts(t)}), min({ts})) FROM {source})"


def right(t: datetime, source: str = "events", ts: str = "ts") -> str:
    return f"(SELECT coalesce(min({ts}) FILTER ({ts} >= {sql_ts(t)}), max({ts})) FROM {source})"


def events(spark, folder):
    return table(spark, folder, "events").select("event_id", "ts", "value")


@registry("snap", f"""SELECT {left(VAL[0])} AS before_val, {right(VAL[0])} AS from_val,
    {left(datetime(2023, 1, 1))} AS below_data, {right(datetime(2025, 1, 1))} AS above_data""")
def _(spark, folder):
    ts = F.col("ts")
    return events(spark, folder).agg(
        op.snap_expr(ts, VAL[0], "left").alias("before_val"), op.snap_expr(ts, VAL[0], "right").alias("from_val"),
        op.snap_expr(ts, datetime(2023, 1, 1), "left").alias("below_data"),
        op.snap_expr(ts, datetime(2025, 1, 1), "right").alias("above_data"))


@registry("clamp_range", f"SELECT {right(TRAIN[0])} AS \"start\", {left(TRAIN[1])} AS \"end\"")
def _(spark, folder):
    found = op.clamp_range(events(spark, folder), EVENTS, *TRAIN)
    return spark.createDataFrame([found], "start timestamp_ntz, end timestamp_ntz")


def _counted(name: str, start: str, end: str) -> str:
    return f"""SELECT '{name}' AS split, s AS "start", e AS "end", count(*) AS rows,
      round(100.0 * count(*) / (SELECT count(*) FROM events), 2) AS percent FROM events, (SELECT {start} AS s, {end} AS e)
      WHERE ts BETWEEN s AND e GROUP BY s, e"""


@registry("split_by_dates", " UNION ALL ".join(
    _counted(n, right(r[0]), left(r[1])) for n, r in (("train", TRAIN), ("val", VAL), ("test", TEST))))
def _(spark, folder):
    df = events(spark, folder)
    return op.split_summary(df, EVENTS, op.split_by_dates(df, EVENTS, TRAIN, VAL, TEST))


BY_RATIO = f"""WITH num AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
  size AS (SELECT count(*) AS n, greatest(1, CAST(round_even(count(*) * 0.7, 0) AS BIGINT)) AS a,
    greatest(1, CAST(round_even(count(*) * 0.15, 0) AS BIGINT)) AS b FROM orders),
  bounds AS (SELECT 'train' AS split, 1 AS lo, a AS hi FROM size UNION ALL SELECT 'val', a + 1, a + b FROM size
    UNION ALL SELECT 'test', a + b + 1, n FROM size),
  ranges AS (SELECT split, min(o_orderdate) FILTER (rn = lo) AS s, min(o_orderdate) FILTER (rn = hi) AS e FROM bounds, num GROUP BY split)"""


@registry("split_by_ratio", BY_RATIO + ' SELECT split, s AS "start", e AS "end" FROM ranges')
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    splits = op.split_by_ratio(orders, ORDERS)
    rows = [(n, *splits.ranges[n]) for n in op.SPLITS]
    return spark.createDataFrame(rows, "split string, start timestamp_ntz, end timestamp_ntz")


@registry("count_in_range", f"""SELECT {many(f"count(*) FILTER (ts BETWEEN {sql_ts(r[0])} AND {sql_ts(r[1])}) AS {n}"
    for n, r in (('train', TRAIN), ('val', VAL), ('test', TEST)))} FROM events""")
def _(spark, folder):
    return op.count_in_range(events(spark, folder), EVENTS, {"train": TRAIN, "val": VAL, "test": TEST})


@registry("split_summary", f"""WITH {SPLIT_SQL} SELECT split, min(ts) AS "start", max(ts) AS "end", count(*) AS rows,
    round(100.0 * count(*) / (SELECT count(*) FROM splitted), 2) AS percent FROM splitted GROUP BY split""")
def _(spark, folder):
    df = hourly(spark, folder)
    return op.split_summary(df, HOURLY, hourly_splits(df))


def _assigned(purge: bool) -> str:
    gap = f"""WHEN (ts >= {sql_ts(VAL[0])} - INTERVAL 24 HOUR AND ts < {sql_ts(VAL[0])})
      OR (ts >= {sql_ts(TEST[0])} - INTERVAL 24 HOUR AND ts < {sql_ts(TEST[0])}) THEN 'purge'""" if purge else ""
    cases = " ".join(f"WHEN ts BETWEEN {sql_ts(r[0])} AND {sql_ts(r[1])} THEN '{n}'"
                     for n, r in (("test", FIXED.test), ("val", FIXED.val), ("train", FIXED.train)))
    return f"SELECT event_id, CASE {gap} {cases} ELSE 'other' END AS split FROM events"


FIXED = op.Splits((datetime(2024, 1, 2), TRAIN[1]), VAL, (TEST[0], datetime(2024, 1, 29)), purge_hours=24, mode="dates")


@registry("assign_split", _assigned(False))
def _(spark, folder):
    return op.assign_split(events(spark, folder), EVENTS, FIXED).select("event_id", "split")


@registry("assign_split_purge", _assigned(True))
def _(spark, folder):
    return op.assign_split(events(spark, folder), EVENTS, FIXED, purge=True).select("event_id", "split")


@registry("rolling_origin_folds", " UNION ALL ".join(
    f"SELECT {i} AS fold, '{part}' AS part, {right(r[0])} AS \"start\", {left(r[1])} AS \"end\""
    for i, fold in enumerate(WINDOWS) for part, r in zip(("train", "val"), fold)))
def _(spark, folder):
    folds = op.rolling_origin_folds(events(spark, folder), EVENTS, WINDOWS)
    rows = [(i, part, *fold[part]) for i, fold in enumerate(folds) for part in ("train", "val")]
    return spark.createDataFrame(rows, "fold int, part string, start timestamp_ntz, end timestamp_ntz")


def _manifest_sql() -> str:
    """Every entry of the manifest as a row: splits with counts, folds moved inside the data, and the request."""
    folds = " UNION ALL ".join(
        f"SELECT 'fold {i} {part}' AS entry, (SELECT min(ts) FROM hourly WHERE ts >= {sql_ts(r[0])}) AS \"start\", (SELECT max(ts) FROM hourly WHERE ts <= {sql_ts(r[1])}) AS \"end\", "
        "NULL AS rows, NULL AS percent" for i, fold in enumerate(WINDOWS) for part, r in zip(("train", "val"), fold))
    return f"""WITH {SPLIT_SQL}, entries AS (SELECT split AS entry, min(ts) AS "start", max(ts) AS "end", count(*) AS rows,
      round(100.0 * count(*) / (SELECT count(*) FROM splitted), 2) AS percent FROM splitted GROUP BY split UNION ALL {folds})
      SELECT *, (SELECT count(*) FROM hourly) AS total_rows, 24 AS purge_hours, 'ratios' AS mode, '1,6,12,24' AS horizons, false AS warned FROM entries"""


@registry("splits_manifest", _manifest_sql())
def _(spark, folder):
    df = hourly(spark, folder)
    path = fresh_path(spark, "splits")
    splits = op.make_splits(df, HOURLY, ratios={}, folds=WINDOWS, purge_hours=24)
    manifest = op.splits_manifest(df, HOURLY, splits)
    op.write_manifest(spark, manifest, path)
    again = op.read_manifest(spark, path)
    counts = manifest["summary"]
    rows = [(n, *again.ranges[n], counts[f"{n}_rows"], counts[f"{n}_pct"]) for n in op.SPLITS]
    rows += [(f"fold {i} {part}", *fold[part], None, None) for i, fold in enumerate(again.rolling_cv) for part in ("train", "val")]
    horizons = ",".join(map(str, again.horizons))
    whole = (counts["total_rows"], again.purge_hours, again.mode, horizons, "warning" in manifest)
    return spark.createDataFrame([(*r, *whole) for r in rows], (
        "entry string, start timestamp_ntz, end timestamp_ntz, rows long, percent double, total_rows long, purge_hours int, mode string, "
        "horizons string, warned boolean"))


@registry("assemble_clean", f"WITH {HOURLY_SQL} SELECT ts, {r6('click', 'click')}, {r6('view', 'view')} FROM hourly")
def _(spark, folder):
    df = op.assign_split(hourly(spark, folder), HOURLY, FIXED).select("ts", "click", "view", "split")
    parts = [df.filter(F.col("split") == n).drop("split") for n in ("train", "val", "test", "other")]
    return rounded(assemble_clean(parts, HOURLY))
