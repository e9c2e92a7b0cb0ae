"""Filling along time and with training parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    HOURLY_SQL, SIGNALS, SPLIT_SQL, Registry, hourly, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.operators import impute as op
from seriesprep.sources.hourly import EVENTS, HOURLY
from seriesprep.workspace import fresh_path

registry = Registry()
GAPPY = ("click", "error", "purchase", "signup", "view")


def gappy_events(spark, folder):
    """The event log with the values of most kinds blanked, so gaps reach over many rows."""
    known = (F.col("event_type") == "view") & (F.col("event_id") >= 5)
    return table(spark, folder, "events").select("event_id", "ts", F.when(known, F.col("value")).alias("value"))


GAPPY_SQL = """gappy AS (SELECT event_id, ts,
  CASE WHEN event_type = 'view' AND event_id >= 5 THEN value END AS value FROM events)"""


def _fill(c: str, forward: bool, order: str = "ts") -> str:
    if forward:
        return f"last_value({c} IGNORE NULLS) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"first_value({c} IGNORE NULLS) OVER (ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@registry("ffill", f"WITH {HOURLY_SQL} SELECT ts, {many(r6(_fill(c, True), c) for c in GAPPY)} FROM hourly")
def _(spark, folder):
    return rounded(op.ffill(hourly(spark, folder).select("ts", *GAPPY), HOURLY, GAPPY))


@registry("ffill_long", f"WITH {GAPPY_SQL} SELECT event_id, ts, {_fill('value', True, 'ts, event_id')} AS value FROM gappy")
def _(spark, folder):
    return op.ffill(gappy_events(spark, folder), EVENTS, ["value"])


@registry("bfill", f"WITH {HOURLY_SQL} SELECT ts, {many(r6(_fill(c, False), c) for c in GAPPY)} FROM hourly")
def _(spark, folder):
    return rounded(op.bfill(hourly(spark, folder).select("ts", *GAPPY), HOURLY, GAPPY))


@registry("bfill_long", f"WITH {GAPPY_SQL} SELECT event_id, ts, {_fill('value', False, 'ts, event_id')} AS value FROM gappy")
def _(spark, folder):
    return op.bfill(gappy_events(spark, folder), EVENTS, ["value"])


def _interpolate(cols, source: str, keys: str, order: str) -> str:
    known = many(
        f"{_fill(c, True, order)} AS p{i}, {_fill(c, False, order)} AS n{i}, "
        f"{_fill(f'CASE WHEN {c} IS NOT NULL THEN epoch_us(ts) END', True, order)} AS pt{i}, "
        f"{_fill(f'CASE WHEN {c} IS NOT NULL THEN epoch_us(ts) END', False, order)} AS nt{i}"
        for i, c in enumerate(cols)
    )
    blend = many(
        r6(f"coalesce({c}, p{i} + (n{i} - p{i}) * (epoch_us(ts) - pt{i}) / nullif(nt{i} - pt{i}, 0), p{i}, n{i})", c)
        for i, c in enumerate(cols)
    )
    return f"SELECT {keys}, {blend} FROM (SELECT *, {known} FROM {source})"


@registry("interpolate_time", f"WITH {HOURLY_SQL} " + _interpolate(GAPPY, "hourly", "ts", "ts"))
def _(spark, folder):
    return rounded(op.interpolate_time(hourly(spark, folder).select("ts", *GAPPY), HOURLY, GAPPY))


@registry("interpolate_time_long", f"WITH {GAPPY_SQL} " + _interpolate(["value"], "gappy", "event_id, ts", "ts, event_id"))
def _(spark, folder):
    return rounded(op.interpolate_time(gappy_events(spark, folder), EVENTS, ["value"]))


@registry("fill_rolling", f"""WITH {HOURLY_SQL}, filled AS (SELECT ts, {many(f"{_fill(c, True)} AS {c}" for c in GAPPY)} FROM hourly)
    SELECT ts, {many(r6(f"coalesce({c}, avg({c}) OVER (ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))", c) for c in GAPPY)} FROM filled""")
def _(spark, folder):
    return rounded(op.fill_rolling(hourly(spark, folder).select("ts", *GAPPY), HOURLY, GAPPY))


@registry("impute_features", f"WITH {HOURLY_SQL} SELECT ts, {many(r6(c, c) for c in HOURLY.targets)}, "
          + many(r6(_fill(c, True), c) for c in HOURLY.features) + " FROM hourly")
def _(spark, folder):
    return rounded(op.impute_features(hourly(spark, folder), HOURLY, "ffill"))


@registry("impute_features_filled", f"WITH {HOURLY_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) - count(*) FILTER (f_{c} IS NULL) AS filled FROM (SELECT *, {_fill(c, True)} AS f_{c} FROM hourly)"
    for c in HOURLY.features))
def _(spark, folder):
    df = hourly(spark, folder)
    return op.filled_counts(df, op.impute_features(df, HOURLY, "ffill+rolling"), HOURLY.features)


def _fitted(fn: str) -> str:
    params = many(f"{fn}({c}) FILTER (split = 'train') AS m_{c}" for c in SIGNALS)
    return f"WITH {SPLIT_SQL}, fit AS (SELECT {params} FROM splitted) SELECT ts, split, " + many(
        r6(f"coalesce({c}, m_{c})", c) for c in SIGNALS) + " FROM splitted, fit"


def train_rows(df):
    return df.filter(F.col("split") == "train")


@registry("impute_mean", _fitted("avg"))
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return rounded(op.impute_mean(df, train_rows(df), SIGNALS)[0])


@registry("impute_median", _fitted("median"))
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return rounded(op.impute_median(df, train_rows(df), SIGNALS)[0])


@registry("impute_saved", _fitted("avg"))
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    path = fresh_path(spark, "means")
    op.params_table(df, op.fit_means(train_rows(df), SIGNALS)).write.json(path)
    saved = op.params_from(spark.read.schema("column string, value double").json(path))
    return rounded(op.impute_saved(df, saved))


@registry("impute_constant", f"WITH {HOURLY_SQL} SELECT ts, {many(r6(f'coalesce({c}, 0)', c) for c in SIGNALS)} FROM hourly")
def _(spark, folder):
    return rounded(op.impute_constant(hourly(spark, folder), SIGNALS))


@registry("exact_median", """
    SELECT median(l_extendedprice) AS l_extendedprice, median(l_quantity) AS l_quantity FROM lineitem""")
def _(spark, folder):
    found = op.fit_medians(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    return spark.createDataFrame([tuple(found.values())], list(found))
