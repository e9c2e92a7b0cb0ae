"""Lags, leads, rolling statistics, weighted means and the feature tables.

The hourly queries use one window per series (an hour per row is always small). Queries named
``*_long`` take the event log as one long series and run on blocks of rows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.catalog.common import (
    HOURLY_SQL, SIGNALS, SPLIT_SQL, Registry, hourly, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.operators import windows as op
from seriesprep.operators.ewm import ewm_mean
from seriesprep.operators.timeframes import rolling_time
from seriesprep.operators.validate import is_sorted_unique
from seriesprep.plans import feature_store as plan
from seriesprep.sources.hourly import EVENTS, HOURLY
from seriesprep.spec import SeriesSpec

registry = Registry()
BY_KIND = replace(EVENTS, by=("event_type",))
BY_USER = replace(EVENTS, by=("user_id",), layout="auto")
ITEMS = SeriesSpec(
    ts="l_shipdate", by=("l_suppkey",), tiebreak=("l_orderkey", "l_linenumber", "l_partkey"),
    targets=("l_quantity",),
)
ITEM_KEYS = ("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")


def events(spark, folder):
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")


def kept(df, *names):
    return rounded(df.select(*names))


# --- lags and leads ----------------------------------------------------------------------------

def _lags(cols, lags, over="ORDER BY ts", name="{c}_lag_{k}"):
    return many(r6(f"lag({c}, {k}) OVER ({over})", name.format(c=c, k=k)) for c in cols for k in lags)


@registry("lag_features", f"WITH {HOURLY_SQL} SELECT ts, {_lags(SIGNALS, (1, 3, 6, 12, 24, 48))} FROM hourly")
def _(spark, folder):
    df = op.lag_features(hourly(spark, folder), HOURLY, SIGNALS, (1, 3, 6, 12, 24, 48))
    return rounded(df.drop(*SIGNALS))


@registry("lag_features_long", f"SELECT event_id, {_lags(['value'], (1, 6, 48), 'ORDER BY ts, event_id')} FROM events")
def _(spark, folder):
    df = op.lag_features(events(spark, folder), EVENTS, ["value"], (1, 6, 48))
    return rounded(df.drop("ts", "user_id", "event_type", "value"))


@registry("lag_features_by_series", f"""SELECT {many(ITEM_KEYS)},
    {_lags(['l_quantity'], (1, 2), 'PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey')} FROM lineitem""")
def _(spark, folder):
    items = table(spark, folder, "lineitem").select(*ITEM_KEYS, "l_quantity")
    return op.lag_features(items, ITEMS, ["l_quantity"], (1, 2)).drop("l_quantity")


@registry("lead_target", f"WITH {HOURLY_SQL} SELECT ts, "
          + many(r6(f"lead({c}, {h}) OVER (ORDER BY ts)", f"{c}_tplus_{h}") for c in HOURLY.targets for h in (1, 6, 12, 24))
          + " FROM hourly")
def _(spark, folder):
    df = op.lead_target(hourly(spark, folder), HOURLY, HOURLY.targets, (1, 6, 12, 24))
    return rounded(df.drop(*SIGNALS))


@registry("lead_target_long", """
    SELECT event_id, lead(value, 24) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS value_tplus_24 FROM events""")
def _(spark, folder):
    return op.lead_target(events(spark, folder), BY_KIND, ["value"], [24]).select("event_id", "value_tplus_24")


# --- row frames ----------------------------------------------------------------------------------

def _roll(cols, sizes, over="ORDER BY ts"):
    frame = "({o} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    return many(
        r6(f"{f}({c}) OVER {frame.format(o=over, w=w)}", f"{c}_roll{w}_{s}")
        for c in cols for w in sizes for f, s in (("avg", "mean"), ("stddev_pop", "std"))
    )


@registry("rolling_past", f"WITH {HOURLY_SQL} SELECT ts, {_roll(SIGNALS, (3, 6, 12, 24))} FROM hourly")
def _(spark, folder):
    return rounded(op.rolling_past(hourly(spark, folder), HOURLY, SIGNALS).drop(*SIGNALS))


@registry("rolling_past_long", f"SELECT event_id, {_roll(['value'], (3, 24), 'ORDER BY ts, event_id')} FROM events")
def _(spark, folder):
    df = op.rolling_past(events(spark, folder), EVENTS, ["value"], (3, 24))
    return rounded(df.drop("ts", "user_id", "event_type", "value"))


def _ma(cols, sizes, strict, name):
    out = []
    for c in cols:
        for w in sizes:
            frame = f"(ORDER BY ts ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            mean = f"avg({c}) OVER {frame}"
            if strict:
                mean = f"CASE WHEN count({c}) OVER {frame} = {w} THEN {mean} END"
            out.append(r6(mean, name.format(c=c, w=w)))
    return many(out)


@registry("moving_average_strict", f"WITH {HOURLY_SQL} SELECT ts, {_ma(['click', 'view'], (3, 6, 12, 24), True, '{c}_ma_{w}')} FROM hourly")
def _(spark, folder):
    df = op.moving_average(hourly(spark, folder), HOURLY, ["click", "view"], strict=True, name="{c}_ma_{w}")
    return rounded(df.drop(*SIGNALS))


@registry("moving_average", f"WITH {HOURLY_SQL} SELECT ts, {_ma(SIGNALS, (3, 6, 12, 24), False, '{c}_MA{w}')} FROM hourly")
def _(spark, folder):
    return rounded(op.moving_average(hourly(spark, folder), HOURLY, SIGNALS).drop(*SIGNALS))


@registry("rolling_stats", f"""WITH {HOURLY_SQL}, r AS (SELECT ts, count(click) OVER f AS n, avg(click) OVER f AS m, stddev_samp(click) OVER f AS s
    FROM hourly WINDOW f AS (ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
    SELECT ts, {r6('m', 'rolling_mean')}, {r6('s', 'rolling_std')} FROM r WHERE n >= 8 AND s IS NOT NULL""")
def _(spark, folder):
    return rounded(op.rolling_stats(hourly(spark, folder), HOURLY, "click"))


@registry("diff1", f"WITH {HOURLY_SQL} SELECT ts, "
          + many(r6(f"{c} - lag({c}, 1) OVER (ORDER BY ts)", f"{c}_diff_1") for c in HOURLY.features) + " FROM hourly")
def _(spark, folder):
    return rounded(op.diff1(hourly(spark, folder), HOURLY, HOURLY.features).drop(*SIGNALS))


def zscore_sql(c: str, source: str, keys: str, order: str) -> str:
    return f"""SELECT {keys}, CASE WHEN {c} IS NULL OR n < 12 THEN NULL WHEN s > 0 THEN CAST(abs({c} - m) > 3.0 * s AS DOUBLE)
      WHEN {c} <> lo THEN 1.0 END AS {c}_is_anom
      FROM (SELECT *, avg({c}) OVER f AS m, stddev_pop({c}) OVER f AS s, count({c}) OVER f AS n, min({c}) OVER f AS lo
        FROM {source} WINDOW f AS ({order} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))"""


@registry("zscore_flag_past", f"WITH {HOURLY_SQL} " + zscore_sql("click", "hourly", "ts", "ORDER BY ts"))
def _(spark, folder):
    return op.zscore_flag_past(hourly(spark, folder), HOURLY, ["click"]).select("ts", "click_is_anom")


@registry("zscore_flag_past_long", zscore_sql("value", "events", "event_id", "PARTITION BY event_type ORDER BY ts, event_id"))
def _(spark, folder):
    return op.zscore_flag_past(events(spark, folder), BY_KIND, ["value"]).select("event_id", "value_is_anom")


@registry("anomalous_hours_per_day", f"""WITH {HOURLY_SQL}, flags AS (
    {' UNION ALL '.join("SELECT ts, '" + c + "' AS signal, " + c + "_is_anom AS flag FROM (" + zscore_sql(c, 'hourly', 'ts', 'ORDER BY ts') + ")" for c in SIGNALS)})
    SELECT CAST(ts AS DATE) AS day, signal, CAST(coalesce(sum(flag), 0) AS BIGINT) AS n_anomalies, count(flag) AS n_known
    FROM flags GROUP BY 1, 2""")
def anomalous_hours_per_day(spark, folder):
    flagged = op.zscore_flag_past(hourly(spark, folder), HOURLY, SIGNALS)
    cells = F.array(*[F.struct(F.lit(c).alias("signal"), F.col(f"{c}_is_anom").alias("flag")) for c in SIGNALS])
    long = flagged.select("ts", F.explode(cells).alias("c")).select("ts", "c.signal", "c.flag")
    return long.groupBy(F.to_date("ts").alias("day"), "signal").agg(
        F.coalesce(F.sum("flag"), F.lit(0.0)).cast("long").alias("n_anomalies"), F.count("flag").alias("n_known"))


# --- time-range frames -----------------------------------------------------------------------------

def _range_sql(c: str, source: str, key: str, minimum: int, part: str = "") -> str:
    return f"""SELECT {key}, {r6(f'CASE WHEN n >= {minimum} THEN m END', f'{c}_mean_24h')}, {r6(f'CASE WHEN n >= {minimum} THEN s END', f'{c}_std_24h')}
      FROM (SELECT *, count({c}) OVER f AS n, avg({c}) OVER f AS m, stddev_samp({c}) OVER f AS s FROM {source}
        WINDOW f AS ({part} ORDER BY ts RANGE BETWEEN INTERVAL '23 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW))"""


@registry("rolling_time", f"WITH {HOURLY_SQL} " + _range_sql("click", "hourly", "ts", 12))
def _(spark, folder):
    df = rolling_time(hourly(spark, folder), HOURLY, ["click"], 24, 12)
    return kept(df, "ts", "click_mean_24h", "click_std_24h")


@registry("rolling_time_by_series", _range_sql("value", "events", "event_id", 1, "PARTITION BY user_id"))
def _(spark, folder):
    df = rolling_time(events(spark, folder), BY_USER, ["value"])
    return kept(df, "event_id", "value_mean_24h", "value_std_24h")


@registry("rolling_time_dense", _range_sql("value", "events", "event_id", 1))
def _(spark, folder):
    df = rolling_time(events(spark, folder), EVENTS, ["value"])
    return kept(df, "event_id", "value_mean_24h", "value_std_24h")


# --- unbounded past ----------------------------------------------------------------------------------

SPANS = (6, 12, 24)


def _ewm_recursive() -> str:
    """Weighted means step by step, for the short hourly series with nulls."""
    cells = [(c, s, f"{2.0 / (s + 1)!r}") for c in SIGNALS for s in SPANS]
    first = many(f"{c} AS y_{c}_{s}, CAST(1.0 AS DOUBLE) AS w_{c}_{s}" for c, s, _ in cells)
    step = many(
        f"CASE WHEN n.{c} IS NULL THEN y_{c}_{s} WHEN y_{c}_{s} IS NULL THEN n.{c} ELSE "
        f"(w_{c}_{s} * (1 - {a}) * y_{c}_{s} + {a} * n.{c}) / (w_{c}_{s} * (1 - {a}) + {a}) END, "
        f"CASE WHEN n.{c} IS NULL THEN w_{c}_{s} * (1 - {a}) ELSE 1.0 END" for c, s, a in cells
    )
    shown = many(r6(f"y_{c}_{s}", f"{c}_ewm{s}_mean") for c, s, _ in cells)
    return f"""WITH RECURSIVE {HOURLY_SQL}, num AS (SELECT *, row_number() OVER (ORDER BY ts) AS rn FROM hourly),
      rec AS (SELECT rn, {first} FROM num WHERE rn = 1
        UNION ALL SELECT n.rn, {step} FROM rec r JOIN num n ON n.rn = r.rn + 1)
      SELECT num.ts, {shown} FROM num LEFT JOIN rec ON rec.rn = num.rn - 1"""


def _ewm_closed() -> str:
    """Weighted means as sums over all earlier rows, for a series without nulls."""
    sums = many(
        r6(f"sum(b.value * power(1 - {a!r}, a.rn - 1 - b.rn) * CASE WHEN b.rn = 1 THEN 1.0 ELSE {a!r} END)", f"value_ewm{s}_mean")
        for s in SPANS for a in [2.0 / (s + 1)]
    )
    return f"""WITH num AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)
      SELECT a.event_id, {sums} FROM num a LEFT JOIN num b ON b.rn < a.rn GROUP BY a.event_id"""


@registry("ewm_mean", _ewm_recursive())
def _(spark, folder):
    return rounded(ewm_mean(hourly(spark, folder), HOURLY, SIGNALS).drop(*SIGNALS))


@registry("ewm_mean_long", _ewm_closed())
def _(spark, folder):
    df = ewm_mean(events(spark, folder), EVENTS, ["value"])
    return rounded(df.drop("ts", "user_id", "event_type", "value"))


@registry("row_index", f"WITH {HOURLY_SQL} SELECT ts, row_number() OVER (ORDER BY ts) AS rn FROM hourly")
def _(spark, folder):
    return layout.row_index(hourly(spark, folder).select("ts"), HOURLY)


@registry("row_index_long", "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events")
def _(spark, folder):
    return layout.row_index(events(spark, folder), BY_KIND).select("event_id", "rn")


@registry("is_sorted_unique", """
    SELECT (SELECT count(*) FROM (SELECT o_orderdate FROM orders GROUP BY 1 HAVING count(*) > 1)) AS repeated_times,
      (SELECT count(*) FROM (SELECT o_orderdate AS t, lag(o_orderdate) OVER (ORDER BY o_orderkey) AS p FROM orders) WHERE t < p) AS out_of_order""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return is_sorted_unique(orders, SeriesSpec(ts="o_orderdate", layout="blocked"), "o_orderkey")


# --- feature tables ------------------------------------------------------------------------------------

def _calendar_sql() -> str:
    turn = [("hour", "hour(ts)", 24), ("dow", "(isodow(ts) - 1)", 7), ("month", "(month(ts) - 1)", 12)]
    waves = [r6(f"{f}(2.0 * pi() * {e} / {p})", f"{n}_{f}") for n, e, p in turn for f in ("sin", "cos")]
    return many([
        "CAST(hour(ts) AS INTEGER) AS hour", "CAST(isodow(ts) - 1 AS INTEGER) AS dow",
        "CAST(month(ts) AS INTEGER) AS month", "CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend", *waves,
    ])


def _flag_expr(c: str) -> str:
    f = "(ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
    return f"""CASE WHEN {c} IS NULL OR count({c}) OVER {f} < 12 THEN NULL
      WHEN stddev_pop({c}) OVER {f} > 0 THEN CAST(abs({c} - avg({c}) OVER {f}) > 3.0 * stddev_pop({c}) OVER {f} AS DOUBLE)
      WHEN {c} <> min({c}) OVER {f} THEN 1.0 END AS {c}_is_anom"""


@registry("feature_store", f"""WITH {HOURLY_SQL} SELECT ts, {many(r6(c, c) for c in SIGNALS)}, {_calendar_sql()},
    {_lags(SIGNALS, range(1, 49))}, {_roll(SIGNALS, (3, 6, 12, 24))},
    {many(r6(f"{c} - lag({c}, 1) OVER (ORDER BY ts)", f"{c}_diff_1") for c in HOURLY.features)},
    {many(_flag_expr(c) for c in HOURLY.targets)} FROM hourly""")
def _(spark, folder):
    return rounded(plan.feature_store(hourly(spark, folder), HOURLY, spans=()))


@registry("feature_store_full")
def _(spark, folder):
    return rounded(plan.feature_store(hourly(spark, folder), HOURLY))


@registry("feature_store_long", f"""
    SELECT ts, event_id, value, {_calendar_sql()}, {_lags(['value'], (1, 2, 3), 'ORDER BY ts, event_id')},
      {_roll(['value'], (3, 24), 'ORDER BY ts, event_id')},
      {_flag_expr('value').replace('ORDER BY ts', 'ORDER BY ts, event_id')} FROM events""")
def _(spark, folder):
    return rounded(plan.feature_store(events(spark, folder), EVENTS, max_lag=3, roll=(3, 24), spans=()))


def _split_over(body: str) -> str:
    return body.replace("ORDER BY ts", "PARTITION BY split ORDER BY ts")


@registry("temporal_features", f"""WITH {SPLIT_SQL} SELECT ts, split, {many(r6(c, c) for c in SIGNALS)},
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
    {_split_over(_lags(SIGNALS, (1, 3, 6, 12, 24), name='{c}_lag{k}'))},
    {_split_over(_ma(SIGNALS, (3, 6, 12, 24), False, '{c}_MA{w}'))} FROM splitted""")
def _(spark, folder):
    return rounded(plan.temporal_features(hourly_with_split(spark, folder), HOURLY.keyed("split")))


@registry("tree_features", f"""WITH {SPLIT_SQL} SELECT ts, split, {r6('click', 'click')},
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(month(ts) AS INTEGER) AS month,
    {_split_over(_lags(['click'], (1, 6, 12, 24)))}, {_split_over(_ma(['click'], (3, 6, 12, 24), True, '{c}_ma_{w}'))} FROM splitted""")
def _(spark, folder):
    df = hourly_with_split(spark, folder).select("ts", "split", "click")
    return rounded(plan.tree_features(df, HOURLY.keyed("split"), "click"))


def _between(c: str) -> str:
    """Linear in time between the known neighbours of the split, constant beyond them."""
    at = f"CASE WHEN {c} IS NOT NULL THEN epoch_us(ts) END"
    back = "(PARTITION BY split ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "(PARTITION BY split ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    p, n = f"last_value({c} IGNORE NULLS) OVER {back}", f"first_value({c} IGNORE NULLS) OVER {ahead}"
    pt, nt = f"last_value({at} IGNORE NULLS) OVER {back}", f"first_value({at} IGNORE NULLS) OVER {ahead}"
    return r6(f"coalesce({c}, {p} + ({n} - {p}) * (epoch_us(ts) - {pt}) / nullif({nt} - {pt}, 0), {p}, {n})", c)


@registry("boosting_features", f"""WITH {SPLIT_SQL}, lagged AS (SELECT *, {many(
      f"lag({c}, 1) OVER (PARTITION BY split ORDER BY ts) AS {c}_lag1" for c in HOURLY.targets)} FROM splitted)
    SELECT ts, split, {many(_between(c) for c in (*HOURLY.features, *[f'{t}_lag1' for t in HOURLY.targets]))} FROM lagged""")
def _(spark, folder):
    df, names = plan.boosting_features(hourly_with_split(spark, folder), HOURLY.keyed("split"), HOURLY.targets)
    return rounded(df.select("ts", "split", *[n for n in names if n not in ("hour", "weekday", "month")]))
