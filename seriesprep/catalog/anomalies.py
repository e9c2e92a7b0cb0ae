"""Residual flags, isolation forest and the filter chain."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    HOURLY_SQL, SIGNALS, SPLIT_SQL, Registry, hourly, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.models.isolation import IsolationForest
from seriesprep.operators import anomaly as op
from seriesprep.sources.hourly import EVENTS, HOURLY

registry = Registry()
FRAME = "RANGE BETWEEN INTERVAL '23 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW"


def _flag(c: str, over: str, minimum: int) -> str:
    return (
        f"CAST(coalesce(count({c}) OVER {over} >= {minimum} AND abs({c} - CASE WHEN stddev_samp({c}) OVER {over} = 0 "
        f"THEN min({c}) OVER {over} ELSE avg({c}) OVER {over} END) > 3.0 * stddev_samp({c}) OVER {over}, FALSE) AS INTEGER)"
    )


SPLIT_FRAME = f"(PARTITION BY split ORDER BY ts {FRAME})"
FLAGGED_SQL = SPLIT_SQL + ", flagged AS (SELECT ts, split, " + many(
    f"{_flag(c, SPLIT_FRAME, 12)} AS an_resid_{c}" for c in HOURLY.targets) + " FROM splitted)"
ANY = f"greatest({many(f'an_resid_{c}' for c in HOURLY.targets)})"


@registry("residual_flag", f"WITH {FLAGGED_SQL} SELECT * FROM flagged")
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return op.residual_flag(df, HOURLY.keyed("split"), HOURLY.targets).drop(*SIGNALS)


@registry("residual_flag_no_minimum", f"""WITH {HOURLY_SQL} SELECT ts, {_flag('peak', f'(ORDER BY ts {FRAME})', 1)} AS an_resid_peak FROM hourly""")
def _(spark, folder):
    df = hourly(spark, folder).select("ts", "peak")
    return op.residual_flag(df, HOURLY, ["peak"], min_periods=1).drop("peak")


@registry("residual_flag_long", f"""SELECT event_id, {_flag('value', f'(PARTITION BY event_type ORDER BY ts {FRAME})', 12)} AS an_resid_value FROM events""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    spec = replace(EVENTS, by=("event_type",))
    return op.residual_flag(events, spec, ["value"]).select("event_id", "an_resid_value")


@registry("any_flag", f"WITH {FLAGGED_SQL} SELECT *, {ANY} AS an_any FROM flagged")
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return op.any_flag(op.residual_flag(df, HOURLY.keyed("split"), HOURLY.targets)).drop(*SIGNALS)


def flagged(spark, folder, isolation: bool):
    df = hourly_with_split(spark, folder)
    return op.anomaly_flags(df, HOURLY, HOURLY.features, isolation=isolation)


@registry("anomaly_filter", f"""WITH {FLAGGED_SQL} SELECT ts, split, {many(r6(c, c) for c in SIGNALS)}
    FROM splitted JOIN flagged USING (ts, split) WHERE {ANY} = 0""")
def _(spark, folder):
    return rounded(op.anomaly_filter(flagged(spark, folder, False)).select("ts", "split", *SIGNALS))


@registry("anomaly_counts", f"""WITH {FLAGGED_SQL} SELECT split, count(*) AS rows, count(*) FILTER ({ANY} = 0) AS kept,
    count(*) FILTER ({ANY} <> 0) AS dropped, {many(f'CAST(sum(an_resid_{c}) AS BIGINT) AS n_an_resid_{c}' for c in HOURLY.targets)},
    CAST(sum({ANY}) AS BIGINT) AS n_an_any FROM flagged GROUP BY split""")
def _(spark, folder):
    return op.anomaly_counts(flagged(spark, folder, False))


@registry("anomaly_chain_with_isolation")
def _(spark, folder):
    return op.anomaly_counts(flagged(spark, folder, True))


def _scored_lines(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    forest = IsolationForest(features).fit(items.filter(F.col("l_returnflag") != "R"))
    return forest.transform(items, "an_iso")


# the threshold is the 0.98 quantile of the training scores, so one row in fifty lies above it
@registry("isolation_forest_share", "SELECT count(*) AS n, CAST(0.02 AS DOUBLE) AS share FROM lineitem WHERE l_returnflag <> 'R'")
def _(spark, folder):
    train = _scored_lines(spark, folder).filter(F.col("l_returnflag") != "R")
    return train.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("an_iso"), 2).alias("share"))


@registry("isolation_forest")
def _(spark, folder):
    return _scored_lines(spark, folder).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("an_iso").alias("n_iso"))
