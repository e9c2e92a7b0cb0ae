"""Scalar expressions over the event log and the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesprep.catalog.common import HOURLY_SQL, SIGNALS, Registry, hourly, many, r6, rounded, table
from seriesprep.functions import scalars as fn
from seriesprep.sources.hourly import HOURLY

registry = Registry()


@registry("calendar", """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
      CAST(month(ts) AS INTEGER) AS month FROM events""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return fn.with_calendar(events, "ts").drop("ts")


@registry("is_weekend", "SELECT o_orderkey, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders")
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", fn.is_weekend(F.col("o_orderdate")).alias("is_weekend"))


def _turn(what: str, period: int) -> list[str]:
    name = {24: "hour", 7: "dow", 12: "month"}[period]
    return [r6(f"{f}(2.0 * pi() * {what} / {period})", f"{name}_{f}") for f in ("sin", "cos")]


@registry("cyclical", f"""SELECT o_orderkey, {many(_turn('(o_orderkey % 24)', 24) + _turn('(isodow(o_orderdate) - 1)', 7)
    + _turn('(month(o_orderdate) - 1)', 12))} FROM orders""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias("at"),
    )
    return rounded(orders.select("o_orderkey", *[c.alias(n) for n, c in fn.cyclical(F.col("at")).items()]))


@registry("interactions", f"""WITH {HOURLY_SQL} SELECT ts, {r6('click * error', 'click_error')},
    {r6('click * volume', 'click_volume')}, {r6('error * hour(ts)', 'error_hour')} FROM hourly""")
def _(spark, folder):
    df = fn.with_calendar(hourly(spark, folder), "ts")
    pairs = {"click_error": ("click", "error"), "click_volume": ("click", "volume"), "error_hour": ("error", "hour")}
    return rounded(fn.interactions(df, pairs).select("ts", *pairs))


@registry("bin_left_closed", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 30 THEN 1
      WHEN l_quantity IS NOT NULL THEN 2 END AS class FROM lineitem""")
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.bin_left_closed(F.col("l_quantity"), (10, 30)).alias("class"))


@registry("bin_right_closed", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <= 10 THEN 0 WHEN l_quantity <= 30 THEN 1
      WHEN l_quantity IS NOT NULL THEN 2 END AS class,
      CASE WHEN l_quantity <= 10 THEN 'low' WHEN l_quantity <= 30 THEN 'mid' ELSE 'high' END AS class_name FROM lineitem""")
def _(spark, folder):
    label = fn.bin_right_closed(F.col("l_quantity"), (10, 30))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", label.alias("class"), fn.class_name(label).alias("class_name"))


@registry("row_max", f"WITH {HOURLY_SQL} SELECT ts, {r6('greatest(click, error, purchase)', 'top')} FROM hourly")
def _(spark, folder):
    return rounded(hourly(spark, folder).select("ts", fn.row_max(HOURLY.targets).alias("top")))


@registry("text_to_number", """
    SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE value END AS number FROM events""")
def _(spark, folder):
    kind = F.col("event_id") % 3
    shown = F.col("value").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), F.translate(shown, ".", ","), F.lit(" ")))
        .when(kind == 1, shown).otherwise(F.concat(shown, F.lit("d")))
    )
    return table(spark, folder, "events").select("event_id", fn.to_number(text).alias("number"))


@registry("clip_at_zero", f"SELECT event_id, {r6('greatest(value - 20, 0)', 'clipped')} FROM events")
def _(spark, folder):
    return rounded(table(spark, folder, "events").select("event_id", fn.clip_at_zero(F.col("value") - 20).alias("clipped")))


@registry("is_finite", "SELECT event_id, event_id % 4 = 0 AND value IS NOT NULL AS finite FROM events")
def _(spark, folder):
    kind = F.col("event_id") % 4
    odd = (
        F.when(kind == 0, F.col("value")).when(kind == 1, F.lit(float("nan"))).when(kind == 2, F.lit(float("-inf")))
    )
    return table(spark, folder, "events").select("event_id", fn.is_finite(odd).alias("finite"))


@registry("argmax", f"""WITH {HOURLY_SQL} SELECT ts, CASE
    WHEN coalesce(click, -1) >= coalesce(error, -1) AND coalesce(click, -1) >= coalesce(view, -1) THEN 0
    WHEN coalesce(error, -1) >= coalesce(view, -1) THEN 1 ELSE 2 END AS best FROM hourly
    WHERE click IS NOT NULL OR error IS NOT NULL OR view IS NOT NULL""")
def _(spark, folder):
    df = hourly(spark, folder).dropna(how="all", subset=["click", "error", "view"])
    return df.select("ts", fn.argmax(["click", "error", "view"]).alias("best"))
