"""Labels, baselines, scaling and class weights."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seriesprep.catalog.common import (
    EDGES, HORIZONS, HOURLY_SQL, SIGNALS, SPLIT_SQL, Registry, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.metrics import macro_scores
from seriesprep.operators import labels as op
from seriesprep.sources.hourly import EVENTS, HOURLY

registry = Registry()
KEYED = HOURLY.keyed("split")
TARGETS = HOURLY.targets
OVER = "(PARTITION BY split ORDER BY ts)"


def ahead(c: str, h: int, over: str = OVER) -> str:
    return f"lead({c}, {h}) OVER {over}"


def left_class(x: str) -> str:
    return f"CASE WHEN {x} < {EDGES[0]} THEN 0 WHEN {x} < {EDGES[1]} THEN 1 WHEN {x} IS NOT NULL THEN 2 END"


def right_class(x: str) -> str:
    return f"CASE WHEN {x} <= {EDGES[0]} THEN 0 WHEN {x} <= {EDGES[1]} THEN 1 WHEN {x} IS NOT NULL THEN 2 END"


@registry("label_regression", f"""WITH {SPLIT_SQL}, led AS (SELECT ts, split, click, {ahead('click', 6)} AS y FROM splitted)
    SELECT ts, split, {r6('y', 'y')}, {r6('click', 'y_naive')} FROM led WHERE y IS NOT NULL AND click IS NOT NULL""")
def _(spark, folder):
    df = op.label_regression(hourly_with_split(spark, folder), KEYED, "click", 6)
    return rounded(df.select("ts", "split", "y", "y_naive"))


@registry("label_regression_long", """
    SELECT event_id, y, value AS y_naive FROM (SELECT *, lead(value, 12) OVER (ORDER BY ts, event_id) AS y FROM events)
    WHERE y IS NOT NULL AND value IS NOT NULL""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return op.label_regression(events, EVENTS, "value", 12).select("event_id", "y", "y_naive")


def _multi(current: bool) -> str:
    led = many(f"{ahead(t, 12)} AS y_{t}" for t in TARGETS)
    keep = " AND ".join([f"y_{t} IS NOT NULL" for t in TARGETS] + ([f"{t} IS NOT NULL" for t in TARGETS] if current else []))
    shown = many([r6(f"y_{t}", f"y__{t}") for t in TARGETS] + [r6(t, f"y_naive__{t}") for t in TARGETS])
    return f"WITH {SPLIT_SQL}, led AS (SELECT *, {led} FROM splitted) SELECT ts, split, {shown} FROM led WHERE {keep}"


@registry("label_multi", _multi(True))
def _(spark, folder):
    return rounded(op.label_multi(hourly_with_split(spark, folder), KEYED, TARGETS, 12).drop(*SIGNALS))


@registry("label_multi_scoring", _multi(False))
def _(spark, folder):
    df = op.label_multi(hourly_with_split(spark, folder), KEYED, TARGETS, 12, require_current=False)
    return rounded(df.drop(*SIGNALS))


@registry("label_class", f"""WITH {SPLIT_SQL}, led AS (SELECT ts, split, {left_class('click')} AS y_naive, {left_class(ahead('click', 6))} AS y FROM splitted)
    SELECT ts, split, y, y_naive FROM led WHERE y IS NOT NULL AND y_naive IS NOT NULL""")
def _(spark, folder):
    df = op.label_class(hourly_with_split(spark, folder), KEYED, "click", 6, EDGES)
    return df.select("ts", "split", "y", "y_naive")


@registry("label_horizons", f"""WITH {SPLIT_SQL} SELECT ts, split, {many(r6(ahead(t, h), f'{t}_tplus_{h}') for t in TARGETS for h in HORIZONS)} FROM splitted""")
def _(spark, folder):
    return rounded(op.label_horizons(hourly_with_split(spark, folder), KEYED, TARGETS).drop(*SIGNALS))


@registry("label_horizons_class", f"""WITH {SPLIT_SQL} SELECT ts, split, {many(f"{right_class(ahead('click', h))} AS y_{h}h" for h in HORIZONS)} FROM splitted""")
def _(spark, folder):
    df = op.label_horizons(hourly_with_split(spark, folder), KEYED, ["click"], edges=EDGES, name="y_{h}h")
    return df.drop(*SIGNALS)


@registry("label_single", f"""WITH {SPLIT_SQL}, led AS (SELECT ts, split, {ahead('view', 24)} AS y FROM splitted)
    SELECT ts, split, {r6('y', 'view_target')} FROM led WHERE y IS NOT NULL""")
def _(spark, folder):
    df = op.label_single(hourly_with_split(spark, folder), KEYED, "view", 24)
    return rounded(df.select("ts", "split", "view_target"))


def _baseline(back: int) -> str:
    cells = []
    for t in TARGETS:
        for h in HORIZONS:
            naive = f"lag({t}, {back}) OVER {OVER}" if back else t
            cells.append(f"SELECT split, '{t}' AS target, {h} AS horizon, {ahead(t, h)} AS y, {naive} AS p FROM splitted")
    return f"""WITH {SPLIT_SQL}, f AS ({' UNION ALL '.join(cells)})
      SELECT split, target, horizon, count(y + p) AS n, {r6('sqrt(avg((y - p) * (y - p)))', 'rmse')} FROM f GROUP BY ALL"""


@registry("baseline_persistence", _baseline(0))
def _(spark, folder):
    return rounded(op.baseline_persistence(hourly_with_split(spark, folder), KEYED, TARGETS, group=["split"]))


@registry("baseline_seasonal", _baseline(24))
def _(spark, folder):
    return rounded(op.baseline_seasonal(hourly_with_split(spark, folder), KEYED, TARGETS, group=["split"]))


@registry("baseline_seasonal_long", f"""
    SELECT target, horizon, count(y + p) AS n, {r6('sqrt(avg((y - p) * (y - p)))', 'rmse')} FROM (
      SELECT 'value' AS target, h AS horizon, CASE h WHEN 1 THEN l1 ELSE l6 END AS y, p FROM (
        SELECT lead(value, 1) OVER o AS l1, lead(value, 6) OVER o AS l6, lag(value, 24) OVER o AS p FROM events
        WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id)), (VALUES (1), (6)) AS hs(h)) GROUP BY ALL""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return rounded(op.baseline_seasonal(events, replace(EVENTS, by=("event_type",)), ["value"], (1, 6)))


@registry("baseline_persistence_class", f"""WITH {SPLIT_SQL}, f AS ({' UNION ALL '.join(
      f"SELECT split, {h} AS horizon, {right_class(ahead('click', h))} AS y, {right_class('click')} AS p FROM splitted" for h in HORIZONS)})
    SELECT split, horizon, y, p, count(*) AS n FROM f WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY ALL""")
def _(spark, folder):
    long = op.baseline_persistence_class(hourly_with_split(spark, folder), KEYED, "click", edges=EDGES, group=["split"])
    return long.groupBy("split", "horizon", "y", "p").agg(F.count(F.lit(1)).alias("n"))


@registry("baseline_class_scores", f"""WITH {SPLIT_SQL}, f AS ({' UNION ALL '.join(
      f"SELECT {h} AS horizon, {right_class(ahead('click', h))} AS y, {right_class('click')} AS p FROM splitted" for h in HORIZONS)}),
    known AS (SELECT * FROM f WHERE y IS NOT NULL AND p IS NOT NULL),
    c AS (SELECT horizon, k AS label, count(*) FILTER (y = k AND p = k) AS tp, count(*) FILTER (y = k) AS s, count(*) FILTER (p = k) AS q
      FROM known, (VALUES (0), (1), (2)) AS ks(k) GROUP BY ALL)
    SELECT horizon, CAST(sum(s) AS BIGINT) AS n, {r6('sum(tp) / sum(s)', 'accuracy')}, {r6('avg(coalesce(2.0 * tp / nullif(q + s, 0), 0))', 'macro_f1')},
      {r6('avg(coalesce(tp / nullif(CAST(s AS DOUBLE), 0), 0))', 'macro_recall')} FROM c WHERE s + q > 0 GROUP BY horizon""")
def _(spark, folder):
    long = op.baseline_persistence_class(hourly_with_split(spark, folder), KEYED, "click", edges=EDGES)
    return rounded(macro_scores(long, group=["horizon"]))


def train_rows(df):
    return df.filter(F.col("split") == "train")


def _scaled(cols, suffix: str, tiny: float) -> str:
    fit = many(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    shown = many(r6(f"({c} - m_{c}) / CASE WHEN s_{c} <= {tiny} THEN 1 ELSE s_{c} END", c + suffix) for c in cols)
    return f"WITH {SPLIT_SQL}, fit AS (SELECT {fit} FROM splitted WHERE split = 'train') SELECT ts, split, {shown} FROM splitted, fit"


@registry("normalize_target", _scaled(TARGETS, "_n", 1e-6))
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return rounded(op.normalize_target(df, train_rows(df), TARGETS)[0].drop(*SIGNALS))


@registry("normalize_target_inverse", f"WITH {SPLIT_SQL} SELECT ts, split, {many(r6(t, f'{t}_n') for t in TARGETS)} FROM splitted")
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    scaled, params = op.normalize_target(df, train_rows(df), TARGETS)
    return rounded(op.undo_scale(scaled, {f"{t}_n": t for t in TARGETS}, params).drop(*SIGNALS))


@registry("standard_scale", _scaled(SIGNALS, "", 0))
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return rounded(op.standard_scale(df, train_rows(df), SIGNALS)[0])


@registry("class_weights", f"""WITH c AS (SELECT CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 30 THEN 1 ELSE 2 END AS y, count(*) AS n
    FROM lineitem GROUP BY 1) SELECT y, n, {r6('(SELECT sum(n) FROM c) / (3.0 * n)', 'weight')} FROM c""")
def _(spark, folder):
    from seriesprep.functions.scalars import bin_left_closed

    items = table(spark, folder, "lineitem").select(bin_left_closed(F.col("l_quantity"), (10, 30)).alias("y"))
    return rounded(op.class_weights(items))
