"""Scores and result tables over naive forecasts of the whole event log."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seriesprep import metrics as op
from seriesprep.catalog.common import (
    HORIZONS, Registry, SPLIT_SQL, hourly_with_split, many, r6, rounded, table,
)
from seriesprep.functions.scalars import bin_right_closed
from seriesprep.operators.labels import baseline_persistence, baseline_seasonal, label_regression
from seriesprep.sources.hourly import EVENTS, HOURLY

registry = Registry()
BY_KIND = replace(EVENTS, by=("event_type",))
KEYED = HOURLY.keyed("split")
CUTS = (20.0, 45.0)

PRED = """pred AS (SELECT event_id, ts, event_type, y AS y_true, value AS y_pred FROM (
  SELECT *, lead(value, 1) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS y FROM events) WHERE y IS NOT NULL AND value IS NOT NULL)"""


def _class(x: str) -> str:
    return f"CASE WHEN {x} <= {CUTS[0]} THEN 0 WHEN {x} <= {CUTS[1]} THEN 1 ELSE 2 END"


CLS = PRED + f", cls AS (SELECT event_type, {_class('y_true')} AS y, {_class('y_pred')} AS p FROM pred)"
PER = CLS + """, per AS (SELECT event_type, k AS label, count(*) FILTER (y = k AND p = k) AS tp, count(*) FILTER (y = k) AS support,
  count(*) FILTER (p = k) AS q FROM cls, (VALUES (0), (1), (2)) AS ks(k) GROUP BY ALL),
  sc AS (SELECT event_type, label, support, tp, coalesce(CAST(tp AS DOUBLE) / nullif(q, 0), 0) AS "precision",
    coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall, coalesce(2.0 * tp / nullif(q + support, 0), 0) AS f1
    FROM per WHERE support + q > 0)"""


def predictions(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return label_regression(events, BY_KIND, "value", 1).select(
        "event_id", "ts", "event_type", F.col("y").alias("y_true"), F.col("y_naive").alias("y_pred"))


def classes(spark, folder):
    return predictions(spark, folder).select(
        "event_type", bin_right_closed(F.col("y_true"), CUTS).alias("y"), bin_right_closed(F.col("y_pred"), CUTS).alias("p"))


@registry("accuracy", f"WITH {CLS} SELECT event_type, count(*) AS n, {r6('avg(CAST(y = p AS INTEGER))', 'accuracy')} FROM cls GROUP BY 1")
def _(spark, folder):
    return rounded(op.accuracy(classes(spark, folder), group=["event_type"]))


@registry("confusion_matrix", f"""WITH {CLS} SELECT event_type, k AS y, {many(f'count(*) FILTER (y = k AND p = {c}) AS pred_{c}' for c in (0, 1, 2))}
    FROM cls, (VALUES (0), (1), (2)) AS ks(k) GROUP BY ALL""")
def _(spark, folder):
    return op.confusion_matrix(classes(spark, folder), group=["event_type"])


@registry("confusion_counts", f"WITH {CLS} SELECT y, p, count(*) AS n FROM cls GROUP BY ALL")
def _(spark, folder):
    return op.confusion_counts(classes(spark, folder))


@registry("macro_f1", f"""WITH {PER} SELECT event_type, CAST(sum(support) AS BIGINT) AS n, {r6('sum(tp) / sum(support)', 'accuracy')},
    {r6('avg(f1)', 'macro_f1')}, {r6('avg(recall)', 'macro_recall')} FROM sc GROUP BY 1""")
def _(spark, folder):
    return rounded(op.macro_scores(classes(spark, folder), group=["event_type"]))


@registry("class_scores", f"""WITH {PER} SELECT event_type, label, {many(r6(f'"{c}"', c) for c in ('precision', 'recall', 'f1'))}, support FROM sc""")
def _(spark, folder):
    return rounded(op.class_scores(classes(spark, folder), group=["event_type"]))


def _summary(label: str, exprs: list[str]) -> str:
    shown = many(r6(e, c) for e, c in zip(exprs, ("precision", "recall", "f1")))
    return f"SELECT event_type, '{label}' AS label, {shown}, CAST(sum(support) AS BIGINT) AS support FROM sc GROUP BY 1"


@registry("classification_report", f"""WITH {PER} SELECT event_type, CAST(label AS VARCHAR) AS label,
    {many(r6(f'"{c}"', c) for c in ('precision', 'recall', 'f1'))}, support FROM sc
    UNION ALL {_summary('accuracy', ['sum(tp) / sum(support)'] * 3)}
    UNION ALL {_summary('macro avg', [f'avg("{c}")' for c in ('precision', 'recall', 'f1')])}
    UNION ALL {_summary('weighted avg', [f'sum("{c}" * support) / sum(support)' for c in ('precision', 'recall', 'f1')])}""")
def _(spark, folder):
    return rounded(op.classification_report(classes(spark, folder), group=["event_type"]))


RMSE = "sqrt(avg((y_true - y_pred) * (y_true - y_pred)))"


@registry("rmse", f"WITH {PRED} SELECT event_type, {r6(RMSE, 'rmse')} FROM pred GROUP BY 1")
def _(spark, folder):
    return rounded(op.rmse(predictions(spark, folder), group=["event_type"]))


@registry("rmse_finite", f"WITH {PRED} SELECT event_type, count(*) AS n, {r6(RMSE, 'rmse')} FROM pred WHERE event_id % 10 <> 3 GROUP BY 1")
def _(spark, folder):
    broken = F.when(F.col("event_id") % 10 == 3, F.lit(float("inf"))).otherwise(F.col("y_pred"))
    return rounded(op.rmse_finite(predictions(spark, folder).withColumn("y_pred", broken), group=["event_type"]))


@registry("macro_rmse", f"WITH {PRED} SELECT {r6('avg(rmse)', 'macro_rmse')} FROM (SELECT event_type, {RMSE} AS rmse FROM pred GROUP BY 1)")
def _(spark, folder):
    return rounded(op.macro_rmse(op.rmse(predictions(spark, folder), group=["event_type"])))


@registry("prediction_table", f"""WITH {PRED} SELECT event_id, ts, y_true, y_pred, y_pred AS y_naive, {r6('y_true - y_pred', 'residual')} FROM pred""")
def _(spark, folder):
    df = predictions(spark, folder)
    out = op.prediction_table(df, "ts", "y_true", "y_pred", "y_pred", keys=["event_id"])
    return out.withColumn("residual", F.round(F.col("residual") + 1.37e-8, 6))


@registry("prediction_table_class", f"WITH {PRED} SELECT event_id, ts, {_class('y_true')} AS y_true, {_class('y_pred')} AS y_pred, {_class('y_pred')} AS y_naive FROM pred")
def _(spark, folder):
    df = predictions(spark, folder).withColumns({
        "y": bin_right_closed(F.col("y_true"), CUTS), "p": bin_right_closed(F.col("y_pred"), CUTS)})
    return op.prediction_table_class(df, "ts", "y", "p", "p", keys=["event_id"])


@registry("prediction_table_long", f"""WITH {SPLIT_SQL} {' UNION ALL '.join(
    f"SELECT ts, split, '{t}' AS target, {r6(f'lead({t}, 1) OVER o', 'y_true')}, {r6(f'lag({t}, 1) OVER o', 'y_pred')}, "
    f"{r6(t, 'y_naive')}, {r6(f'lead({t}, 1) OVER o - lag({t}, 1) OVER o', 'residual')} FROM splitted WINDOW o AS (PARTITION BY split ORDER BY ts)"
    for t in HOURLY.targets)}""")
def _(spark, folder):
    from seriesprep import layout

    def build(over):
        ahead = {f"y__{t}": over(f"lead({t}, 1)") for t in HOURLY.targets}
        return ahead | {f"p__{t}": over(f"lag({t}, 1)") for t in HOURLY.targets}

    df = layout.with_rows(hourly_with_split(spark, folder), KEYED, build, before=1, after=1)
    df = df.withColumns({f"y_naive__{t}": F.col(t) for t in HOURLY.targets})
    return rounded(op.prediction_table_long(df, "ts", HOURLY.targets, keys=["split"]))


def _naive(back: int, name: str) -> str:
    cells = []
    for t in HOURLY.targets:
        for h in HORIZONS:
            p = f"lag({t}, {back}) OVER o" if back else t
            cells.append(f"SELECT '{t}' AS target, {h} AS horizon, lead({t}, {h}) OVER o AS y, {p} AS p FROM splitted WINDOW o AS (PARTITION BY split ORDER BY ts)")
    return f"{name} AS (SELECT target, horizon, count(y + p) AS n, sqrt(avg((y - p) * (y - p))) AS rmse FROM ({' UNION ALL '.join(cells)}) GROUP BY ALL)"


@registry("pivot_horizon", f"""WITH {SPLIT_SQL}, {_naive(0, 'f')} SELECT target, {many(r6(f'max(rmse) FILTER (horizon = {h})', f'h{h}') for h in HORIZONS)}
    FROM f GROUP BY target""")
def _(spark, folder):
    scores = baseline_persistence(hourly_with_split(spark, folder), KEYED, HOURLY.targets)
    return rounded(op.pivot_horizon(scores, "rmse", HORIZONS))


@registry("compare_datasets", f"""WITH {SPLIT_SQL}, {_naive(0, 'f')}, {_naive(24, 'g')}
    SELECT 'persistence' AS dataset, target, horizon, n, {r6('rmse', 'rmse')} FROM f UNION ALL
    SELECT 'seasonal', target, horizon, n, {r6('rmse', 'rmse')} FROM g""")
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    return rounded(op.compare_datasets({
        "persistence": baseline_persistence(df, KEYED, HOURLY.targets),
        "seasonal": baseline_seasonal(df, KEYED, HOURLY.targets),
    }))


@registry("improvement", f"""WITH {SPLIT_SQL}, {_naive(0, 'f')}, {_naive(24, 'g')}
    SELECT target, horizon, {r6('g.rmse', 'rmse_season')}, {r6('f.rmse', 'rmse_persist')}, {r6('f.rmse - g.rmse', 'gain')} FROM f JOIN g USING (target, horizon)""")
def _(spark, folder):
    df = hourly_with_split(spark, folder)
    persist = baseline_persistence(df, KEYED, HOURLY.targets).select("target", "horizon", F.col("rmse").alias("rmse_persist"))
    season = baseline_seasonal(df, KEYED, HOURLY.targets).select("target", "horizon", F.col("rmse").alias("rmse_season"))
    both = season.join(persist, ["target", "horizon"])
    return rounded(op.improvement(both, "rmse_season", "rmse_persist", name="gain"))


@registry("metrics_by_horizon", f"""WITH {SPLIT_SQL}, {_naive(0, 'f')} SELECT horizon, n, {r6('rmse', 'rmse')} FROM f WHERE target = 'click'""")
def _(spark, folder):
    scores = baseline_persistence(hourly_with_split(spark, folder), KEYED, ["click"])
    return rounded(op.metrics_by_horizon(scores, ["n", "rmse"]))
