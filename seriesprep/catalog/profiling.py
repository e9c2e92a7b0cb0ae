"""Tables that describe the order lines and the hourly series."""

from __future__ import annotations

from seriesprep.catalog.common import HOURLY_SQL, SIGNALS, Registry, hourly, many, r6, rounded, table
from seriesprep.operators import profile as op
from seriesprep.sources.hourly import EVENTS, HOURLY
from seriesprep.spec import SeriesSpec

registry = Registry()
ITEMS = SeriesSpec(ts="l_shipdate")
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TEXTS = ("l_returnflag", "l_linestatus")


@registry("table_summary", """SELECT count(*) AS n_rows, 11 AS n_columns, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts FROM lineitem""")
def _(spark, folder):
    return op.table_summary(table(spark, folder, "lineitem"), ITEMS)


def _rates() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r6(f'avg(CAST({c} IS NULL AS INTEGER))', 'missing_rate')} FROM hourly" for c in ("ts", *SIGNALS))


@registry("missing_rate", f"WITH {HOURLY_SQL} {_rates()}")
def _(spark, folder):
    return rounded(op.missing_rate(hourly(spark, folder)))


@registry("top_missing", f"WITH {HOURLY_SQL}, r AS ({_rates()}) SELECT * FROM r ORDER BY missing_rate DESC, \"column\" LIMIT 3")
def _(spark, folder):
    return op.top_missing(rounded(hourly(spark, folder), 9), 3).withColumnRenamed("missing_rate", "m").selectExpr(
        "column", "round(m + 1.37e-8, 6) AS missing_rate")


def _number(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')},
      {r6(f'min({c})', 'min')}, {r6(f'quantile_cont({c}, 0.25)', 'q25')}, {r6(f'quantile_cont({c}, 0.5)', 'q50')},
      {r6(f'quantile_cont({c}, 0.75)', 'q75')}, {r6(f'max({c})', 'max')}, CAST(NULL AS BIGINT) AS "distinct", NULL AS top, CAST(NULL AS BIGINT) AS freq FROM lineitem"""


def _text(c: str) -> str:
    nulls = many(f"CAST(NULL AS DOUBLE) AS {s}" for s in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {nulls}, count(DISTINCT {c}) AS "distinct",
      (SELECT {c} FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
      (SELECT count(*) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM lineitem"""


@registry("describe_all", " UNION ALL ".join([_number(c) for c in NUMBERS] + [_text(c) for c in TEXTS]))
def _(spark, folder):
    out = op.describe_all(table(spark, folder, "lineitem"), [*NUMBERS, *TEXTS])
    return rounded(out.drop(*[c for c in out.columns if c.startswith("ts_")]))


@registry("describe_times", """SELECT 'l_shipdate' AS "column", count(l_shipdate) AS count, CAST(min(l_shipdate) AS VARCHAR) AS ts_min,
    CAST(max(l_shipdate) AS VARCHAR) AS ts_max FROM lineitem""")
def _(spark, folder):
    return op.describe_all(table(spark, folder, "lineitem"), ["l_shipdate"]).select("column", "count", "ts_min", "ts_max")


@registry("histogram", f"""WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events), w AS (SELECT lo, (hi - lo) / 50 AS width FROM s),
    c AS (SELECT least(CAST(floor((value - lo) / width) AS INTEGER), 49) AS bin, count(*) AS n FROM events, w WHERE value IS NOT NULL GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, {r6('lo + i * width', 'lower')}, {r6('lo + (i + 1) * width', 'upper')}, coalesce(n, 0) AS n
    FROM range(50) AS g(i) CROSS JOIN w LEFT JOIN c ON c.bin = i""")
def _(spark, folder):
    return rounded(op.histogram(table(spark, folder, "events"), "value", 50))


@registry("mean_by_hour", f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {r6('avg(value)', 'value')} FROM events GROUP BY 1")
def _(spark, folder):
    return rounded(op.mean_by_hour(table(spark, folder, "events"), EVENTS, ["value"]))


@registry("mean_by_dow", f"SELECT CAST(isodow(ts) - 1 AS INTEGER) AS dow, {r6('avg(value)', 'value')} FROM events GROUP BY 1")
def _(spark, folder):
    return rounded(op.mean_by_dow(table(spark, folder, "events"), EVENTS, ["value"]))


def _corr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return f"""SELECT '{a}' AS x, '{b}' AS y, {r6(f'covar_pop({a}, {b}) / nullif(stddev_pop({a}) FILTER ({both}) * stddev_pop({b}) FILTER ({both}), 0)', 'corr')}"""


@registry("correlation_matrix", f"WITH {HOURLY_SQL} " + " UNION ALL ".join(f"{_corr(a, b)} FROM hourly" for a in SIGNALS for b in SIGNALS))
def _(spark, folder):
    return rounded(op.correlation_matrix(hourly(spark, folder), SIGNALS))


@registry("correlation_matrix_lines", " UNION ALL ".join(f"{_corr(a, b)} FROM lineitem" for a in NUMBERS for b in NUMBERS))
def _(spark, folder):
    return rounded(op.correlation_matrix(table(spark, folder, "lineitem"), NUMBERS))


@registry("rolling_volatility", f"""SELECT ts, event_id, {r6('m', 'rolling_mean')}, {r6('s', 'rolling_std')} FROM (
    SELECT ts, event_id, count(value) OVER f AS n, avg(value) OVER f AS m, stddev_samp(value) OVER f AS s FROM events
    WINDOW f AS (ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) WHERE n >= 8""")
def _(spark, folder):
    return rounded(op.rolling_volatility(table(spark, folder, "events"), EVENTS, "value"))
