"""Checks of a clean table against its raw text, and the whole cleaning chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesprep.catalog.common import CLEAN_SQL, SIGNALS, Registry, hourly, many
from seriesprep.operators import validate as op
from seriesprep.plans.preprocess import preprocess, preprocess_file
from seriesprep.catalog.tables import write_raw
from seriesprep.sources.hourly import HOURLY, raw_text_table

registry = Registry()


def raw(spark, folder):
    return raw_text_table(hourly(spark, folder), SIGNALS)


def faulty_clean(spark, folder):
    """A clean table with planted faults: shifted values, a lost value, a marker left in."""
    good = op.expected_from_raw(raw(spark, folder), HOURLY)
    hour = F.hour("ts")
    return good.withColumns({
        "click": F.when(hour == 3, F.col("click") + 1.0).when(hour == 4, F.lit(None)).otherwise(F.col("click")),
        "error": F.coalesce(F.col("error"), F.lit(-200.0)),
        "signup": F.when(hour == 5, F.col("signup") + 0.5).otherwise(F.col("signup")),
    }).filter(hour != 6)


FAULTY_SQL = CLEAN_SQL + """, faulty AS (SELECT * REPLACE (CASE WHEN hour(ts) = 3 THEN click + 1.0 WHEN hour(ts) = 4 THEN NULL ELSE click END AS click,
  coalesce(error, -200.0) AS error, CASE WHEN hour(ts) = 5 THEN signup + 0.5 ELSE signup END AS signup) FROM clean WHERE hour(ts) <> 6)"""


@registry("check_columns", " UNION ALL ".join(
    f"SELECT 'column_present' AS \"check\", '{c}' AS \"column\", 'pass' AS status, CAST(0 AS BIGINT) AS count" for c in ("ts", *SIGNALS))
    + " UNION ALL SELECT 'column_present', 'absent', 'fail', 1 UNION ALL SELECT 'timestamp_parses', 'ts', 'pass', 0")
def _(spark, folder):
    return op.check_columns(hourly(spark, folder), HOURLY, [*SIGNALS, "absent"])


@registry("expected_from_raw", f"WITH {CLEAN_SQL} SELECT ts, {many(SIGNALS)} FROM clean WHERE coalesce(click, error, purchase) IS NOT NULL")
def _(spark, folder):
    return op.expected_from_raw(raw(spark, folder), HOURLY, drop_missing_targets=True)


@registry("common_timestamps", f"WITH {FAULTY_SQL} SELECT clean.ts FROM clean JOIN faulty USING (ts)")
def _(spark, folder):
    return op.common_timestamps(op.expected_from_raw(raw(spark, folder), HOURLY), faulty_clean(spark, folder), HOURLY)


@registry("one_sided_times", f"WITH {FAULTY_SQL} SELECT (SELECT count(*) FROM clean ANTI JOIN faulty USING (ts)) AS only_raw, CAST(0 AS BIGINT) AS only_clean")
def _(spark, folder):
    return op.one_sided_times(op.expected_from_raw(raw(spark, folder), HOURLY), faulty_clean(spark, folder), HOURLY)


def _sentinel(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) FILTER (r.{c} = '-200') AS raw_sentinels,
      count(*) FILTER (r.{c} = '-200' AND f.{c} IS NULL) AS clean_nulls,
      CASE WHEN count(*) FILTER (r.{c} = '-200') = count(*) FILTER (r.{c} = '-200' AND f.{c} IS NULL) THEN 'pass' ELSE 'fail' END AS status
      FROM raw r JOIN faulty f USING (ts)"""


@registry("check_sentinel", f"WITH {FAULTY_SQL} " + " UNION ALL ".join(_sentinel(c) for c in SIGNALS))
def _(spark, folder):
    return op.check_sentinel(op.raw_numbers(raw(spark, folder), HOURLY), faulty_clean(spark, folder), HOURLY)


def _drift(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(c.{c}) AS valid, count(*) FILTER (abs(f.{c} - c.{c}) > 1e-12) AS drifted,
      count(*) FILTER (c.{c} IS NOT NULL AND f.{c} IS NULL) AS lost,
      CASE WHEN count(*) FILTER (abs(f.{c} - c.{c}) > 1e-12) = 0 THEN 'pass' ELSE 'fail' END AS status FROM clean c JOIN faulty f USING (ts)"""


@registry("check_drift", f"WITH {FAULTY_SQL} " + " UNION ALL ".join(_drift(c) for c in SIGNALS))
def _(spark, folder):
    return op.check_drift(op.raw_numbers(raw(spark, folder), HOURLY), faulty_clean(spark, folder), HOURLY)


@registry("target_summary", f"WITH {CLEAN_SQL} " + " UNION ALL ".join(
    f"SELECT '{t}' AS \"column\", count({t}) AS known, count(*) - count({t}) AS nulls, min({t}) AS min, max({t}) AS max FROM clean" for t in HOURLY.targets))
def _(spark, folder):
    return op.target_summary(op.expected_from_raw(raw(spark, folder), HOURLY), HOURLY)


STORED = "unix_seconds(CAST(ts AS TIMESTAMP)) + CASE WHEN hour(ts) = 7 THEN 5400 ELSE 0 END"  # seven o'clock is stored after eight


def _summary_sql() -> str:
    cells = [f"SELECT 'column_present' AS \"check\", '{c}' AS \"column\", 0 AS n" for c in ("ts", *SIGNALS)]
    cells += ["SELECT 'timestamp_parses', 'ts', 0", "SELECT 'unique_times', 'ts', (SELECT count(*) FROM (SELECT ts FROM faulty GROUP BY 1 HAVING count(*) > 1))",
              "SELECT 'common_times', 'ts', CASE WHEN (SELECT count(*) FROM raw JOIN faulty USING (ts)) > 0 THEN 0 ELSE 1 END",
              "SELECT 'sorted', 'ts', (SELECT count(*) FILTER (ts < before) FROM (SELECT ts, lag(ts) OVER (ORDER BY epoch(ts) + CASE WHEN hour(ts) = 7 THEN 5400 ELSE 0 END) AS before FROM faulty))"]
    cells += [f"SELECT 'sentinel', '{c}', (SELECT count(*) FROM raw r JOIN faulty f USING (ts) WHERE r.{c} = '-200' AND f.{c} IS NOT NULL)" for c in SIGNALS]
    cells += [f"SELECT 'drift', '{c}', (SELECT count(*) FROM clean c JOIN faulty f USING (ts) WHERE abs(f.{c} - c.{c}) > 1e-12)" for c in SIGNALS]
    return f"""SELECT "check", "column", CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(n AS BIGINT) AS "count" FROM ({' UNION ALL '.join(cells)})"""


@registry("validation_summary", f"WITH {FAULTY_SQL} {_summary_sql()}")
def _(spark, folder):
    stored = faulty_clean(spark, folder).withColumn("stored", F.expr(STORED))
    return op.validation_summary(raw(spark, folder), stored, HOURLY, ordinal="stored")


@registry("preprocess", f"""WITH {CLEAN_SQL} SELECT ts, {many(HOURLY.targets)}, {many(
    f'last_value({c} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}' for c in HOURLY.features)} FROM clean
    QUALIFY coalesce(click, error, purchase) IS NOT NULL""")
def _(spark, folder):
    path = write_raw(spark, folder)
    return preprocess_file(spark, path, HOURLY, impute="ffill", drop_missing_targets=False).table.filter(
        F.coalesce(*HOURLY.targets).isNotNull())


def _report() -> str:
    rows = [f"SELECT 'sentinel' AS phase, '{c}' AS \"column\", 'replaced' AS metric, count(*) FILTER ({c} IS NULL) AS value FROM clean" for c in SIGNALS]
    rows += [f"SELECT 'timestamp', NULL, '{m}', {e} FROM clean" for m, e in (
        ("rows_before", "count(*)"), ("rows_bad_timestamp", "0 * count(*)"), ("duplicates_removed", "0 * count(*)"), ("rows_after", "count(*)"))]
    rows += [f"SELECT 'summary', '{t}', '{m}', {e} FROM clean" for t in HOURLY.targets for m, e in (
        ("target_null", f"count(*) - count({t})"), ("target_known", f"count({t})"))]
    return " UNION ALL ".join(rows)


@registry("preprocess_report", f"WITH {CLEAN_SQL} {_report()}")
def _(spark, folder):
    report = preprocess(raw(spark, folder), HOURLY).report
    return report.filter(F.col("phase").isin("sentinel", "timestamp") | F.col("metric").isin("target_null", "target_known"))
