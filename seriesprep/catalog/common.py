"""Shared pieces of the registered queries: table access, rounding, and SQL for the derived tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesprep.functions.scalars import quoted
from seriesprep.operators.splits import Splits, split_by_ratio, split_rows
from seriesprep.sources.hourly import HOURLY, KINDS, read_hourly

SIGNALS = HOURLY.signals
EDGES = (35.0, 55.0)  # class bounds that suit the hourly means
HORIZONS = (1, 6, 12, 24)
SHIFT = 1.37e-8


class Registry:
    """Queries of one section by name, each with its SQL or none."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return read_hourly(spark, folder)


def hourly_splits(df: DataFrame, purge_hours: int = 0) -> Splits:
    return split_by_ratio(df, HOURLY, purge_hours=purge_hours)


def hourly_with_split(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly rows with their split label."""
    df = hourly(spark, folder)
    return split_rows(df, HOURLY, hourly_splits(df))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so two engines that add in another order agree.

    Means of hundredths often end in an exact half at the last digit; the small shift moves
    these off the rounding edge.
    """
    doubles = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.selectExpr(*[
        f"round({quoted(c)} + {SHIFT}D, {digits}) AS {quoted(c)}" if c in doubles else quoted(c) for c in df.columns
    ])


def r6(expr: str, name: str) -> str:
    """The same in SQL; adding zero turns -0.0 into 0.0."""
    return f"round({expr} + {SHIFT}, 6) + 0e0 AS {name}"


def many(parts: Iterable[str]) -> str:
    return ", ".join(parts)


def _mean(kind: str) -> str:
    cell = f"CASE WHEN event_type = '{kind}' THEN value END"
    return f"CAST(sum(CAST(round({cell} * 100.0) AS BIGINT)) AS DOUBLE) / count({cell}) / 100.0 AS {kind}"


HOURLY_SQL = (
    "hourly AS (SELECT date_trunc('hour', ts) AS ts, "
    + many(_mean(k) for k in KINDS)
    + ", CAST(count(*) AS DOUBLE) AS volume, max(value) AS peak FROM events GROUP BY 1)"
)

# rows of train and validation as in ratio_sizes; test has the rest
SPLIT_SQL = (
    HOURLY_SQL
    + ", numbered AS (SELECT *, row_number() OVER (ORDER BY ts) AS rn, count(*) OVER () AS n FROM hourly)"
    + ", sized AS (SELECT *, greatest(1, CAST(round_even(n * 0.7, 0) AS BIGINT)) AS n_train,"
    + " greatest(1, CAST(round_even(n * 0.15, 0) AS BIGINT)) AS n_val FROM numbered)"
    + ", splitted AS (SELECT * EXCLUDE (rn, n, n_train, n_val), CASE WHEN rn <= n_train THEN 'train'"
    + " WHEN rn <= n_train + n_val THEN 'val' ELSE 'test' END AS split FROM sized)"
)

# the hourly rows as raw text: dotted time, decimal comma, -200 for missing
def raw_text_sql(signals: Iterable[str] = SIGNALS) -> str:
    def text(c: str) -> str:
        h = f"CAST(floor({c} * 100.0 + 0.5) AS BIGINT)"
        return f"coalesce(CAST({h} // 100 AS VARCHAR) || ',' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0'), '-200') AS {c}"

    return (
        "raw AS (SELECT ts, strftime(ts, '%d/%m/%Y') AS \"Date\", strftime(ts, '%H.%M.%S') AS \"Time\", "
        + many(text(c) for c in signals) + " FROM hourly)"
    )


def clean_from_raw_sql(signals: Iterable[str] = SIGNALS) -> str:
    """Numbers parsed back from the raw text, the marker as null."""
    cells = many(f"nullif(CAST(replace({c}, ',', '.') AS DOUBLE), -200.0) AS {c}" for c in signals)
    return f"clean AS (SELECT ts, {cells} FROM raw)"


RAW_SQL = HOURLY_SQL + ", " + raw_text_sql()
CLEAN_SQL = RAW_SQL + ", " + clean_from_raw_sql()
