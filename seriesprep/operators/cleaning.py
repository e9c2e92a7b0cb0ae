"""Time keys, duplicates, text to numbers, missing markers, row and column filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.scalars import col, quoted, to_number
from seriesprep.spec import SeriesSpec

SENTINEL = -200.0


def build_timestamp(
    df: DataFrame,
    date: str = "Date",
    time: str = "Time",
    out: str = "timestamp",
    fmt: str = "d/M/yyyy H:m:s",
) -> DataFrame:
    """One timestamp from a day-first date and a dotted time; unparseable text becomes null."""
    if date not in df.columns or time not in df.columns:
        raise ValueError(f"the table needs the columns {date!r} and {time!r}")
    clock = F.trim(F.translate(col(time), ".", ":"))
    text = F.concat(F.trim(col(date)), F.lit(" "), clock)
    parsed = F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    return df.withColumn(out, parsed).drop(date, time)


def parse_timestamp(df: DataFrame, name: str) -> DataFrame:
    """Text to timestamp, bad text to null; a zoned timestamp keeps its wall clock."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return df
    return df.withColumn(name, col(name).try_cast("timestamp_ntz"))


def drop_null_timestamp(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.filter(col(spec.ts).isNotNull())


def count_null_timestamp(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows in all and rows without a time, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(col(spec.ts).isNull()).alias("rows_bad_timestamp"),
    )


def dedup_first(df: DataFrame, spec: SeriesSpec, order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per series and time: the first by ``order`` (default: the tiebreak).

    Written as an aggregate rather than a window: every task reduces its copies first, so a
    time that holds most of the rows costs one row per task in the shuffle. Rows equal in
    ``order`` are told apart by their other columns, which makes the choice repeatable.
    """
    keys = [*spec.by, spec.ts]
    lead = [c for c in (order if order is not None else spec.tiebreak) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead + rest:
        return df.dropDuplicates(keys)
    row = F.struct(*[col(c) for c in lead + rest])
    kept = df.groupBy(*[col(k) for k in keys]).agg(F.min(row).alias("_row"))
    return kept.select(*[
        col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns
    ])


def count_duplicates(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """How many rows ``dedup_first`` removes."""
    per_time = df.groupBy(*[col(k) for k in (*spec.by, spec.ts)]).agg(F.count(F.lit(1)).alias("_n"))
    return per_time.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"))


def _text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def coerce_numeric(
    df: DataFrame, skip: Sequence[str] = ()
) -> tuple[DataFrame, list[str], list[str]]:
    """Turn text columns into numbers where at least one value parses.

    Returns the frame, the converted columns and those left as text. One aggregate over all
    text columns decides.
    """
    text = _text_columns(df, skip)
    if not text:
        return df, [], []
    hits = df.agg(*[F.count(to_number(col(n))).alias(f"_{i}") for i, n in enumerate(text)]).first()
    coerced = [n for i, n in enumerate(text) if hits[i] > 0]
    out = df.withColumns({n: to_number(col(n)) for n in coerced}) if coerced else df
    return out, coerced, [n for n in text if n not in coerced]


def sentinel_to_null(
    df: DataFrame, value: float = SENTINEL, columns: Sequence[str] | None = None
) -> DataFrame:
    """Null the missing marker in numeric columns."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return df.withColumns({n: F.when(col(n) != F.lit(value), col(n)) for n in names})


def sentinel_counts(
    df: DataFrame, value: float = SENTINEL, columns: Sequence[str] | None = None
) -> list[Column]:
    """Aggregate expressions: how often the marker occurs per numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return [F.count_if(col(n) == F.lit(value)).alias(n) for n in names]


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every one of the columns is null."""
    return df.dropna(how="all", subset=list(columns))


def dropna_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is null."""
    return df.dropna(how="any", subset=list(columns))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns that exist."""
    return df.drop(*[n for n in names if n in df.columns])


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns that exist, in the given order."""
    return df.select(*[quoted(n) for n in names if n in df.columns])


def slice_time(df: DataFrame, spec: SeriesSpec, start: datetime, end: datetime) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; reaches the Parquet scan as a filter."""
    return df.filter(col(spec.ts).between(ntz(start), ntz(end)))


def ntz(moment: datetime) -> Column:
    """A timestamp literal without zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_purge(ts: Column, starts: Sequence[datetime], hours: float) -> Column:
    """True in the ``hours`` before any of the starts."""
    gap = timedelta(hours=hours)
    hit = F.lit(False)
    for start in starts:
        hit = hit | ((ts >= ntz(start - gap)) & (ts < ntz(start)))
    return hit


def exclude_purge(
    df: DataFrame, spec: SeriesSpec, val_start: datetime, test_start: datetime, hours: float
) -> DataFrame:
    """Remove the rows in the ``hours`` before validation and before test; 0 removes none."""
    if hours <= 0:
        return df
    return df.filter(~in_purge(col(spec.ts), (val_start, test_start), hours))


def filter_flag(df: DataFrame, flag: str, value: int = 0) -> DataFrame:
    """Keep the rows whose flag has the value."""
    return df.filter(col(flag) == F.lit(value))


def feature_columns(
    df: DataFrame,
    exclude: Sequence[str] = (),
    tokens: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> list[str]:
    """Names of the feature columns.

    All but ``exclude``; or of these the names that contain any of ``tokens`` (all of them
    when no name does); or the saved list ``columns``, where a missing one is an error.
    """
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"the table lacks {missing} of the saved columns")
        return list(columns)
    names = [c for c in df.columns if c not in exclude]
    if tokens is None:
        return names
    return [c for c in names if any(t in c for t in tokens)] or names


def feature_target_frame(
    df: DataFrame,
    label: str,
    exclude: Sequence[str] = (),
    tokens: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Labeled rows with the feature columns and the label only, and the feature names."""
    names = feature_columns(df, [*exclude, label], tokens, columns)
    out = df.dropna(subset=[label]).select(*[col(n) for n in names], col(label))
    return out, names
