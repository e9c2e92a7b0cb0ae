"""Raw text to clean table with a report of every phase."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col
from seriesprep.operators.cleaning import (
    build_timestamp, coerce_numeric, dedup_first, drop_all_missing, drop_null_timestamp, sentinel_counts,
    sentinel_to_null, numeric_columns,
)
from seriesprep.operators.impute import impute_features
from seriesprep.sources.io import drop_empty_columns, missing_tokens_to_null, normalize_names, order_columns, read_delimited
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import stage

REPORT = "phase string, column string, metric string, value long"


@dataclass
class Cleaned:
    """The clean table and the report (phase, column, metric, value)."""

    table: DataFrame
    report: DataFrame
    dropped_empty_columns: list[str]
    coerced_columns: list[str]
    non_numeric_columns: list[str]


def preprocess_file(spark: SparkSession, path: str, spec: SeriesSpec, **options) -> Cleaned:
    return preprocess(read_delimited(spark, path), spec, **options)


def preprocess(
    raw: DataFrame, spec: SeriesSpec, date: str = "Date", time: str = "Time", impute: str = "none",
    size: int = 6, drop_missing_targets: bool = False, safe: bool = False,
) -> Cleaned:
    """Drop empty columns, build the time key, deduplicate, parse numbers, null the marker, fill features.

    The deduplicated rows are staged once; the counts of the later phases are two aggregates
    over the staged table and its numeric form.
    """
    spark = raw.sparkSession
    report: list[tuple[str, str | None, str, int]] = []

    def note(phase: str, metric: str, value: int, column: str | None = None) -> None:
        report.append((phase, column, metric, int(value)))

    df = missing_tokens_to_null(raw)
    note("read_raw", "columns_before", len(df.columns))
    df, empty = drop_empty_columns(df)
    df, mapping = normalize_names(df, safe)
    date, time = mapping.get(date, date), mapping.get(time, time)
    note("read_raw", "columns_after", len(df.columns))

    df = build_timestamp(df, date, time, spec.ts)
    rows, timed = df.agg(F.count(F.lit(1)), F.count(col(spec.ts))).first()
    unique = stage(dedup_first(drop_null_timestamp(df, spec), spec), "unique")
    kept = unique.count()
    note("timestamp", "rows_before", rows)
    note("timestamp", "rows_bad_timestamp", rows - timed)
    note("timestamp", "duplicates_removed", timed - kept)
    note("timestamp", "rows_after", kept)

    keys = {*spec.by, spec.ts, *spec.tiebreak}
    numbers, coerced, other = coerce_numeric(unique, skip=tuple(keys))
    note("numeric_coercion", "columns_coerced", len(coerced))
    note("numeric_coercion", "columns_left", len(other))

    signals = numeric_columns(numbers, skip=tuple(keys))
    clean = sentinel_to_null(numbers, columns=signals)
    targets = [t for t in spec.targets if t in numbers.columns]
    features = [c for c in signals if c not in spec.targets]
    counted = numbers.agg(
        *sentinel_counts(numbers, columns=signals),
    ).first()
    for i, c in enumerate(signals):
        note("sentinel", "replaced", counted[i], c)
    if drop_missing_targets:
        clean = drop_all_missing(clean, targets)
    before = _null_counts(clean, [*targets, *features])
    if drop_missing_targets:
        note("drop_all_targets_missing", "rows_dropped", kept - before["rows"])
    filled = impute_features(clean, spec, impute, features, size)
    if impute != "none":
        after = _null_counts(filled, features)
        for c in features:
            note("imputation", "filled", max(before[c] - after[c], 0), c)
    final = order_columns(filled, [*spec.by, spec.ts, *spec.signals])
    note("summary", "rows_final", before["rows"])
    note("summary", "cols_final", len(final.columns))
    for t in targets:
        note("summary", "target_null", before[t], t)
        note("summary", "target_known", before["rows"] - before[t], t)
    return Cleaned(final, spark.createDataFrame(report, REPORT), empty, coerced, other)


def _null_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    row = df.agg(F.count(F.lit(1)), *[F.count_if(col(c).isNull()) for c in columns]).first()
    return {"rows": row[0]} | {c: row[i + 1] for i, c in enumerate(columns)}


def assemble_clean(parts: list[DataFrame], spec: SeriesSpec) -> DataFrame:
    """Union of cleaned splits by column name, without rows that lack a time."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return drop_null_timestamp(out, spec)
