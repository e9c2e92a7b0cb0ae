"""Filling nulls along time and with parameters fitted on the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.functions.quantiles import exact_quantiles
from seriesprep.functions.scalars import clip_at_zero, col, quoted
from seriesprep.spec import SeriesSpec


def ffill(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the last known value before them."""
    return layout.carry(df, spec, {c: col(c) for c in columns})


def bfill(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the next known value after them."""
    return layout.carry(df, spec, {c: col(c) for c in columns}, backwards=True)


def _micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double")


def interpolate_time(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Linear in elapsed time between the known neighbours; constant beyond the ends."""
    placed, how = layout.place(df, spec)
    known = {
        c: F.when(col(c).isNotNull(), F.struct(col(how.ts).alias("at"), col(c).cast("double").alias("v")))
        for c in columns
    }
    work = layout.carry(placed, how, {f"_p{i}": known[c] for i, c in enumerate(columns)})
    work = layout.carry(work, how, {f"_n{i}": known[c] for i, c in enumerate(columns)}, backwards=True)
    filled: dict[str, Column] = {}
    for i, c in enumerate(columns):
        prev, nxt = F.col(f"_p{i}"), F.col(f"_n{i}")
        share = F.try_divide(
            _micros(prev["at"], col(how.ts)), _micros(prev["at"], nxt["at"])
        )
        between = prev["v"] + (nxt["v"] - prev["v"]) * share
        filled[c] = F.coalesce(col(c).cast("double"), between, prev["v"], nxt["v"])
    helpers = [f"_{k}{i}" for k in "pn" for i in range(len(columns))]
    if spec.layout != "indexed":
        helpers.append(layout.POS)
    return work.withColumns(filled).drop(*helpers)


def fill_rolling(df: DataFrame, spec: SeriesSpec, columns: Sequence[str], size: int = 6) -> DataFrame:
    """Fill nulls forward, then what is left with the mean of the last ``size`` rows."""
    placed, how = layout.place(df, spec, size)
    filled = ffill(placed, how, columns)

    def build(over: layout.Over):
        return {c: F.coalesce(col(c), over(f"avg({quoted(c)})", 1 - size, 0)) for c in columns}

    out = layout.with_rows(filled, how, build, before=size - 1)
    return out if spec.layout == "indexed" else out.drop(layout.POS)


def impute_features(
    df: DataFrame, spec: SeriesSpec, strategy: str = "none", columns: Sequence[str] | None = None,
    size: int = 6,
) -> DataFrame:
    """Fill the non-target columns: ``none``, ``ffill`` or ``ffill+rolling``."""
    names = list(columns) if columns is not None else [
        c for c in df.columns
        if c not in (*spec.targets, *spec.by, spec.ts, *spec.tiebreak)
    ]
    if strategy == "none":
        return df
    if strategy == "ffill":
        return ffill(df, spec, names)
    if strategy == "ffill+rolling":
        return fill_rolling(df, spec, names, size)
    raise ValueError(f"unknown strategy {strategy!r}")


def filled_counts(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column how many nulls were filled; never negative."""
    def nulls(df: DataFrame, sign: int) -> DataFrame:
        row = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in columns])
        return unpivot_row(row, columns, "column", "nulls").withColumn("nulls", F.col("nulls") * sign)

    both = nulls(before, 1).unionByName(nulls(after, -1))
    return both.groupBy("column").agg(clip_at_zero(F.sum("nulls")).alias("filled"))


def unpivot_row(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per column of a wide result."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), col(c).alias("v")) for c in columns])
    return df.select(F.explode(pairs).alias("_e")).select(
        F.col("_e.k").alias(name), F.col("_e.v").alias(value)
    )


# --- parameters fitted on train ------------------------------------------------------------

def fit_means(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean per column in one aggregate; a column without values has none."""
    row = train.agg(*[F.avg(col(c)).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns) if row[i] is not None}


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Interpolated median per column; a column without values has none."""
    found = exact_quantiles(train, columns, [0.5])
    return {c: v[0] for c, v in found.items() if v[0] is not None}


def impute_saved(df: DataFrame, params: dict[str, float]) -> DataFrame:
    """Fill nulls with stored values; columns without one are left alone."""
    present = {c: v for c, v in params.items() if c in df.columns}
    if not present:
        return df
    return df.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(float(v))) for c, v in present.items()})


def impute_mean(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, Any]]:
    """Fill nulls with the training means; also returns them."""
    params = fit_means(train, columns)
    return impute_saved(df, params), params


def impute_median(
    df: DataFrame, train: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, dict[str, Any]]:
    """Fill nulls with the training medians; also returns them."""
    params = fit_medians(train, columns)
    return impute_saved(df, params), params


def impute_constant(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def params_table(df: DataFrame, params: dict[str, float]) -> DataFrame:
    """Fitted values as a table (column, value) to be written and read back."""
    rows = [(k, float(v)) for k, v in params.items()]
    return df.sparkSession.createDataFrame(rows, "column string, value double")


def params_from(table: DataFrame) -> dict[str, float]:
    """The inverse of :func:`params_table`; one row per feature column."""
    return {r["column"]: r["value"] for r in table.collect()}
