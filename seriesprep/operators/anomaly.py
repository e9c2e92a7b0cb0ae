"""Residual flags, the row-wise maximum of all flags, and the filter chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col, row_max, with_calendar
from seriesprep.models.isolation import IsolationForest
from seriesprep.operators.cleaning import filter_flag
from seriesprep.operators.timeframes import rolling_time
from seriesprep.spec import SeriesSpec


def residual_flag(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], hours: int = 24, k: float = 3.0,
    min_periods: int = 12, name: str = "an_resid_{c}",
) -> DataFrame:
    """1 where a value is over k sample stds from the mean of its last ``hours``, else 0.

    The frame holds the value itself, so fewer than 11 values can never flag. Pass a spec
    keyed by the split to keep frames inside each split.
    """
    work = rolling_time(df, spec, columns, hours, min_periods)
    flags, helpers = {}, []
    for c in columns:
        mean, spread = f"{c}_mean_{hours}h", f"{c}_std_{hours}h"
        helpers += [mean, spread]
        far = F.abs(col(c) - col(mean)) > F.lit(float(k)) * col(spread)
        flags[name.format(c=c)] = F.coalesce(far, F.lit(False)).cast("int")
    return work.withColumns(flags).drop(*helpers)


def any_flag(df: DataFrame, prefix: str = "an_", name: str = "an_any") -> DataFrame:
    """Row-wise maximum of all columns whose name starts with the prefix."""
    flags = [c for c in df.columns if c.startswith(prefix) and c != name]
    if not flags:
        raise ValueError(f"no column starts with {prefix!r}")
    return df.withColumn(name, row_max(flags))


def anomaly_flags(
    df: DataFrame, spec: SeriesSpec, features: Sequence[str], split: str = "split",
    min_periods: int = 12, contamination: float = 0.02, seed: int = 42, complete_rows: bool = False,
    isolation: bool = True,
) -> DataFrame:
    """Calendar fields, residual flags per split, isolation flag fitted on train, and ``an_any``."""
    out = with_calendar(df, spec.ts)
    out = residual_flag(out, spec.keyed(split), spec.targets, min_periods=min_periods)
    if isolation:
        forest = IsolationForest(
            features, contamination=contamination, seed=seed, complete_rows=complete_rows
        ).fit(out.filter(col(split) == "train"))
        out = forest.transform(out, "an_iso")
    return any_flag(out)


def anomaly_filter(flagged: DataFrame, flag: str = "an_any") -> DataFrame:
    """The rows without any flag."""
    return filter_flag(flagged, flag, 0)


def anomaly_counts(flagged: DataFrame, split: str = "split", prefix: str = "an_") -> DataFrame:
    """Rows kept and dropped per split, and hits per detector."""
    flags = [c for c in flagged.columns if c.startswith(prefix)]
    return flagged.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(col("an_any") == 0).alias("kept"),
        F.count_if(col("an_any") != 0).alias("dropped"),
        *[F.sum(col(c).cast("long")).alias(f"n_{c}") for c in flags],
    )
