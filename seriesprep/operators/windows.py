"""Past-only features and labels along the time axis.

Lags, leads and row frames count rows, not hours: after a gap, or once rows were dropped,
"24 back" is 24 rows back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.functions.scalars import col, finite, quoted
from seriesprep.layout import Over
from seriesprep.spec import SeriesSpec

MAX_LAG = 48
ROLL_WINDOWS = (3, 6, 12, 24)


# --- expressions over one ordered window; used alone or many in one select ---------------

def lag_exprs(over: Over, columns: Sequence[str], lags: Sequence[int], name: str = "{c}_lag_{k}"):
    return {name.format(c=c, k=k): over(f"lag({quoted(c)}, {k})") for c in columns for k in lags}


def lead_exprs(over: Over, columns: Sequence[str], horizons: Sequence[int], name: str):
    return {name.format(c=c, h=h): over(f"lead({quoted(c)}, {h})") for c in columns for h in horizons}


def rolling_past_exprs(over: Over, columns: Sequence[str], windows: Sequence[int]):
    out: dict[str, Column] = {}
    for c in columns:
        for size in windows:
            out[f"{c}_roll{size}_mean"] = over(f"avg({finite(c)})", -size, -1)
            out[f"{c}_roll{size}_std"] = over(f"stddev_pop({finite(c)})", -size, -1)
    return out


def moving_average_exprs(over: Over, columns, windows, strict: bool, name: str):
    out: dict[str, Column] = {}
    for c in columns:
        for size in windows:
            mean = over.text(f"avg({finite(c)})", 1 - size, 0)
            if strict:
                known = over.text(f"count({finite(c)})", 1 - size, 0)
                mean = f"CASE WHEN {known} = {size} THEN {mean} END"
            out[name.format(c=c, w=size)] = F.expr(mean)
    return out


def diff_exprs(over: Over, columns: Sequence[str]):
    return {f"{c}_diff_1": F.expr(f"{quoted(c)} - {over.text(f'lag({quoted(c)}, 1)')}") for c in columns}


def zscore_past_exprs(over: Over, columns, size: int = 24, min_periods: int = 12, k: float = 3.0):
    """Past-only z-score flags; a zero spread with a different value counts as an anomaly.

    With a zero spread the value is compared with the minimum, not the mean, so rounding never
    looks like a jump.
    """
    out: dict[str, Column] = {}
    for c in columns:
        x, known = quoted(c), finite(c)
        spread = over.text(f"stddev_pop({known})", -size, -1)
        out[f"{c}_is_anom"] = F.expr(
            f"CASE WHEN {x} IS NULL OR {over.text(f'count({known})', -size, -1)} < {min_periods} THEN NULL"
            f" WHEN {spread} > 0 THEN CAST(abs({x} - {over.text(f'avg({known})', -size, -1)}) > {float(k)}D * {spread} AS DOUBLE)"
            f" WHEN {x} <> {over.text(f'min({known})', -size, -1)} THEN 1D END"
        )
    return out


# --- operators -----------------------------------------------------------------------------

def lag_features(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], lags: Sequence[int],
    name: str = "{c}_lag_{k}",
) -> DataFrame:
    """The value k rows back, per column and lag."""
    return layout.with_rows(df, spec, lambda over: lag_exprs(over, columns, lags, name), before=max(lags))


def lead_target(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], horizons: Sequence[int],
    name: str = "{c}_tplus_{h}",
) -> DataFrame:
    """The value h rows ahead, per column and horizon."""
    return layout.with_rows(
        df, spec, lambda over: lead_exprs(over, columns, horizons, name), after=max(horizons)
    )


def rolling_past(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], windows: Sequence[int] = ROLL_WINDOWS
) -> DataFrame:
    """Mean and population std of the previous rows, the current one excluded."""
    return layout.with_rows(
        df, spec, lambda over: rolling_past_exprs(over, columns, windows), before=max(windows)
    )


def moving_average(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], windows: Sequence[int] = ROLL_WINDOWS,
    strict: bool = False, name: str = "{c}_MA{w}",
) -> DataFrame:
    """Mean of the last W rows including the current one.

    ``strict`` asks for W known values; otherwise one is enough.
    """
    return layout.with_rows(
        df, spec, lambda over: moving_average_exprs(over, columns, windows, strict, name),
        before=max(windows) - 1,
    )


def rolling_stats(
    df: DataFrame, spec: SeriesSpec, column: str, size: int = 24, min_periods: int = 8, ddof: int = 1
) -> DataFrame:
    """Inclusive rolling mean and std of one column as a table; incomplete rows are dropped."""
    x, spread = finite(column), "stddev_samp" if ddof else "stddev_pop"

    def build(over: Over):
        enough = over(f"count({x})", 1 - size, 0) >= min_periods
        return {
            "rolling_mean": F.when(enough, over(f"avg({x})", 1 - size, 0)),
            "rolling_std": F.when(enough, over(f"{spread}({x})", 1 - size, 0)),
        }

    kept = [*spec.by, spec.ts, *spec.tiebreak]
    narrow = df.select(*[col(c) for c in dict.fromkeys([*kept, column])])
    out = layout.with_rows(narrow, spec, build, before=size - 1)
    return out.select(*[col(c) for c in kept], "rolling_mean", "rolling_std").dropna(
        subset=["rolling_mean", "rolling_std"]
    )


def diff1(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """First difference to the previous row."""
    return layout.with_rows(df, spec, lambda over: diff_exprs(over, columns), before=1)


def zscore_flag_past(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str],
    size: int = 24, min_periods: int = 12, k: float = 3.0,
) -> DataFrame:
    """1.0 where a value is over k stds from the mean of the previous rows; null if undecided."""
    return layout.with_rows(
        df, spec, lambda over: zscore_past_exprs(over, columns, size, min_periods, k), before=size
    )
