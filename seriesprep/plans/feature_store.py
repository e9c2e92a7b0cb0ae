"""The past-only feature table, and its lighter variant for models trained per split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seriesprep import layout
from seriesprep.functions.scalars import calendar, col, cyclical, day_of_week, hour_of_day, is_weekend, quoted, with_calendar
from seriesprep.operators.cleaning import sentinel_to_null
from seriesprep.operators.impute import interpolate_time
from seriesprep.operators.ewm import EWM_SPANS, ewm_mean
from seriesprep.operators.windows import (
    MAX_LAG, ROLL_WINDOWS, diff_exprs, lag_exprs, moving_average_exprs, rolling_past_exprs, zscore_past_exprs,
)
from seriesprep.spec import SeriesSpec


def feature_store(
    df: DataFrame, spec: SeriesSpec, max_lag: int = MAX_LAG, roll: Sequence[int] = ROLL_WINDOWS,
    spans: Sequence[int] = EWM_SPANS, anomaly_size: int = 24,
) -> DataFrame:
    """Signals, calendar, lags, rolling statistics, weighted means, differences and z-score flags.

    The rows are placed once. The weighted means see only the signal columns; all other
    features share one window, hence one shuffle and one sort. ``spans=()`` leaves the
    weighted means out.
    """
    signals = [c for c in spec.signals if c in df.columns]
    keys = list(dict.fromkeys([*spec.by, spec.ts, *spec.tiebreak]))
    base = df.select(*map(quoted, keys + signals))
    reach = max([max_lag, anomaly_size, *roll])
    placed, how = layout.place(base, spec, reach)
    if spans:
        placed = ewm_mean(placed, how, signals, spans)

    def build(over: layout.Over):
        return (
            lag_exprs(over, signals, range(1, max_lag + 1))
            | rolling_past_exprs(over, signals, roll)
            | diff_exprs(over, [c for c in spec.features if c in signals])
            | zscore_past_exprs(over, [c for c in spec.targets if c in signals], anomaly_size)
        )

    out = layout.with_rows(placed, how, build, before=reach).drop(layout.POS)
    ts = col(spec.ts)
    out = out.withColumns(calendar(ts) | {"is_weekend": is_weekend(ts)} | cyclical(ts))
    return out.select(*map(quoted, feature_names(keys, signals, spec, max_lag, roll, spans)))


def feature_names(keys, signals, spec: SeriesSpec, max_lag, roll, spans) -> list[str]:
    """Column order of the feature table."""
    names = [*keys, *signals, "hour", "dow", "month", "is_weekend"]
    names += [f"{f}_{g}" for f in ("hour", "dow", "month") for g in ("sin", "cos")]
    names += [f"{c}_lag_{k}" for c in signals for k in range(1, max_lag + 1)]
    names += [f"{c}_roll{w}_{s}" for c in signals for w in roll for s in ("mean", "std")]
    names += [f"{c}_ewm{s}_mean" for c in signals for s in spans]
    names += [f"{c}_diff_1" for c in spec.features if c in signals]
    names += [f"{c}_is_anom" for c in spec.targets if c in signals]
    return names


def temporal_features(
    df: DataFrame, spec: SeriesSpec, lags: Sequence[int] = (1, 3, 6, 12, 24), windows: Sequence[int] = ROLL_WINDOWS
) -> DataFrame:
    """Hour, day of week, some lags and inclusive moving averages; the missing marker is nulled first.

    Pass a spec keyed by the split to compute them inside each split.
    """
    signals = [c for c in spec.signals if c in df.columns]
    clean = sentinel_to_null(df)

    def build(over: layout.Over):
        return lag_exprs(over, signals, lags, "{c}_lag{k}") | moving_average_exprs(over, signals, windows, False, "{c}_MA{w}")

    reach = max(max(lags), max(windows) - 1)
    out = layout.with_rows(clean, spec, build, before=reach)
    return out.withColumns({"hour": hour_of_day(col(spec.ts)), "dayofweek": day_of_week(col(spec.ts))})


def tree_features(
    df: DataFrame, spec: SeriesSpec, target: str, lags: Sequence[int] = (1, 6, 12, 24), windows: Sequence[int] = ROLL_WINDOWS
) -> DataFrame:
    """Hour, weekday, month, lags and strict moving averages of the target."""
    def build(over: layout.Over):
        return lag_exprs(over, [target], lags) | moving_average_exprs(over, [target], windows, True, "{c}_ma_{w}")

    out = layout.with_rows(df, spec, build, before=max(max(lags), max(windows) - 1))
    return out.withColumns(calendar(col(spec.ts), "weekday"))


def boosting_features(df: DataFrame, spec: SeriesSpec, targets: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Features for boosting: non-target signals, calendar and lag 1 of each target, gaps interpolated.

    Targets keep their gaps, since labels are made from them. Calendar columns that are there
    are kept. Returns the frame and the feature names; nulls that are left take the training
    median in the preparation of the model.
    """
    df = with_calendar(df, spec.ts, overwrite=False)
    placed, how = layout.place(df, spec, 1)
    lagged = layout.with_rows(placed, how, lambda over: lag_exprs(over, targets, [1], "{c}_lag{k}"), before=1)
    gappy = [c for c in spec.features if c in df.columns] + [f"{t}_lag1" for t in targets]
    out = interpolate_time(lagged, how, gappy)
    if spec.layout != "indexed":
        out = out.drop(layout.POS)
    return out, [*gappy, "hour", "weekday", "month"]
