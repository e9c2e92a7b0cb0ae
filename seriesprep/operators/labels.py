"""Labels some rows ahead, naive forecasts, and scaling fitted on train.

Pass a spec keyed by the split (``spec.keyed("split")``): a label is then taken from the same
split, and the last h rows of each split have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.functions.scalars import bin_left_closed, bin_right_closed, col, quoted
from seriesprep.layout import Over
from seriesprep.metrics import rmse_expr
from seriesprep.spec import SeriesSpec

HORIZONS = (1, 6, 12, 24)
CO_EDGES = (1.5, 2.5)  # fixed values: low / mid / high carbon monoxide


def _ahead(c: str, h: int) -> str:
    return f"lead({quoted(c)}, {h})"


def label_regression(df: DataFrame, spec: SeriesSpec, target: str, h: int) -> DataFrame:
    """``y`` h rows ahead and ``y_naive`` now; rows with either missing are dropped."""
    out = layout.with_rows(df, spec, lambda over: {"y": over(_ahead(target, h))}, after=h)
    return out.withColumn("y_naive", col(target)).dropna(subset=["y", "y_naive"])


def label_multi(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], h: int, require_current: bool = True
) -> DataFrame:
    """``y__t`` and ``y_naive__t`` per target, rows with any missing label dropped.

    Training also needs every current value; scoring keeps rows without one
    (``require_current=False``).
    """
    def build(over: Over):
        return {f"y__{t}": over(_ahead(t, h)) for t in targets}

    out = layout.with_rows(df, spec, build, after=h).withColumns({f"y_naive__{t}": col(t) for t in targets})
    needed = [f"y__{t}" for t in targets]
    if require_current:
        needed += [f"y_naive__{t}" for t in targets]
    return out.dropna(subset=needed)


def label_class(
    df: DataFrame, spec: SeriesSpec, target: str, h: int, edges: Sequence[float] = CO_EDGES
) -> DataFrame:
    """Left-closed class ahead (``y``) and now (``y_naive``); rows with either missing dropped."""
    out = layout.with_rows(df, spec, lambda over: {"y": over(_ahead(target, h))}, after=h)
    return out.withColumns({
        "y": bin_left_closed(F.col("y"), edges), "y_naive": bin_left_closed(col(target), edges)
    }).dropna(subset=["y", "y_naive"])


def label_horizons(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], horizons: Sequence[int] = HORIZONS,
    edges: Sequence[float] | None = None, name: str = "{t}_tplus_{h}",
) -> DataFrame:
    """All horizons side by side in one window pass; with ``edges`` as right-closed classes."""
    def build(over: Over):
        out: dict[str, Column] = {}
        for t in targets:
            for h in horizons:
                ahead = over(_ahead(t, h))
                out[name.format(t=t, h=h)] = ahead if edges is None else bin_right_closed(ahead, edges)
        return out

    return layout.with_rows(df, spec, build, after=max(horizons))


def label_single(
    df: DataFrame, spec: SeriesSpec, target: str, h: int, edges: Sequence[float] | None = None,
    keep_unlabeled: bool = False, name: str | None = None,
) -> DataFrame:
    """One future value or right-closed class; unlabeled rows are dropped unless kept."""
    label = name or f"{target}_target"

    def build(over: Over):
        ahead = over(_ahead(target, h))
        return {label: ahead if edges is None else bin_right_closed(ahead, edges)}

    out = layout.with_rows(df, spec, build, after=h)
    return out if keep_unlabeled else out.dropna(subset=[label])


# --- baselines -----------------------------------------------------------------------------

def baseline_persistence(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], horizons: Sequence[int] = HORIZONS,
    group: Sequence[str] = (),
) -> DataFrame:
    """RMSE of the current value as forecast, per target and horizon; one pass for all."""
    return _baseline(df, spec, targets, horizons, group, 0)


def baseline_seasonal(
    df: DataFrame, spec: SeriesSpec, targets: Sequence[str], horizons: Sequence[int] = HORIZONS,
    period: int = 24, group: Sequence[str] = (),
) -> DataFrame:
    """RMSE of the value ``period`` rows ago as forecast, per target and horizon."""
    return _baseline(df, spec, targets, horizons, group, period)


def _baseline(df, spec, targets, horizons, group, back) -> DataFrame:
    def build(over: Over):
        out: dict[str, Column] = {}
        for i, t in enumerate(targets):
            out[f"_b{i}"] = over(f"lag({quoted(t)}, {back})") if back else col(t)
            for h in horizons:
                out[f"_y{i}_{h}"] = over(_ahead(t, h))
        return out

    work = layout.with_rows(df, spec, build, before=back, after=max(horizons))
    cells = {
        f"_{i}_{h}": rmse_expr(F.col(f"_y{i}_{h}"), F.col(f"_b{i}"))
        for i in range(len(targets)) for h in horizons
    }
    counts = {
        f"_n{k}": F.count(F.col("_y" + k[1:]) + F.col("_b" + k[1:].split("_")[0])) for k in cells
    }
    wide = work.groupBy(*group).agg(*[c.alias(n) for n, c in {**cells, **counts}.items()])
    rows = F.array(*[
        F.struct(F.lit(t).alias("target"), F.lit(h).alias("horizon"),
                 F.col(f"_n_{i}_{h}").alias("n"), F.col(f"_{i}_{h}").alias("rmse"))
        for i, t in enumerate(targets) for h in horizons
    ])
    return wide.select(*group, F.explode(rows).alias("_r")).select(*group, "_r.*")


def baseline_persistence_class(
    df: DataFrame, spec: SeriesSpec, target: str, horizons: Sequence[int] = HORIZONS,
    edges: Sequence[float] = CO_EDGES, group: Sequence[str] = (),
) -> DataFrame:
    """Current class as forecast in long form: (group, horizon, y, p), both known."""
    labeled = label_horizons(df, spec, [target], horizons, edges, name="_y_{h}")
    now = bin_right_closed(col(target), edges)
    rows = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"_y_{h}").alias("y"), now.alias("p")) for h in horizons
    ])
    return labeled.select(*group, F.explode(rows).alias("_r")).select(*group, "_r.*").dropna(subset=["y", "p"])


# --- scaling -------------------------------------------------------------------------------

def fit_scale(train: DataFrame, columns: Sequence[str], tiny: float = 0.0) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column; a std up to ``tiny`` becomes 1."""
    row = train.agg(*[
        F.struct(F.avg(col(c)).alias("m"), F.stddev_pop(col(c)).alias("s")).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {
        c: (row[i]["m"], row[i]["s"] if row[i]["s"] > tiny else 1.0)
        for i, c in enumerate(columns) if row[i]["m"] is not None
    }


def apply_scale(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({
        c + suffix: (col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items() if c in df.columns
    })


def undo_scale(df: DataFrame, columns: dict[str, str], params: dict[str, tuple[float, float]]) -> DataFrame:
    """Back to original units; ``columns`` maps a predicted column to its target."""
    return df.withColumns({
        c: col(c) * F.lit(params[t][1]) + F.lit(params[t][0]) for c, t in columns.items()
    })


def normalize_target(df: DataFrame, train: DataFrame, targets: Sequence[str]):
    """Targets to mean 0 and population std 1 on train; returns the frame and the parameters."""
    params = fit_scale(train, targets, tiny=1e-6)
    return apply_scale(df, params, "_n"), params


def standard_scale(df: DataFrame, train: DataFrame, columns: Sequence[str]):
    """Features to mean 0 and population std 1 on train; returns the frame and the parameters."""
    params = fit_scale(train, columns)
    return apply_scale(df, params), params


def class_weights(train: DataFrame, label: str = "y", classes: int = 3) -> DataFrame:
    """Weight n / (classes * count) per class that occurs."""
    counts = train.groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.select(label, "n", (total / (F.lit(float(classes)) * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, weights: DataFrame, label: str = "y", name: str = "weight") -> DataFrame:
    """Join the weight of each row's class; one row per class."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(name))), label, "left")
