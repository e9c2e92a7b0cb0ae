"""Rolling statistics over a span of time instead of a number of rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep import layout
from seriesprep.functions.scalars import col, finite
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import stage

HOUR = 3_600_000_000  # in microseconds
PARTS = ("n", "mean", "square", "low", "high")  # count, mean, sum of squared distances to it, extremes
_AT, _T, _KIND, _CUT = "_at", "_t", "_kind", "_cut"
POINT, ASKED = 0, 1  # in this order at the same time


def rolling_time(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], hours: int = 24, min_periods: int = 1,
) -> DataFrame:
    """Mean and sample std over ``(t - hours, t]`` as ``{c}_mean_{h}h`` and ``{c}_std_{h}h``.

    Time is cut into spans as long as the frame, so a frame is the end of one span and the beginning of the next.
    Rows of one time are merged first. Then the times, and the points where frames begin, are placed on blocks of
    positions: within a block, statistics run forwards and backwards; what the other blocks of a span hold is chained over a
    table with two rows per block at most (:func:`seriesprep.layout.chain_blocks`). A crowded span is thus cut into as many tasks as it fills blocks, and the
    cost does not depend on the number of rows in a frame. Counts, means and squared distances are merged without differences
    of sums. Infinite values count as missing.
    """
    keys = {k: f"_by{i}" for i, k in enumerate(spec.by)}
    points = stage(_points(df, spec, keys, columns), "points")
    asked = points.select(*keys.values(), (F.col(_T) - F.expr(f"INTERVAL '{hours}' HOUR")).alias(_AT), _T, F.lit(ASKED).alias(_KIND))
    entries = points.withColumns({_AT: F.col(_T), _KIND: F.lit(POINT)}).unionByName(asked, allowMissingColumns=True)
    entries = entries.withColumn(_CUT, F.expr(_span(_AT, hours)))
    frames = _frames(entries, SeriesSpec(
        ts=_AT, by=(*keys.values(), _CUT), tiebreak=(_KIND,), layout="blocked", block_rows=spec.block_rows), list(keys.values()), len(columns))
    names = {k: f"_f_{r}" for k, r in keys.items()} | {spec.ts: "_f_t"}
    frames = frames.withColumnsRenamed({r: f"_f_{r}" for r in keys.values()} | {_T: "_f_t"})
    on = [col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    out: dict[str, Column] = {}
    for i, c in enumerate(columns):
        n, mean, square, low, high = _merged(*([F.col(f"_{side}_{p}{i}") for p in PARTS] for side in ("begin", "end")))
        equal = low == high  # then the mean is the value itself, and nothing is left of rounding
        spread = F.when(n > 1, F.when(equal, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(square, n - 1))))
        out[f"{c}_mean_{hours}h"] = F.when(n >= min_periods, F.when(equal, low).otherwise(mean))
        out[f"{c}_std_{hours}h"] = F.when(n >= min_periods, spread)
    return df.join(frames, on, "left").withColumns(out).drop(
        *names.values(), *[f"_{side}_{p}{i}" for side in ("begin", "end") for p in PARTS for i in range(len(columns))])


def _span(time: str, hours: int) -> str:
    origin = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    return f"floor(timestampdiff(MICROSECOND, {origin}, CAST({time} AS TIMESTAMP_NTZ)) / {hours * HOUR}L)"


def _points(df: DataFrame, spec: SeriesSpec, keys: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """The statistics of all rows of one time, partly merged before they are shuffled."""
    stats = []
    for i, c in enumerate(columns):
        x = F.expr(finite(c)).cast("double")
        stats += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"square{i}"),
                  F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}")]
    return df.groupBy(*[col(k).alias(r) for k, r in keys.items()], col(spec.ts).alias(_T)).agg(*stats)


def _merged(a: list[Column], b: list[Column]) -> list[Column]:
    """Statistics of two groups of rows together; either may be empty or null."""
    n1, n2 = (F.coalesce(x[0], F.lit(0)).cast("double") for x in (a, b))
    n = n1 + n2
    m1, m2 = F.coalesce(a[1], b[1]), F.coalesce(b[1], a[1])
    apart = m2 - m1
    square = F.coalesce(a[2], F.lit(0.0)) + F.coalesce(b[2], F.lit(0.0)) + F.coalesce(apart * apart * F.try_divide(n1 * n2, n), F.lit(0.0))
    return [n, m1 + apart * F.coalesce(F.try_divide(n2, n), F.lit(0.0)), square, F.least(a[3], b[3]), F.greatest(a[4], b[4])]


def _running(i: int, window: str, mark: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Statistics of column ``i`` up to the row, in two steps: counts and sums before it, then the rest."""
    ahead = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    n, mean = f"CAST(coalesce(n{i}, 0) AS DOUBLE)", f"coalesce(mean{i}, 0D)"
    before = {f"{mark}c{i}": F.expr(f"coalesce(sum({n}) {ahead}, 0D)"), f"{mark}s{i}": F.expr(f"coalesce(sum({n} * {mean}) {ahead}, 0D)")}
    had, total = f"{mark}c{i}", f"{mark}s{i}"
    gap = f"(mean{i} - try_divide({total}, {had}))"
    gain = f"coalesce(square{i}, 0D) + coalesce({gap} * {gap} * {n} * {had} / ({n} + {had}), 0D)"
    return before, {
        f"{mark}n{i}": F.expr(f"{had} + {n}"), f"{mark}mean{i}": F.expr(f"try_divide({total} + {n} * {mean}, {had} + {n})"),
        f"{mark}square{i}": F.expr(f"sum({gain}) {upto}"), f"{mark}low{i}": F.expr(f"min(low{i}) {upto}"), f"{mark}high{i}": F.expr(f"max(high{i}) {upto}"),
    }


def _frames(entries: DataFrame, spec: SeriesSpec, keys: list[str], count: int) -> DataFrame:
    """Per series and time, the statistics of the beginning of its span and of the end of the span before."""
    placed, how = layout.place(entries, spec)
    blocks = layout.halo_blocks(placed, how, 0, 0)
    part = "PARTITION BY " + ", ".join([layout.BLOCK, *how.by])
    extra = {"_first": F.expr(f"first({layout.POS}) OVER ({part} ORDER BY {layout.POS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
             "_next": F.expr(f"lead({layout.POS}) OVER ({part} ORDER BY {layout.POS})")}
    for mark, order in (("_f", ""), ("_b", " DESC")):
        steps = [_running(i, f"{part} ORDER BY {layout.POS}{order}", mark) for i in range(count)]
        for k in (0, 1):
            blocks = blocks.withColumns({n: c for step in steps for n, c in step[k].items()} | (extra if mark == "_f" and k else {}))
    blocks = blocks.drop(*[f"{m}{x}{i}" for m in ("_f", "_b") for x in ("c", "s") for i in range(count)])
    # what a block holds of a span that goes on in another one: the first or the last of its spans
    start = F.col(layout.BLOCK) * how.block_rows
    edges = blocks.filter(F.col("_next").isNull() & ((F.col("_first") == start) | (F.col(layout.POS) == start + (how.block_rows - 1))))
    names = [f"{p}{i}" for i in range(count) for p in PARTS]
    edges = stage(edges.select(layout.BLOCK, *how.by, *[F.col(f"_f{n}").alias(n) for n in names]), "span-edges")
    number = layout.number_of_blocks(placed, how)
    for mark, backwards in (("_f", False), ("_b", True)):
        past = layout.chain_blocks(edges, how.by, _total, _advance, number, backwards).withColumnRenamed(layout.STATE, f"{mark}state")
        blocks = layout.join_carry(blocks, past, how, [f"{mark}state"])
    return _merge_pasts(blocks, keys, count)


def _merge_pasts(blocks: DataFrame, keys: list[str], count: int) -> DataFrame:
    """One row per series and time, with the statistics of both parts of its frame."""
    found = {}
    for mark, kind, side in (("_f", POINT, "begin"), ("_b", ASKED, "end")):
        for i in range(count):
            past = [F.expr(f"try_cast(nullif({part}, '') AS DOUBLE)") for part in (
                f"split(decode({mark}state, 'UTF-8'), ' ')[{len(PARTS) * i + k}]" for k in range(len(PARTS)))]
            merged = _merged(past, [F.col(f"{mark}{p}{i}") for p in PARTS])
            found |= {f"_{side}_{p}{i}": F.max(F.when(F.col(_KIND) == kind, c)) for p, c in zip(PARTS, merged, strict=True)}
    return blocks.groupBy(*keys, _T).agg(*[c.alias(n) for n, c in found.items()])


def _parts(rows: pa.Table) -> np.ndarray:
    """(columns, parts, rows), missing parts as NaN."""
    names = [c for c in rows.column_names if c.rstrip("0123456789") in PARTS]
    data = np.array([rows.column(c).cast(pa.float64()).to_numpy() for c in names], float)
    return data.reshape(-1, len(PARTS), rows.num_rows)


def _running_sums(parts: np.ndarray) -> np.ndarray:
    """The statistics of all rows up to each, along the last axis."""
    n, mean, square = np.nan_to_num(parts[:, 0]), np.nan_to_num(parts[:, 1]), np.nan_to_num(parts[:, 2])
    count, total = np.cumsum(n, axis=1), np.cumsum(n * mean, axis=1)
    had = count - n
    with np.errstate(invalid="ignore", divide="ignore"):
        before = np.where(had > 0, (total - n * mean) / had, mean)
        gain = square + np.where(count > 0, n * had / count * (mean - before) ** 2, 0.0)
        means = np.where(count > 0, total / count, np.nan)
    return np.stack([count, means, np.cumsum(gain, axis=1), np.fmin.accumulate(parts[:, 3], axis=1), np.fmax.accumulate(parts[:, 4], axis=1)], axis=1)


def _total(rows: pa.Table) -> pa.Table:
    """All rows merged into one."""
    last = _running_sums(_parts(rows))[:, :, -1].ravel()
    out, one = rows.slice(0, 1), iter(last)
    for c in rows.column_names:
        if c.rstrip("0123456789") in PARTS:
            x = next(one)
            out = out.set_column(out.schema.get_field_index(c), rows.schema.field(c), pa.array([None if np.isnan(x) else x], rows.schema.field(c).type))
    return out


def _advance(rows: pa.Table, start: bytes | None) -> list[bytes | None]:
    """The merged statistics of what comes before each row, as text; None before the first."""
    parts = _parts(rows)
    if start is not None:
        came = np.array([float(v) if v else np.nan for v in start.decode().split(" ")]).reshape(-1, len(PARTS), 1)
        parts = np.concatenate([came, parts], axis=2)
    upto = _running_sums(parts).reshape(-1, parts.shape[2])
    states = [" ".join("" if np.isnan(x) else repr(float(x)) for x in upto[:, k]).encode() for k in range(upto.shape[1])]
    return [None, *states[:-1]] if start is None else states[:-1]
