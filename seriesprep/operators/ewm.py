"""Exponentially weighted means of past values, exact over any series length.

The recursive mean moves from ``y`` to ``(w*y + a*x) / (w + a)`` at each known value ``x``, with
``a = 2/(span+1)`` and ``w = (1-a)**rows`` since the known value before; a null row keeps the mean
and ages its weight. Started without a past, a block gives means ``f``. The past only changes
the first known value of the block from ``x`` to some ``y``, and every later mean by
``A*(y - x)``, where ``A`` is the product of the factors ``w/(w + a)`` so far. So each block is
summed up by a handful of numbers. Summaries of neighbours merge into one of the same kind, so they are chained by spans
of blocks (:func:`seriesprep.layout.chain_blocks`), and a second pass over the blocks adds the correction.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep import layout
from seriesprep.functions.scalars import col
from seriesprep.spec import SeriesSpec

EWM_SPANS = (6, 12, 24)
PAST = "_past"


def _known(table: pa.Table, name: str) -> np.ndarray:
    x = table.column(name).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.where(np.isfinite(x), x, np.nan)  # infinite values count as missing


def _alone(x: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Means of ``x`` without a past, and the factor A at every row (NaN before the first value)."""
    mean = pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    seen = ~np.isnan(x)
    at = np.flatnonzero(seen)
    if not len(at):
        return mean, np.full(len(x), np.nan)
    w = (1.0 - alpha) ** np.diff(at)
    factor = np.concatenate([[1.0], np.cumprod(w / (w + alpha))])
    order = np.cumsum(seen) - 1
    return mean, np.where(order >= 0, factor[order], np.nan)


def _blend(y: float, weight: float, x: float, alpha: float) -> float:
    """The mean after a known value ``x`` when the past is ``y`` with the given weight."""
    return (weight * y + alpha * x) / (weight + alpha)


def ewm_mean(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str], spans: Sequence[int] = EWM_SPANS,
    name: str = "{c}_ewm{s}_mean",
) -> DataFrame:
    """Recursive weighted mean of the rows before each row, per column and span.

    Equals ``shift(1).ewm(span, adjust=False).mean()`` of a single frame.
    """
    placed, how = layout.place(df, spec)
    alphas = [2.0 / (s + 1) for s in spans]
    cells = [(c, a) for c in columns for a in alphas]
    names = [name.format(c=c, s=s) for c in columns for s in spans]
    blocked = how.layout == "indexed"
    if blocked:
        blocks = layout.halo_blocks(placed, how, 0, 0)
        keys, order = [layout.BLOCK, *how.by], [layout.POS]
        work = _with_past(blocks, how, columns, cells, keys)
    else:
        keys, order = list(how.by), layout.order_keys(how)
        work = placed
    out_schema = T.StructType(
        [f for f in work.schema if f.name != PAST]
        + [T.StructField(n, T.DoubleType()) for n in names]
    )
    arrow_names = [f.name for f in out_schema][: -len(names)]
    sort_by = [(k, "ascending") for k in order]

    def local(table: pa.Table) -> pa.Table:
        past = weight = np.full(len(cells), np.nan)
        if blocked and table.column(PAST).null_count < table.num_rows:
            past, weight = np.frombuffer(table.column(PAST).drop_null()[0].as_py()).reshape(2, -1)
        table = out = table.select(arrow_names).sort_by(sort_by)
        for i, (c, a) in enumerate(cells):
            x = _known(table, c)
            mean, factor = _alone(x, a)
            if not np.isnan(past[i]):
                at = np.flatnonzero(~np.isnan(x))
                if len(at):
                    first = x[at[0]]
                    y = _blend(past[i], weight[i] * (1.0 - a) ** (at[0] + 1), first, a)
                    mean = mean + factor * (y - first)
                mean = np.where(np.isnan(mean), past[i], mean)
            shifted = np.concatenate([[past[i]], mean[:-1]])
            out = out.append_column(names[i], pa.array(shifted, mask=np.isnan(shifted)))
        return out

    result = work.groupBy(*[col(k) for k in keys]).applyInArrow(local, out_schema)
    if not blocked:
        return result
    return result.drop(layout.BLOCK) if spec.layout == "indexed" else result.drop(layout.BLOCK, layout.POS)


def _with_past(blocks: DataFrame, spec: SeriesSpec, columns, cells, keys) -> DataFrame:
    """Join to each block the means and weights that its series brings along, packed in ``_past``.

    Packed because list columns are slow to hand over to Python row by row.
    """
    key_fields = [blocks.schema[k] for k in keys]
    narrow = blocks.select(*keys, layout.POS, *[col(c) for c in dict.fromkeys(columns)])
    summary_schema = T.StructType(key_fields + [
        T.StructField("n", T.LongType()),
        *[T.StructField(f, T.ArrayType(T.DoubleType()))
          for f in ("lead", "first", "tail", "mean", "factor")],
    ])

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by(layout.POS)
        n = table.num_rows
        lead, first, tail, mean, factor = [], [], [], [], []
        for c, a in cells:
            x = _known(table, c)
            at = np.flatnonzero(~np.isnan(x))
            if len(at):
                m, f = _alone(x, a)
                lead.append(float(at[0] + 1)), first.append(float(x[at[0]]))
                tail.append(float(n - 1 - at[-1]))
                mean.append(float(m[-1])), factor.append(float(f[-1]))
            else:
                for part in (lead, first, tail, mean, factor):
                    part.append(None)
        row = {k: table.column(k)[:1] for k in keys} | {"n": [n]}
        parts = {"lead": lead, "first": first, "tail": tail, "mean": mean, "factor": factor}
        return pa.table(row | {k: pa.array([v], pa.list_(pa.float64())) for k, v in parts.items()})

    summary = narrow.groupBy(*keys).applyInArrow(summarise, summary_schema)
    alphas = np.array([a for _, a in cells])
    past = layout.chain_blocks(
        summary, spec.by, lambda rows: _total(rows, alphas), lambda rows, start: _advance(rows, start, alphas), layout.number_of_blocks(blocks, spec))
    past = past.withColumnRenamed(layout.STATE, PAST)
    joined = layout.join_carry(blocks, past, spec, [PAST])
    # the series that comes in starts the block, so its first row is enough to hold the past
    starts = F.col(layout.POS) == F.col(layout.BLOCK) * spec.block_rows
    return joined.withColumn(PAST, F.when(starts, F.col(PAST)))


def _summaries(rows: pa.Table) -> dict[str, np.ndarray]:
    """Row counts, and per part a matrix of blocks and cells, NaN where a block has no known value."""
    out = {"n": rows.column("n").to_numpy()}
    for part in ("lead", "first", "tail", "mean", "factor"):
        out[part] = np.array([[np.nan if v is None else v for v in cells] for cells in rows.column(part).to_pylist()], float)
    return out


def _blend_all(y: np.ndarray, weight: np.ndarray, x: np.ndarray, alphas: np.ndarray) -> np.ndarray:
    return (weight * y + alphas * x) / (weight + alphas)


def _advance(rows: pa.Table, start: bytes | None, alphas: np.ndarray) -> list[bytes | None]:
    """Means and weights that come into each block, packed; None into the first of a series."""
    parts, keep = _summaries(rows), 1.0 - alphas
    y, w = np.full((2, len(alphas)), np.nan) if start is None else np.frombuffer(start).reshape(2, -1)
    states: list[bytes | None] = []
    for r in range(rows.num_rows):
        states.append(np.array([y, w]).tobytes() if r or start is not None else None)
        x = parts["first"][r]
        begin = _blend_all(y, w * keep ** parts["lead"][r], x, alphas)
        moved = np.where(np.isnan(y), 0.0, parts["factor"][r] * (begin - x))
        known = ~np.isnan(x)
        y = np.where(known, parts["mean"][r] + moved, y)
        w = np.where(known, keep ** parts["tail"][r], w * keep ** float(parts["n"][r]))
    return states


def _total(rows: pa.Table, alphas: np.ndarray) -> pa.Table:
    """The summary of neighbouring blocks taken as one."""
    parts, keep = _summaries(rows), 1.0 - alphas
    n, none = 0.0, np.full(len(alphas), np.nan)
    lead, first, tail, mean, factor = none, none, none, none, none
    for r in range(rows.num_rows):
        x, own = parts["first"][r], {p: parts[p][r] for p in ("lead", "tail", "mean", "factor")}
        known, seen = ~np.isnan(x), ~np.isnan(first)
        weight = keep ** (tail + own["lead"])
        begin = _blend_all(mean, weight, x, alphas)
        mean = np.where(known, np.where(seen, own["mean"] + own["factor"] * (begin - x), own["mean"]), mean)
        factor = np.where(known, np.where(seen, factor * own["factor"] * weight / (weight + alphas), own["factor"]), factor)
        tail = np.where(known, own["tail"], tail + float(parts["n"][r]))
        lead, first = np.where(seen, lead, n + own["lead"]), np.where(seen, first, x)
        n += float(parts["n"][r])
    out = rows.slice(0, 1)
    for name, value in (("lead", lead), ("first", first), ("tail", tail), ("mean", mean), ("factor", factor)):
        cells = [[None if np.isnan(v) else float(v) for v in value]]
        out = out.set_column(out.schema.get_field_index(name), name, pa.array(cells, pa.list_(pa.float64())))
    return out.set_column(out.schema.get_field_index("n"), "n", pa.array([int(n)], pa.int64()))
