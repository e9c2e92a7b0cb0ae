"""Exact quantiles of any number of columns by radix selection.

Doubles are read as 64-bit keys of the same order. A pass counts, for every wanted rank, the values that share the key bits known so
far by their next bits; the bucket that holds the rank gives these bits. A pass has as many bits as ``CELLS`` counters allow,
so tasks and the driver hold a bounded table of counts, whatever the number of rows, columns and ranks: four passes for a
few columns, seven for some thousand ranks. No values are held, sorted or collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col

CELLS = 1 << 20
_TOP = np.uint64(1 << 63)


def keys_of(x: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the doubles; both zeros are one."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value_of(key: int) -> float:
    bits = key & ~(1 << 63) if key >> 63 else ~key & (2**64 - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column (None for a column without values; NaN counts as missing)."""
    columns = list(columns)
    if not columns:
        return {}
    data = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    known = {(i, 0): 0 for i in range(len(columns))}  # (column, key bits known so far) to the rank of the first value there
    wanted: dict[tuple[int, int], int] | None = None  # (column, rank) to the key bits known so far
    sizes, done = [0] * len(columns), 0
    while done < 64 and known:
        width = max(1, min(16, 64 - done, int(math.log2(CELLS / len(known)))))
        counts = _count(data, sorted(known), done, width)
        if wanted is None:
            sizes = [int(counts[i].sum()) for i in range(len(columns))]
            places = [[p * (n - 1) for p in probs] for n in sizes]
            wanted = {(i, r): 0 for i, n in enumerate(sizes) if n for at in places[i] for r in (math.floor(at), math.ceil(at))}
        before = {key: np.concatenate([[0], np.cumsum(row)]) for key, row in zip(sorted(known), counts, strict=True)}
        narrower: dict[tuple[int, int], int] = {}
        for (i, rank), prefix in wanted.items():
            bucket = int(np.searchsorted(before[i, prefix], rank - known[i, prefix], "right")) - 1
            wanted[i, rank] = longer = (prefix << width) | bucket
            narrower[i, longer] = known[i, prefix] + int(before[i, prefix][bucket])
        known, done = narrower, done + width
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for i, c in enumerate(columns):
        if sizes[i]:
            ends = [(value_of(wanted[i, math.floor(at)]), value_of(wanted[i, math.ceil(at)]), at - math.floor(at)) for at in places[i]]
            out[c] = [low if low == high else low + (high - low) * part for low, high, part in ends]
    return out


def _count(data: DataFrame, known: list[tuple[int, int]], done: int, width: int) -> np.ndarray:
    """For each (column, known bits), how many values go on with each of the next ``width`` bits."""
    size = 1 << width
    of_column: dict[int, list[int]] = {}
    first_of: dict[int, int] = {}
    for k, (i, prefix) in enumerate(known):
        of_column.setdefault(i, []).append(prefix)
        first_of.setdefault(i, k)
    prefixes = {i: (np.array(p, np.uint64), first_of[i]) for i, p in of_column.items()}
    used = sorted(prefixes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known) * size, np.int64)
        for b in batches:
            for at, i in enumerate(used):
                x = b.column(at).to_numpy(zero_copy_only=False).astype(np.float64)
                key = keys_of(x[~np.isnan(x)])
                own, first = prefixes[i]
                if done:
                    head = key >> np.uint64(64 - done)
                    slot = np.minimum(np.searchsorted(own, head), len(own) - 1)
                    there = own[slot] == head
                    key, slot = key[there], slot[there]
                else:
                    slot = np.zeros(len(key), np.int64)
                bucket = (key >> np.uint64(64 - done - width)) & np.uint64(size - 1)
                found = np.bincount(slot * size + bucket.astype(np.int64), minlength=len(own) * size)
                total[first * size : (first + len(own)) * size] += found
        cells = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    rows = data.select(*[f"c{i}" for i in used]).mapInArrow(run, "cell LONG, n LONG")
    table = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    out = np.zeros(len(known) * size, np.int64)
    out[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(len(known), size)
