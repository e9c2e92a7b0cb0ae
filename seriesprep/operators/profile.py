"""Tables that describe a data set: summaries, missing rates, histograms, correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.quantiles import exact_quantiles
from seriesprep.functions.scalars import col, day_of_week, hour_of_day
from seriesprep.operators.cleaning import numeric_columns
from seriesprep.operators.impute import unpivot_row
from seriesprep.operators.windows import rolling_stats
from seriesprep.spec import SeriesSpec

QUARTILES = (0.25, 0.5, 0.75)
MOMENTS = ("n", "mean of x", "mean of y", "squares of x", "squares of y", "products")
BAND_BYTES = 1 << 20
MERGE_GROUPS = 256


def table_summary(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows, columns and time range."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        F.min(col(spec.ts)).alias("first_ts"), F.max(col(spec.ts)).alias("last_ts"),
    )


def missing_rate(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column."""
    names = list(columns) if columns is not None else df.columns
    row = df.agg(*[F.avg(col(c).isNull().cast("int")).alias(c) for c in names])
    return unpivot_row(row, names, "column", "missing_rate")


def top_missing(df: DataFrame, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The k columns with the highest share of nulls; one row per column is sorted."""
    return missing_rate(df, columns).orderBy(F.desc("missing_rate"), "column").limit(k)


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, and by type: distinct, mode and its count (text); moments and quartiles (numbers, times).

    Values of text columns are counted as (column, value) pairs, so neither the number of
    distinct values nor a frequent value burdens one task. Times are given in text.
    """
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema if f.name in names}
    numbers = [c for c in names if isinstance(kinds[c], T.NumericType)]
    times = [c for c in names if isinstance(kinds[c], (T.TimestampNTZType, T.TimestampType, T.DateType))]
    texts = [c for c in names if c not in numbers and c not in times]
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = {c: F.timestamp_diff("MICROSECOND", origin, col(c).cast("timestamp_ntz")) for c in times}
    as_number = df.select(*[col(c).cast("double").alias(c) for c in numbers],
                          *[m.cast("double").alias(c) for c, m in micros.items()])
    quartiles = exact_quantiles(as_number, numbers + times, QUARTILES)
    pieces = []
    for c in numbers + times:
        x = col(c).cast("double") if c in numbers else micros[c].cast("double")
        q = quartiles[c]
        stats = [F.avg(x), F.stddev_samp(x), F.min(x), *[F.lit(v).cast("double") for v in q], F.max(x)]
        if c in times:
            stats = [_moment(s) for s in stats]
            stats[1] = F.lit(None).cast("string")
        else:
            stats = [s.cast("double") for s in stats]
        kind = "number" if c in numbers else "time"
        pieces.append((c, kind, F.count(col(c)), stats))
    fields = ("mean", "std", "min", "q25", "q50", "q75", "max")
    aggs = []
    for i, (_, _, count, stats) in enumerate(pieces):
        aggs += [count.alias(f"_{i}_count"), *[s.alias(f"_{i}_{f}") for s, f in zip(stats, fields)]]
    rows = []
    for i, (c, kind, _, _) in enumerate(pieces):
        number = [(F.col(f"_{i}_{f}") if kind == "number" else F.lit(None).cast("double")).alias(f) for f in fields]
        moment = [
            (F.col(f"_{i}_{f}") if kind == "time" else F.lit(None).cast("string")).alias(f"ts_{f}")
            for f in fields if f != "std"
        ]
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"_{i}_count").alias("count"), *number, *moment))
    out = None
    if rows:
        out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    if texts:
        top = text_summary(df, texts)
        out = top if out is None else out.unionByName(top, allowMissingColumns=True)
    return out


def _moment(micros: Column) -> Column:
    """Text of a time given in microseconds."""
    return F.timestamp_micros(F.floor(micros).cast("long")).cast("timestamp_ntz").cast("string")


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (the smallest on ties) and its count."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns
    ])
    pairs = df.select(F.explode(cells).alias("_e")).select("_e.column", "_e.value")
    counted = pairs.groupBy("column", "value").agg(F.count("value").alias("n"))
    # the best is the highest count, then the smallest value
    best = F.min(F.when(F.col("n") > 0, F.struct((-F.col("n")).alias("neg"), F.col("value"))))
    return counted.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("value").alias("distinct"), best.alias("_b")
    ).select("column", "count", "distinct", F.col("_b.value").alias("top"), (-F.col("_b.neg")).alias("freq"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum with counts, empty bins included; the last is closed.

    A column with a single value gets a range of one around it.
    """
    low, high = df.agg(F.min(col(column)), F.max(col(column))).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    at = F.least(F.floor((col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # one row per bin on either side
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def mean_by_hour(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(hour_of_day(col(spec.ts)).alias("hour")).agg(*[F.avg(col(c)).alias(c) for c in columns])


def mean_by_dow(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Means per day of the week, Monday = 0."""
    return df.groupBy(day_of_week(col(spec.ts)).alias("dow")).agg(*[F.avg(col(c)).alias(c) for c in columns])


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair over the rows that have both, null for constants.

    One scan: a task multiplies the matrices of its rows, centred, and of what is known in them, which gives counts, means and
    co-moments of all pairs at once. Matrices are cut into bands of rows and merged band by band, first by groups of tasks.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    size = len(names)
    if not size:
        return df.sparkSession.createDataFrame([], "x string, y string, corr double")
    high = max(1, min(size, BAND_BYTES // (8 * size * len(MOMENTS))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(MOMENTS), size, size))
        for b in batches:
            if b.num_rows:
                x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(size)])
                total = _merge_moments(total, _moments(x))
        for lo in range(0, size, high):
            part = total[:, lo : lo + high]
            yield pa.record_batch([pa.array([lo], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["band", "m"])

    def merged(table: pa.Table) -> np.ndarray:
        parts = sorted(table.column("m").to_pylist())  # in an order of their own, so the result does not depend on the shuffle's
        total = np.frombuffer(parts[0]).reshape(len(MOMENTS), -1, size)
        for p in parts[1:]:
            total = _merge_moments(total, np.frombuffer(p).reshape(total.shape))
        return total

    def fewer(table: pa.Table) -> pa.Table:
        return pa.table([table.column("band")[:1], pa.array([merged(table).tobytes()], pa.binary())], names=["band", "m"])

    def pairs(table: pa.Table) -> pa.Table:
        lo, m = table.column("band")[0].as_py(), merged(table)
        with np.errstate(invalid="ignore", divide="ignore"):
            corr = m[5] / np.sqrt(m[3] * m[4])
        known = ((m[3] > 0) & (m[4] > 0)).ravel()
        x, y = np.indices(corr.shape)
        return pa.table([pa.array([names[lo + i] for i in x.ravel()]), pa.array([names[j] for j in y.ravel()]), pa.array(corr.ravel(), mask=~known)],
                        names=["x", "y", "corr"])

    parts = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).mapInArrow(measure, "band INT, m BINARY")
    parts = parts.withColumn("g", F.spark_partition_id() % MERGE_GROUPS).groupBy("band", "g").applyInArrow(lambda t: fewer(t), "band INT, m BINARY")
    return parts.groupBy("band").applyInArrow(lambda t: pairs(t), "x STRING, y STRING, corr DOUBLE")


def _moments(x: np.ndarray) -> np.ndarray:
    """Counts, means and centred moments of all pairs of columns over the rows that have both."""
    known = ~np.isnan(x)
    v = known.astype(float)
    count = v.sum(axis=0)
    centre = np.where(known, x, 0.0).sum(axis=0) / np.maximum(count, 1)
    low, high = (f(np.where(known, x, s), axis=0) for f, s in ((np.min, np.inf), (np.max, -np.inf)))
    centre = np.where(low == high, low, centre)
    d = np.where(known, x - centre, 0.0)
    n, sums, squares, products = v.T @ v, d.T @ v, (d * d).T @ v, d.T @ d
    many = np.maximum(n, 1)
    own = np.maximum(squares - sums * sums / many, 0.0)
    own = np.where(own <= 1e-13 * squares, 0.0, own)  # nothing but rounding is left
    return np.stack([n, np.where(n > 0, centre[:, None] + sums / many, 0.0), np.where(n > 0, centre[None, :] + sums.T / many, 0.0),
                     own, own.T, products - sums * sums.T / many])


def _merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    many = np.maximum(n, 1)
    dx, dy = (np.where((a[0] > 0) & (b[0] > 0), b[k] - a[k], 0.0) for k in (1, 2))
    share, weight = b[0] / many, a[0] * b[0] / many
    means = [np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy))]
    return np.stack([n, *means, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight])


def rolling_volatility(df: DataFrame, spec: SeriesSpec, column: str, size: int = 24, min_periods: int = 8) -> DataFrame:
    """Rolling mean and sample std of one column."""
    return rolling_stats(df, spec, column, size, min_periods)
