"""Checks of a clean table against the raw table it came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep import layout
from seriesprep.functions.scalars import col, to_number
from seriesprep.operators.cleaning import (
    SENTINEL, build_timestamp, dedup_first, drop_all_missing, drop_null_timestamp, sentinel_to_null,
)
from seriesprep.operators.impute import unpivot_row
from seriesprep.spec import SeriesSpec

CHECKS = "check string, column string, status string, count long"


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Single-row tables with different columns as one row."""
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def is_sorted_unique(df: DataFrame, spec: SeriesSpec, ordinal: str | None = None) -> DataFrame:
    """Times that occur more than once, and rows out of time order along the ingest ``ordinal``.

    A Spark table has no order of its own, so order is only checked against an ordinal.
    """
    keys = [col(k).alias(k) for k in (*spec.by, spec.ts)]
    repeats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("repeated_times")
    )
    if ordinal is None:
        return repeats.select("repeated_times", F.lit(None).cast("long").alias("out_of_order"))
    along = spec.using(ts=ordinal, tiebreak=())
    narrow = df.select(*spec.by, col(ordinal), col(spec.ts).alias("_t"))
    before = layout.with_rows(narrow, along, lambda over: {"_p": over("lag(_t, 1)")}, before=1)
    order = before.agg(F.count_if(F.col("_t") < F.col("_p")).alias("out_of_order"))
    return side_by_side(repeats, order)


def check_columns(df: DataFrame, spec: SeriesSpec, essential: Sequence[str] | None = None) -> DataFrame:
    """Time column there and parseable, essential columns there; one row per check."""
    names = list(essential) if essential is not None else list(spec.signals)
    rows = [("column_present", c, "pass" if c in df.columns else "fail", int(c not in df.columns))
            for c in [spec.ts, *names]]
    if spec.ts in df.columns:
        bad = df.filter(col(spec.ts).isNotNull() & col(spec.ts).try_cast("timestamp_ntz").isNull()).count()
        rows.append(("timestamp_parses", spec.ts, "fail" if bad else "pass", bad))
    return df.sparkSession.createDataFrame(rows, CHECKS)


def numeric_like(df: DataFrame, name: str) -> Column:
    """A column as numbers, whatever it is stored as."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_number(col(name))
    return col(name).cast("double")


def raw_numbers(raw: DataFrame, spec: SeriesSpec, date: str = "Date", time: str = "Time") -> DataFrame:
    """Raw rows with a time key and numbers, one per time; the missing marker is still there."""
    timed = drop_null_timestamp(build_timestamp(raw, date, time, spec.ts), spec)
    unique = dedup_first(timed, spec)
    keep = {*spec.by, spec.ts, *spec.tiebreak}
    return unique.select(*[
        col(c) if c in keep else numeric_like(unique, c).alias(c) for c in unique.columns
    ])


def expected_from_raw(
    raw: DataFrame, spec: SeriesSpec, date: str = "Date", time: str = "Time", drop_missing_targets: bool = False
) -> DataFrame:
    """What the clean table should hold: marker to null, optionally without rows lacking all targets."""
    out = sentinel_to_null(raw_numbers(raw, spec, date, time))
    return drop_all_missing(out, spec.targets) if drop_missing_targets else out


def common_timestamps(expected: DataFrame, clean: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Keys in both tables."""
    keys = [*spec.by, spec.ts]
    return layout.match_rows(expected.select(*keys), clean.select(*keys).distinct(), keys, "inner")


def _paired(raw: DataFrame, clean: DataFrame, spec: SeriesSpec, columns: Sequence[str], targets_kept: bool):
    """Raw numbers and clean values of the same time side by side."""
    keys = [*spec.by, spec.ts]
    names = [c for c in columns if c in raw.columns and c in clean.columns]
    if targets_kept:
        marked = [F.when(numeric_like(raw, t) != SENTINEL, numeric_like(raw, t)) for t in spec.targets if t in raw.columns]
        raw = raw.filter(F.coalesce(*marked).isNotNull())
    left = raw.select(*keys, *[numeric_like(raw, c).alias(f"_r{i}") for i, c in enumerate(names)])
    right = clean.select(*keys, *[numeric_like(clean, c).alias(f"_c{i}") for i, c in enumerate(names)])
    return layout.match_rows(left, right, keys, "inner"), names


def check_sentinel(
    raw: DataFrame, clean: DataFrame, spec: SeriesSpec, columns: Sequence[str] | None = None, drop_missing_targets=False
) -> DataFrame:
    """Per column: markers in raw, and nulls in clean at these times; equal means pass."""
    both, names = _paired(raw, clean, spec, columns or spec.signals, drop_missing_targets)
    marks = [F.col(f"_r{i}") == SENTINEL for i in range(len(names))]
    row = both.agg(*[
        F.struct(
            F.count_if(m).alias("sentinels"), F.count_if(m & F.col(f"_c{i}").isNull()).alias("nulls")
        ).alias(n)
        for i, (n, m) in enumerate(zip(names, marks))
    ])
    long = unpivot_row(row, names, "column", "_v")
    return long.select(
        "column", F.col("_v.sentinels").alias("raw_sentinels"), F.col("_v.nulls").alias("clean_nulls"),
        F.when(F.col("_v.sentinels") == F.col("_v.nulls"), "pass").otherwise("fail").alias("status"),
    )


def check_drift(
    raw: DataFrame, clean: DataFrame, spec: SeriesSpec, columns: Sequence[str] | None = None,
    allow_imputation: bool = False, rtol: float = 0.0, atol: float = 1e-12, drop_missing_targets: bool = False,
) -> DataFrame:
    """Rows whose clean value differs from a valid raw value by more than ``atol + rtol*|raw|``.

    Targets always, features unless imputation is allowed. A missing clean value is no drift
    but is counted in ``lost``.
    """
    wanted = list(columns) if columns is not None else list(spec.targets if allow_imputation else spec.signals)
    both, names = _paired(raw, clean, spec, wanted, drop_missing_targets)
    cells = []
    for i, n in enumerate(names):
        r, c = F.col(f"_r{i}"), F.col(f"_c{i}")
        valid = r.isNotNull() & (r != SENTINEL)
        far = F.abs(c - r) > F.lit(atol) + F.lit(rtol) * F.abs(r)
        cells.append(F.struct(
            F.count_if(valid).alias("valid"), F.count_if(valid & far).alias("drifted"),
            F.count_if(valid & c.isNull()).alias("lost"),
        ).alias(n))
    long = unpivot_row(both.agg(*cells), names, "column", "_v")
    return long.select("column", "_v.*", F.when(F.col("_v.drifted") == 0, "pass").otherwise("fail").alias("status"))


def target_summary(clean: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Known, null, minimum and maximum per target."""
    row = clean.agg(*[
        F.struct(
            F.count(x).alias("known"), F.count_if(x.isNull()).alias("nulls"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(t)
        for t, x in ((t, numeric_like(clean, t)) for t in spec.targets)
    ])
    return unpivot_row(row, list(spec.targets), "column", "_v").select("column", "_v.*")


def validation_summary(
    raw: DataFrame, clean: DataFrame, spec: SeriesSpec, date: str = "Date", time: str = "Time",
    allow_imputation: bool = False, drop_missing_targets: bool = False, rtol: float = 0.0, atol: float = 1e-12, ordinal: str | None = None,
) -> DataFrame:
    """All checks as rows (check, column, status, count); missing columns stop the others.

    Raw and clean values of the same time are joined once, and all comparisons are counted over that join. With ``ordinal``, a column that
    tells the order of the clean rows as they were stored, rows out of time order are counted, too.
    """
    gate = check_columns(clean, spec)
    if gate.filter(F.col("status") == "fail").limit(1).count():
        return gate
    clean = clean.withColumn(spec.ts, col(spec.ts).try_cast("timestamp_ntz"))
    order = is_sorted_unique(clean, spec, ordinal).select(F.array(*[
        _count_of(check, spec.ts, F.col(c)) for check, c in (("unique_times", "repeated_times"), ("sorted", "out_of_order")) if ordinal or c != "out_of_order"
    ]).alias("_c"))
    both, names = _paired(raw_numbers(raw, spec, date, time), clean, spec, spec.signals, drop_missing_targets)
    firm = spec.targets if allow_imputation else spec.signals
    counts = [_count_of("common_times", spec.ts, F.when(F.count(F.lit(1)) > 0, F.lit(0)).otherwise(F.lit(1)))]
    for i, n in enumerate(names):
        r, c = F.col(f"_r{i}"), F.col(f"_c{i}")
        counts.append(_count_of("sentinel", n, F.count_if((r == SENTINEL) & c.isNotNull())))
        if n in firm:
            far = F.abs(c - r) > F.lit(atol) + F.lit(rtol) * F.abs(r)
            counts.append(_count_of("drift", n, F.count_if(r.isNotNull() & (r != SENTINEL) & far)))
    found = order.unionByName(both.agg(F.array(*counts).alias("_c"))).select(F.explode("_c").alias("_c")).select("_c.*")
    status = F.when(F.col("count") == 0, "pass").otherwise("fail")
    return gate.unionByName(found.select("check", "column", status.alias("status"), "count"))


def _count_of(check: str, column: str, count: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), count.cast("long").alias("count"))


def passed(summary: DataFrame) -> bool:
    return summary.filter(F.col("status") == "fail").limit(1).count() == 0


def one_sided_times(expected: DataFrame, clean: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Times found in only one of the tables, which the other checks pass over."""
    keys = [*spec.by, spec.ts]
    a, b = expected.select(*keys).distinct(), clean.select(*keys).distinct()
    only_raw = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_raw"))
    only_clean = b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_clean"))
    return side_by_side(only_raw, only_clean)
