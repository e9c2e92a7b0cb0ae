"""Scalar column expressions: calendar fields, cyclical encodings, bins, text to number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that counts as a plain number; anything else becomes null rather than a Java literal.
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def finite(name: str) -> str:
    """SQL of a column with infinite values as null, as rolling and weighted statistics take them."""
    x = quoted(name)
    return f"CASE WHEN abs({x}) < double('infinity') THEN {x} END"


def col(name: str) -> Column:
    """A column by its exact name, dots and parentheses included.

    Spelled as an expression: that is one call into the JVM, which counts for tables with
    hundreds of columns.
    """
    return F.expr(quoted(name))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts).cast("int")


def month_of_year(ts: Column) -> Column:
    return F.month(ts).cast("int")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def _turn(position: Column, period: int) -> Column:
    return F.lit(2.0) * F.pi() * position / F.lit(period)


def cyclical(ts: Column) -> dict[str, Column]:
    """Sine and cosine of hour, day of week and month, each on a full circle."""
    angles = {
        "hour": _turn(F.hour(ts), 24),
        "dow": _turn(F.weekday(ts), 7),
        "month": _turn(F.month(ts) - 1, 12),
    }
    out: dict[str, Column] = {}
    for name, angle in angles.items():
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def calendar(ts: Column, dow: str = "dow") -> dict[str, Column]:
    return {"hour": hour_of_day(ts), dow: day_of_week(ts), "month": month_of_year(ts)}


def with_calendar(df: DataFrame, ts: str, dow: str = "weekday", overwrite: bool = True) -> DataFrame:
    """Add hour, day of week and month; ``overwrite=False`` keeps columns that are there."""
    fields = calendar(col(ts), dow)
    if not overwrite:
        fields = {n: c for n, c in fields.items() if n not in df.columns}
    return df.withColumns(fields) if fields else df


def interactions(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add products of column pairs; a null factor gives null."""
    missing = sorted({c for pair in pairs.values() for c in pair} - set(df.columns))
    if missing:
        raise ValueError(f"columns missing for interactions: {missing}")
    return df.withColumns({n: col(a) * col(b) for n, (a, b) in pairs.items()})


def bin_left_closed(c: Column, edges: Sequence[float]) -> Column:
    """Class 0 below the first edge; a value equal to an edge belongs to the class above."""
    out = F.when(c < F.lit(float(edges[0])), F.lit(0))
    for i, edge in enumerate(edges[1:], start=1):
        out = out.when(c < F.lit(float(edge)), F.lit(i))
    return out.when(c.isNotNull(), F.lit(len(edges))).cast("int")


def bin_right_closed(c: Column, edges: Sequence[float]) -> Column:
    """Class 0 up to and including the first edge; a value equal to an edge stays below it."""
    out = F.when(c <= F.lit(float(edges[0])), F.lit(0))
    for i, edge in enumerate(edges[1:], start=1):
        out = out.when(c <= F.lit(float(edge)), F.lit(i))
    return out.when(c.isNotNull(), F.lit(len(edges))).cast("int")


def class_name(c: Column, names: Sequence[str] = ("low", "mid", "high")) -> Column:
    """The name of a class index."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), c + 1)


def row_max(columns: Sequence[str]) -> Column:
    """Largest of several columns in the row, nulls ignored."""
    cols = [col(c) for c in columns]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def to_number(c: Column) -> Column:
    """Trim, decimal comma to point, parse; text that is no number and NaN become null."""
    text = F.regexp_replace(F.trim(c), ",", ".")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def clip_at_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0))


def is_finite(c: Column) -> Column:
    """True for a value that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def argmax(scores: Sequence[str]) -> Column:
    """Index of the largest score, the first one on ties."""
    values = F.array(*[col(s) for s in scores])
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
