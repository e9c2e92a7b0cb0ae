"""The hourly multi-signal table: an event log summed up by hour, one column per signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col
from seriesprep.spec import SeriesSpec

KINDS = ("click", "error", "purchase", "signup", "view")

# One row per hour, but on blocks like any series: no operator puts the whole time axis into one task.
HOURLY = SeriesSpec(
    ts="ts",
    targets=("click", "error", "purchase"),
    features=("signup", "view", "volume", "peak"),
    layout="blocked",
)

# The log itself as one long series, of any length.
EVENTS = SeriesSpec(ts="ts", tiebreak=("event_id",), targets=("value",), layout="blocked")


def hourly_table(
    events: DataFrame, kinds: Sequence[str] = KINDS, by: Sequence[str] = ()
) -> DataFrame:
    """Mean value per hour and event kind (null where an hour has none), event count and peak.

    One hash aggregate with partial sums per task; the fixed kinds spare the pivot its
    distinct pass. Values have two decimals and are summed as integers, so a mean does not
    depend on the order in which tasks finish.
    """
    def of(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value"))

    cells = [F.try_divide(
        F.sum(F.round(of(k) * 100.0).cast("long")).cast("double"), F.count(of(k))
    ).alias(k) for k in kinds]
    out = events.groupBy(*by, F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("ts")).agg(
        *cells,
        F.count(F.lit(1)).cast("double").alias("volume"),
        F.max("value").alias("peak"),
    )
    return out.withColumns({k: col(k) / F.lit(100.0) for k in kinds})


def read_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_table(spark.read.parquet(f"{folder}/events.parquet"))


def raw_text_table(hourly: DataFrame, signals: Sequence[str]) -> DataFrame:
    """The hourly table as raw text: split date and time, decimal commas, -200 for missing."""
    def text(name: str) -> Column:
        hundredths = F.floor(col(name) * 100.0 + 0.5).cast("long")
        whole = F.floor(hundredths / 100).cast("long").cast("string")
        part = F.lpad((hundredths % 100).cast("string"), 2, "0")
        return F.coalesce(F.concat(whole, F.lit(","), part), F.lit("-200"))

    return hourly.select(
        F.date_format("ts", "dd/MM/yyyy").alias("Date"),
        F.date_format("ts", "HH.mm.ss").alias("Time"),
        *[text(n).alias(n) for n in signals],
    )
