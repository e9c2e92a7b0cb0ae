"""Spreading the time axis: row positions, blocks with a halo, and values carried across blocks.

A window ordered by time without a partition key moves a whole table into one task, and a
window per series does the same with the one series that holds most rows. Every window
operator of the package therefore goes through :func:`with_rows` (bounded reach) or
:func:`carry` / :func:`scan_blocks` (unbounded reach), which pick one of two layouts:

direct   ``partitionBy(by)``. Used when the longest series is known to be small.
blocked  Rows are range-partitioned by (series, time, tiebreak), sorted and staged once with
         a dense position ``_pos``. Blocks of ``block_rows`` positions are the window
         partitions, so neither a long series nor a crowded day decides the task size. Rows
         within reach of a block edge are copied into the neighbour block; results are
         kept only for a block's own rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesprep.functions.scalars import col, quoted
from seriesprep.spec import SeriesSpec
from seriesprep.workspace import stage

ROWS_PER_SORT_TASK = 1_000_000
LEAST_SORT_ROWS = 10_000
MAX_BLOCK_ROWS = 250_000
MIN_BLOCK_ROWS = 1024
MAX_COLLECTED_PARTS = 200_000
BLOCKS_PER_SPAN = 1024
POS, BLOCK, SPAN, STATE = "_pos", "_block", "_span", "_state"
_SHIFT = 33  # monotonically_increasing_id keeps the partition number above bit 33


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def order_keys(spec: SeriesSpec) -> list[str]:
    return [spec.ts, *spec.tiebreak]


def series_window(spec: SeriesSpec) -> WindowSpec:
    return Window.partitionBy(*spec.by).orderBy(*order_keys(spec))


def longest_series(df: DataFrame, spec: SeriesSpec) -> tuple[int, int]:
    """(rows of the longest series, rows in all), from one aggregate over the key columns."""
    if not spec.by:
        n = df.count()
        return n, n
    row = df.groupBy(*spec.by).count().agg(F.max("count"), F.sum("count")).first()
    return int(row[0] or 0), int(row[1] or 0)


def place(df: DataFrame, spec: SeriesSpec, reach: int = 0) -> tuple[DataFrame, SeriesSpec]:
    """Settle the layout. Call it once and pass the result on to share one sort among operators."""
    if spec.layout in ("direct", "indexed"):
        return df, spec
    if spec.layout == "blocked":
        total = df.count()
    else:
        longest, total = longest_series(df, spec)
        if longest <= spec.max_direct_rows:
            return df, spec.using(layout="direct")
    block = spec.block_rows or min(
        MAX_BLOCK_ROWS, max(MIN_BLOCK_ROWS, math.ceil(total / (4 * _partitions(df))))
    )
    block = max(block, reach, 1)
    return number_rows(df, spec, total), spec.using(layout="indexed", block_rows=block, rows=total)


def number_rows(df: DataFrame, spec: SeriesSpec, total: int) -> DataFrame:
    """Stage ``df`` sorted by (by, ts, tiebreak) with a dense 0-based position ``_pos``.

    The range partitioner samples the keys, so a hot series or a hot day is cut into many
    tasks. Rows equal in all keys are ordered by a hash of the whole row, which keeps a
    recomputed task identical.
    """
    parts = max(
        math.ceil(total / ROWS_PER_SORT_TASK),
        min(_partitions(df), math.ceil(total / LEAST_SORT_ROWS)),
        1,
    )
    keys = [F.col(c) for c in (*spec.by, *order_keys(spec))]
    keys.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ordered = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    staged = stage(ordered, "series")
    part = F.shiftright("_mid", _SHIFT)
    counts = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per sort task
    if parts <= MAX_COLLECTED_PARTS:
        sizes = dict(sorted(tuple(r) for r in counts.collect()))
        ends = list(accumulate(sizes.values(), initial=0))
        starts = F.broadcast(df.sparkSession.createDataFrame(
            list(zip(sizes, ends)), "_part long, _start long"))
    else:
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    low_bits = F.col("_mid").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return (
        staged.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(POS, F.col("_start") + low_bits)
        .drop("_part", "_mid", "_start")
    )


def home_block(spec: SeriesSpec) -> Column:
    return F.expr(f"{POS} div {int(spec.block_rows)}")


def halo_blocks(df: DataFrame, spec: SeriesSpec, before: int, after: int) -> DataFrame:
    """Add ``_block``; rows within ``before``/``after`` positions of an edge appear in both blocks."""
    home = home_block(spec)
    if not before and not after:
        return df.withColumn(BLOCK, home)
    size = spec.block_rows
    if max(before, after) > size:
        raise ValueError(f"reach {max(before, after)} exceeds the block of {size} rows")
    offset = F.col(POS) % F.lit(size)
    copies = F.array_compact(F.array(
        home,
        F.when(offset >= size - before, home + 1),
        F.when((offset < after) & (home > 0), home - 1),
    ))
    return df.withColumn(BLOCK, F.explode(copies))


def block_window(spec: SeriesSpec) -> WindowSpec:
    return Window.partitionBy(BLOCK, *spec.by).orderBy(POS)


def _finish(df: DataFrame, asked: SeriesSpec) -> DataFrame:
    return df.drop(BLOCK) if asked.layout == "indexed" else df.drop(BLOCK, POS)


class Over:
    """Spells window expressions over one series, or one block of it, as SQL text.

    A feature table has hundreds of window expressions; as text each is one call into the
    JVM instead of half a dozen.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str]):
        part = f"PARTITION BY {', '.join(map(quoted, keys))} " if keys else ""
        self.window = f"{part}ORDER BY {', '.join(map(quoted, order))}"

    def text(self, call: str, first: int | None = None, last: int | None = None) -> str:
        """``call`` over the rows ``first`` .. ``last`` relative to the current one (or no frame)."""
        if first is None:
            return f"{call} OVER ({self.window})"
        return f"{call} OVER ({self.window} ROWS BETWEEN {_bound(first)} AND {_bound(last)})"

    def __call__(self, call: str, first: int | None = None, last: int | None = None) -> Column:
        return F.expr(self.text(call, first, last))


def _bound(offset: int) -> str:
    if offset == 0:
        return "CURRENT ROW"
    return f"{-offset} PRECEDING" if offset < 0 else f"{offset} FOLLOWING"


def with_rows(
    df: DataFrame,
    spec: SeriesSpec,
    build: Callable[[Over], dict[str, Column]],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``build`` spells the new columns over the ordered window of one series (or of one block
    of it). All of them share one shuffle and one sort.
    """
    placed, how = place(df, spec, max(before, after))
    if how.layout == "direct":
        return placed.withColumns(build(Over(how.by, order_keys(how))))
    blocks = halo_blocks(placed, how, before, after)
    blocks = blocks.withColumns(build(Over([BLOCK, *how.by], [POS])))
    if before or after:
        blocks = blocks.filter(F.col(BLOCK) == home_block(how))
    return _finish(blocks, spec)


def match_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on the keys where null keys match, too; the result has the left one's keys."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    on = [col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    return left.join(right, on, how).drop(*names.values())


def join_carry(blocks: DataFrame, table: DataFrame, spec: SeriesSpec, names: Sequence[str]) -> DataFrame:
    """Give the rows of each block what its series brings along from other blocks.

    Series lie one after the other, so at most one of a block's series comes in from outside:
    ``table`` has at most one row per block. Joining on the block alone leaves the rows
    partitioned the way the block windows need them, and rows of other series get nulls.
    """
    renamed = {k: f"_k{i}" for i, k in enumerate(spec.by)}
    joined = blocks.join(table.withColumnsRenamed(renamed), BLOCK, "left")
    same = F.lit(True)
    for k, r in renamed.items():
        same = same & col(k).eqNullSafe(F.col(r))
    return joined.withColumns({n: F.when(same, F.col(n)) for n in names}).drop(*renamed.values())


def block_carry(
    blocks: DataFrame,
    spec: SeriesSpec,
    summaries: dict[str, Column],
    merge: Callable[[str, WindowSpec], Column],
    backwards: bool = False,
) -> DataFrame:
    """Join to each row what the earlier (or later) blocks of its series leave behind.

    ``summaries`` aggregates each (block, series); ``merge`` combines them over the blocks
    before the row's own. The table of summaries has one row per block and series.
    """
    table = blocks.groupBy(BLOCK, *spec.by).agg(*[c.alias(n) for n, c in summaries.items()]).withColumn(
        SPAN, F.expr(f"{BLOCK} div {BLOCKS_PER_SPAN}"))

    def order(name: str) -> Column:
        return F.col(name).desc() if backwards else F.col(name).asc()

    # in two levels: spans of blocks first, so that no task holds the summaries of a whole series
    inside = Window.partitionBy(SPAN, *spec.by)
    whole = inside.orderBy(order(BLOCK)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = table.select(SPAN, *spec.by, *[merge(n, whole).alias(n) for n in summaries], F.row_number().over(
        inside.orderBy(order(BLOCK))).alias("_nth")).filter("_nth = 1").drop("_nth")
    earlier = Window.partitionBy(*spec.by).orderBy(order(SPAN)).rowsBetween(Window.unboundedPreceding, -1)
    past = spans.select(SPAN, *spec.by, *[merge(n, earlier).alias(n) for n in summaries], F.count(F.lit(1)).over(earlier).alias("_before")).filter(
        "_before > 0").drop("_before")
    # what stands before a span counts as a block ahead of its first one
    both = table.withColumn("_own", F.lit(1)).unionByName(past.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    before = inside.orderBy("_own", order(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    table = both.select(
        BLOCK, *spec.by, *[merge(n, before).alias(n) for n in summaries], F.count(F.lit(1)).over(before).alias("_before"), "_own",
    ).filter("_own = 1 AND _before > 0").drop("_before", "_own")
    return join_carry(blocks, table, spec, list(summaries))


def number_of_blocks(df: DataFrame, spec: SeriesSpec) -> int:
    rows = spec.rows if spec.rows is not None else (df.agg(F.max(POS)).first()[0] or 0) + 1
    return rows // spec.block_rows + 1


def chain_blocks(
    table: DataFrame, by: Sequence[str], total: Callable[[pa.Table], pa.Table], advance: Callable[[pa.Table, bytes | None], list[bytes | None]],
    blocks: int, backwards: bool = False,
) -> DataFrame:
    """``_block``, the keys and ``_state``: what each block of ``table``, one row per block and series, takes over from those before it.

    Blocks that take over nothing are left out.

    A scan with summaries that merge: ``total`` merges the ordered rows of one series into one row of the same columns, and
    ``advance`` gives the state that comes into each row, given the one that comes into the first. No group has more than
    ``BLOCKS_PER_SPAN`` rows: longer series are merged by spans of blocks, these are chained in the same way, and so on.
    """
    fields = [table.schema[BLOCK], *[table.schema[k] for k in by]]
    order = [(BLOCK, "descending" if backwards else "ascending")]

    def incoming(rows: pa.Table, start: bytes | None = None) -> pa.Table:
        rows = rows.sort_by(order)
        return rows.select([f.name for f in fields]).append_column(STATE, pa.array(advance(rows, start), pa.binary()))

    schema = T.StructType([*fields, T.StructField(STATE, T.BinaryType())])
    if blocks <= BLOCKS_PER_SPAN:
        return table.groupBy(*by).applyInArrow(lambda rows: incoming(rows), schema).filter(F.col(STATE).isNotNull())
    spanned = table.withColumn(SPAN, F.expr(f"{BLOCK} div {BLOCKS_PER_SPAN}"))

    def merged(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        one = total(rows.drop_columns([SPAN]))
        return one.set_column(one.schema.get_field_index(BLOCK), BLOCK, rows.column(SPAN)[:1].cast(pa.int64()))

    ends = spanned.groupBy(SPAN, *by).applyInArrow(merged, table.schema)
    before = chain_blocks(ends, by, total, advance, math.ceil(blocks / BLOCKS_PER_SPAN), backwards)
    joined = match_rows(spanned, before.withColumnRenamed(BLOCK, SPAN), [SPAN, *by])

    def within(rows: pa.Table) -> pa.Table:
        return incoming(rows.drop_columns([SPAN, STATE]), rows.column(STATE)[0].as_py())

    return joined.groupBy(SPAN, *by).applyInArrow(within, schema).filter(F.col(STATE).isNotNull())


def _from_start(w: WindowSpec, keys: list[str], backwards: bool) -> WindowSpec:
    order = [F.col(k).desc() if backwards else F.col(k).asc() for k in keys]
    return w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def carry(
    df: DataFrame, spec: SeriesSpec, values: dict[str, Column], backwards: bool = False
) -> DataFrame:
    """Add, per name, the last non-null value up to and including the row (or the next one).

    Looking ahead is looking back in reversed order: a frame that ends with the series would
    be evaluated anew for every row.
    """
    placed, how = place(df, spec)
    if how.layout == "direct":
        w = _from_start(Window.partitionBy(*how.by), order_keys(how), backwards)
        return placed.withColumns({n: F.last(c, ignorenulls=True).over(w) for n, c in values.items()})
    blocks = halo_blocks(placed, how, 0, 0)
    edge = F.min_by if backwards else F.max_by
    summaries = {
        f"_c{i}": edge(c, F.when(c.isNotNull(), F.col(POS))) for i, c in enumerate(values.values())
    }
    joined = block_carry(
        blocks, how, summaries, lambda n, w: F.last(n, ignorenulls=True).over(w), backwards
    )
    w = _from_start(Window.partitionBy(BLOCK, *how.by), [POS], backwards)
    out = joined.withColumns({
        n: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_c{i}"))
        for i, (n, c) in enumerate(values.items())
    })
    return _finish(out.drop(*summaries), spec)


def running_sums(df: DataFrame, spec: SeriesSpec, values: dict[str, Column]) -> DataFrame:
    """Add, per name, the sum of the non-null values from the series start through the row."""
    placed, how = place(df, spec)
    frame = (Window.unboundedPreceding, 0)
    if how.layout == "direct":
        w = series_window(how).rowsBetween(*frame)
        return placed.withColumns({n: F.sum(c).over(w) for n, c in values.items()})
    blocks = halo_blocks(placed, how, 0, 0)
    summaries = {f"_c{i}": F.sum(c) for i, c in enumerate(values.values())}
    joined = block_carry(blocks, how, summaries, lambda n, w: F.sum(n).over(w))
    w = block_window(how).rowsBetween(*frame)
    out = joined.withColumns({
        n: F.coalesce(F.sum(c).over(w) + F.col(f"_c{i}"), F.sum(c).over(w), F.col(f"_c{i}"))
        for i, (n, c) in enumerate(values.items())
    })
    return _finish(out.drop(*summaries), spec)


def row_index(df: DataFrame, spec: SeriesSpec, name: str = "rn") -> DataFrame:
    """Dense 1-based row number in time order within each series."""
    placed, how = place(df, spec)
    if how.layout == "direct":
        return placed.withColumn(name, F.row_number().over(series_window(how)).cast("long"))
    if not how.by:
        return _finish(placed.withColumn(name, F.col(POS) + 1), spec)
    blocks = halo_blocks(placed, how, 0, 0)
    joined = block_carry(blocks, how, {"_first": F.min(POS)}, lambda n, w: F.min(n).over(w))
    start = F.coalesce(F.col("_first"), F.min(POS).over(Window.partitionBy(BLOCK, *how.by)))
    return _finish(joined.withColumn(name, F.col(POS) - start + 1).drop("_first"), spec)
