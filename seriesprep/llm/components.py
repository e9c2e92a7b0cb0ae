"""Connected components of a link table by local forests and alternating star rounds; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage

TASK_ROWS = 200_000


def forest(pairs) -> list[tuple[int, int]]:
    """(node, root) of every node but the roots, for links given as pairs; a root is its tree's smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(x, root(x)) for x in parent]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task shrunk to a forest."""
    stars = forest(pair for b in batches for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    yield pa.record_batch([pa.array([s[0] for s in stars], pa.int64()), pa.array([s[1] for s in stars], pa.int64())], names=["a", "b"])


def _star_round(current: DataFrame) -> DataFrame:
    """Link larger neighbours, then smaller ones, to the smallest neighbour (large star, small star)."""
    both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame, task_rows: int = TASK_ROWS, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node in ``links`` (``a``, ``b`` LONG).

    Each round shrinks the links of every task, ``task_rows`` of them on average, to a forest, and then links neighbours
    across tasks. It ends when nothing changes, or when one task has seen all links that are left. The number of rounds
    grows with the logarithm of the longest path.
    """
    current, before = stage(links.select("a", "b"), "links"), None
    for _ in range(most_rounds):
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).head()
        if now == before:
            break
        before, tasks = now, max(1, -(-now["n"] // task_rows))
        current = stage(current.coalesce(tasks).mapInArrow(_local, "a LONG, b LONG"), "links")
        if tasks == 1:
            break
        current = stage(_star_round(current), "links")
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    stars = current.filter("a <> b").select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
