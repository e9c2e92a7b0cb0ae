"""N-gram Jaccard join: a packed R-tree over count vectors bounds overlaps, exact set comparison decides.

A document is the set of its distinct shingles of five words. Two link when 100 * intersection >= 80 * union.

* *Cells.* Which sets can meet at all is settled exactly by their rarest shingles. The prefix of a set is its first
  n - ceil(0.8 n) + 1 shingles in an order common to all sets; it puts frequent shingles last, by a counting sketch of
  fixed size, so a passage that many documents share opens no cell unless a document consists of little else. Sets that
  link share so many prefix shingles as ``least_shared`` says; pairs in a cell are counted, and those that meet too seldom
  are dropped. In a cell of more than ``CELL_PAIRS`` sets not all pairs are made: its sets are chained by size, as far as sizes
  allow links. The components of pairs and chains are clusters, and no link leaves its cluster. Clusters partition the
  tree, since a count vector alone cannot tell where to look: the sum of minima of two unrelated texts is too
  large a part of their sizes for any split on a few coordinates to prune.
* *Tree.* Shingles are hashed into ``GROUPS`` groups; a set's point has one coordinate per group, its count. The
  points of a cluster are packed, in the order of a space-filling curve, into leaves of at most ``LEAF`` sets. A leaf
  has a bounding box; the sum of the minima of two boxes' upper corners bounds every overlap between them,
  and only pairs of leaves where it suffices are joined. In a pair of leaves, the sum of coordinate minima bounds each overlap.
* *Verification.* Surviving pairs are compared by their whole sets. Pairs that are connected already are passed over,
  so a group of near copies yields a spanning forest, not all its pairs.

Shingles and sets are compared by hashes of 64 and 128 bits. Equal sets are compared once, by one representative.

Defined results: null or empty texts, and texts without words, have 0 shingles and stay alone. Fewer than five
words make one shingle. Repeated rows are copies. Null ids are kept; they are never the smallest of a component unless all
are null. Empty tables give an empty result; columns other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import textnum
from seriesprep.llm.components import connected_components
from seriesprep.workspace import stage

PERCENT = 80
GROUPS = 64
LEAF = 256
LEAF_BYTES = 4 << 20
SKETCH_SLOTS = 1 << 20
SKETCH_BLOCK = 1 << 14
CELL_ROWS = 1 << 20  # entries of cells in a task
CELL_PAIRS = 64
LEVELS = 64  # of frequency up to the mean
FLUSH_BYTES = 4 << 20
PAIRS_HELD = 1 << 20  # pairs of a task before they are summed
ALWAYS = 1 << 40

U = np.uint64


def set_identity(own: np.ndarray) -> tuple[int, int]:
    """128 bits for a set of hashes, as two signed numbers."""
    with np.errstate(over="ignore"):
        a = textnum.mix64(own * U(0xD6E8FEB86659FD93) + U(1)).sum(dtype=U)
        b = np.bitwise_xor.reduce(textnum.mix64(own + U(0xA0761D6478BD642F))) + U(len(own))
        pair = textnum.mix64(np.array([a + b * U(3), b + a * U(5)], U)).view(np.int64)
    return int(pair[0]), int(pair[1])


def _sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sorted shingle sets of each slice of a text column."""
    for lo, _, buf, offs in textnum.slices(column):
        starts, ends, before = textnum.word_bounds(buf, offs)
        found, at = textnum.shingles(textnum.word_hashes(buf, starts, ends), before)
        yield lo, list(textnum.row_sets(found, at))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))


def digests_and_sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass: ``_id``, ``_key``, ``n``, ``hi``, ``lo`` of every row, and per task the blocks of its counting sketch."""
    rows = _rows(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(SKETCH_SLOTS, np.uint32), None
        for b in batches:
            kind = b.column(0).type
            n, hi, low = [], [], []
            for _, sets in _sets(b.column(2)):
                for s in sets:
                    n.append(len(s))
                    identity = set_identity(s)
                    hi.append(identity[0])
                    low.append(identity[1])
                every = np.concatenate(sets) if sets else np.empty(0, U)
                counts += np.bincount((every % U(SKETCH_SLOTS)).astype(np.int64), minlength=SKETCH_SLOTS).astype(np.uint32)
            m = b.num_rows
            yield pa.record_batch([
                b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(low, pa.int64()),
                pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        if kind is not None:
            blocks = range(SKETCH_SLOTS // SKETCH_BLOCK)
            m = len(blocks)
            yield pa.record_batch([
                pa.nulls(m, kind), *[pa.nulls(m, pa.int64())] * 4, pa.array(blocks, pa.int32()),
                pa.array([counts[i * SKETCH_BLOCK : (i + 1) * SKETCH_BLOCK].tobytes() for i in blocks], pa.binary())], names=names)

    names = ["_id", "_key", "n", "hi", "lo", "block", "counts"]
    return rows.mapInArrow(run, f"_id {id_type.simpleString()}, _key LONG, n LONG, hi LONG, lo LONG, block INT, counts BINARY")


def frequency_levels(sketch: DataFrame) -> np.ndarray:
    """Count of every slot of the sketch in 64ths of the mean, 255 at most. One byte per slot."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = np.frombuffer(data.as_py(), np.uint32).astype(np.int64)
                sums[block] = sums[block] + own if block in sums else own
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "counts"])

    blocks = sketch.select("block", "counts").repartition(16, "block").mapInArrow(add, "block INT, counts BINARY")
    total = np.zeros(SKETCH_SLOTS, np.int64)
    for r in blocks.collect():  # SKETCH_SLOTS numbers in all
        total[r["block"] * SKETCH_BLOCK : (r["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(r["counts"], np.int64)
    mean = max(1.0, total.mean())
    return np.minimum(total * LEVELS // mean, 255).astype(np.uint8)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1  # n - ceil(percent * n / 100) + 1


def cell_entries(docs: DataFrame, levels: np.ndarray, buckets: int, text_col: str, percent: int = PERCENT) -> DataFrame:
    """``bucket`` and packed entries (shingle, set, size) of the rarest shingles of every set, each set once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = shared.value, set()
        keys, ids, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            k = np.concatenate(keys)
            repeat = np.array([len(x) for x in keys])
            i, s = np.repeat(np.array(ids, np.int64), repeat), np.repeat(np.array(sizes, np.int32), repeat)
            where = (textnum.mix64(k) % U(buckets)).astype(np.int32)
            at = np.argsort(where, kind="stable")
            k, i, s, where = k[at], i[at], s[at], where[at]
            names, first = np.unique(where, return_index=True)
            ends = np.append(first[1:], len(where))
            parts = [[x[lo:hi].tobytes() for lo, hi in zip(first, ends, strict=True)] for x in (k, i, s)]
            return pa.record_batch([pa.array(names, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], names=["bucket", "keys", "ids", "sizes"])

        for b in batches:
            for _, sets in _sets(b.column(0)):
                for own in sets:
                    if not len(own) or (name := set_identity(own)) in seen:
                        continue
                    seen.add(name)
                    ranked = (order[(own % U(SKETCH_SLOTS)).astype(np.int64)].astype(U) << U(56)) | (own >> U(8))
                    p = prefix_length(len(own), percent)
                    keys.append(np.partition(ranked, p - 1)[:p] if p < len(own) else ranked)
                    ids.append(name[0])
                    sizes.append(len(own))
                    held += 20 * p
                if held >= FLUSH_BYTES:
                    yield flush()
                    keys, ids, sizes, held = [], [], [], 0
        if keys:
            yield flush()

    return docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "bucket INT, keys BINARY, ids BINARY, sizes BINARY")


def least_shared(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Prefix shingles that two sets of n and m shingles share at least if they link.

    If the prefix of the first ends earlier in the common order, its shingles that the other set has are all in the
    other's prefix; at most n - overlap of them are not in the other set.
    """
    overlap = -(-percent * (n + m) // (100 + percent))
    rest = 1 + overlap + np.minimum((-percent * n) // 100, (-percent * m) // 100)
    return np.maximum(rest, 1)


def _summed(met: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Pairs and how often they met, each pair once."""
    a, b, least, times = (np.concatenate(x) for x in zip(*met, strict=True))
    at = np.lexsort((b, a))
    a, b, least, times = a[at], b[at], least[at], times[at]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[first], b[first], least[first], np.add.reduceat(times, first)


def cell_pairs(entries: DataFrame, partitions: int, percent: int = PERCENT) -> DataFrame:
    """Links ``a``, ``b`` between sets that meet in cells often enough, and between neighbours in large cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[], [], []]
        for b in batches:
            for c in range(3):
                parts[c] += [np.frombuffer(x.as_py(), (np.uint64, np.int64, np.int32)[c]) for x in b.column(c + 1)]
        if not parts[0]:
            return
        keys, ids, sizes = (np.concatenate(p) for p in parts)
        parts.clear()
        at = np.argsort(keys, kind="stable")
        keys = keys[at]
        same = np.zeros(len(keys), bool)
        same[1:] = keys[1:] == keys[:-1]
        shared = same.copy()
        shared[:-1] |= same[1:]
        keys, at = keys[shared], at[shared]  # cells of one set are most of all
        ids, sizes = ids[at], sizes[at]
        at = np.lexsort((ids, sizes, keys))
        keys, ids, sizes = keys[at], ids[at], sizes[at]
        once = np.ones(len(keys), bool)
        once[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids, sizes = keys[once], ids[once], sizes[once].astype(np.int64)
        _, cell, members = np.unique(keys, return_inverse=True, return_counts=True)
        large = members[cell] > CELL_PAIRS
        met, held = [], 0
        for step in range(1, CELL_PAIRS):
            match = (keys[step:] == keys[:-step]) & (100 * sizes[:-step] >= percent * sizes[step:])
            if step > 1:
                match &= ~large[step:]
            first = np.flatnonzero(match)
            if len(first):
                met.append((ids[first], ids[first + step], least_shared(sizes[first], sizes[first + step], percent), np.where(large[first], ALWAYS, 1)))
                held += len(first)
                if held > PAIRS_HELD:
                    met = [_summed(met)]
                    held = len(met[0][0])
            elif not (keys[step:] == keys[:-step]).any():
                break
        if met:
            yield pa.record_batch([pa.array(x) for x in _summed(met)], names=["a", "b", "least", "times"])

    pairs = entries.repartition(partitions, "bucket").mapInArrow(run, "a LONG, b LONG, least LONG, times LONG")
    return pairs.groupBy("a", "b").agg(F.sum("times").alias("times"), F.min("least").alias("least")).filter("times >= least").select("a", "b")


def _curve(own: np.ndarray) -> int:
    """Position along a Z-order curve of a set's size and of four coordinates of folded counts."""
    folded = np.bincount((own % U(4)).astype(np.int64), minlength=4)
    level = int(len(own)).bit_length()
    scaled = np.minimum(255, folded * 512 // max(1, len(own)))
    code = 0
    for bit in range(7, -1, -1):
        for g in range(4):
            code = code << 1 | int(scaled[g]) >> bit & 1
    return level << 40 | code


def points(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cluster``, ``curve``, ``node`` and the packed set of each wanted document."""
    rows = _rows(docs, id_col, text_col)
    match = rows["_id"].eqNullSafe(wanted["_rep"]["_id"]) & (rows["_key"] == wanted["_rep"]["_key"])
    chosen = rows.join(wanted.hint("shuffle_hash"), match).select("cluster", "node", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in _sets(b.column(2)):
                yield pa.record_batch([
                    b.column(0).slice(lo, len(sets)), pa.array([_curve(s) for s in sets], pa.int64()), b.column(1).slice(lo, len(sets)),
                    pa.array([s.tobytes() for s in sets], pa.binary())], names=["cluster", "curve", "node", "members"])

    return chosen.mapInArrow(run, "cluster LONG, curve LONG, node LONG, members BINARY")


def count_vector(own: np.ndarray) -> np.ndarray:
    return np.bincount((own % U(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def enough(overlap: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether 100 * overlap >= percent * union for two sets of ``sizes`` in all."""
    return (100 + percent) * overlap >= percent * sizes


def join_leaves(
    left: list[np.ndarray], right: list[np.ndarray] | None, labels: np.ndarray, percent: int = PERCENT,
) -> list[tuple[int, int]]:
    """A spanning forest of the links in a leaf (``right`` is None), or between two leaves.

    ``labels`` numbers the components of left and right sets known so far; connected pairs are passed over.
    """
    both = left + (right or [])
    vectors = np.stack([count_vector(s) for s in both])
    sizes = np.array([len(s) for s in both], np.int64)
    m = len(left)
    labels = labels.copy()
    pairs = []
    for i in range(m):
        others = np.arange(i + 1, m) if right is None else np.arange(m, len(both))
        bound = np.minimum(vectors[i], vectors[others]).sum(axis=1, dtype=np.int64)
        good = enough(bound, sizes[i] + sizes[others], percent)
        pairs.append(np.stack([bound[good] * 1000 // (sizes[i] + sizes[others[good]]), np.full(good.sum(), i), others[good]], axis=1))
    pairs = np.concatenate(pairs)
    pairs = pairs[np.argsort(-pairs[:, 0], kind="stable")]  # the likeliest first
    links, at = [], 0
    while at < len(pairs):
        pairs = pairs[at:][labels[pairs[at:, 1]] != labels[pairs[at:, 2]]]
        at = 0
        for _, i, j in pairs[:2000].tolist():
            at += 1
            if labels[i] == labels[j]:
                continue
            a, b = (both[i], both[j]) if len(both[i]) <= len(both[j]) else (both[j], both[i])
            overlap = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if enough(overlap, len(a) + len(b), percent):
                links.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return links


def _unpack(members: bytes, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(np.frombuffer(members, U), np.cumsum(sizes)[:-1])


def build_leaves(packed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Leaves of the packed tree with the links inside them.

    ``leaf``, ``cluster``, ``upper`` (upper corner of the box), ``least`` (size of the smallest set), ``nodes``, ``labels``
    and ``sizes`` of the sets, ``members`` (null if the leaf is its whole cluster), ``links`` (pairs of nodes).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, cluster, nodes, sets, size = TaskContext.get().partitionId(), 0, None, [], [], 0
        first_of_cluster = alone_in_task = True

        def leaf(whole: bool) -> pa.RecordBatch:
            nonlocal count
            labels = np.arange(len(sets))
            links = join_leaves(sets, None, labels, percent)
            for i, j in links:
                labels[labels == labels[j]] = labels[i]
            count += 1
            upper = np.max([count_vector(s) for s in sets], axis=0)
            flat = [nodes[x] for pair in links for x in pair]
            return pa.record_batch([
                pa.array([part << 32 | count], pa.int64()), pa.array([cluster], pa.int64()), pa.array([upper.tolist()], pa.list_(pa.int32())),
                pa.array([min(len(s) for s in sets)], pa.int64()), pa.array([nodes], pa.list_(pa.int64())),
                pa.array([labels.tolist()], pa.list_(pa.int32())), pa.array([[len(s) for s in sets]], pa.list_(pa.int32())),
                pa.array([None if whole else np.concatenate(sets).tobytes()], pa.binary()), pa.array([flat], pa.list_(pa.int64()))],
                names=["leaf", "cluster", "upper", "least", "nodes", "labels", "sizes", "members", "links"])

        for b in batches:
            for c, node, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                own = np.frombuffer(data.as_py(), U)
                if sets and (c != cluster or len(sets) >= LEAF or size + own.nbytes > LEAF_BYTES):
                    # a cluster that began and ended within this task and has one leaf needs no joins with others
                    yield leaf(c != cluster and first_of_cluster and not alone_in_task)
                    first_of_cluster = c != cluster
                    alone_in_task = alone_in_task and c == cluster
                    nodes, sets, size = [], [], 0
                if node in nodes:
                    continue  # a repeated row
                cluster = c
                nodes.append(node)
                sets.append(own)
                size += own.nbytes
        if sets:
            yield leaf(False)

    return packed.mapInArrow(run, (
        "leaf LONG, cluster LONG, upper ARRAY<INT>, least LONG, nodes ARRAY<LONG>, labels ARRAY<INT>, sizes ARRAY<INT>, members BINARY, "
        "links ARRAY<LONG>"))


def leaf_pairs(leaves: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of leaves of a cluster between whose boxes an overlap can be large enough."""
    boxes = leaves.filter("members IS NOT NULL").select("cluster", "leaf", "upper", "least")
    other = boxes.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("leaf", "upper", "least")])
    bound = F.aggregate(F.zip_with("upper", "upper2", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    return boxes.join(other, "cluster").filter(
        (F.col("leaf") < F.col("leaf2")) & ((100 + percent) * bound >= percent * (F.col("least") + F.col("least2")))).select("leaf", "leaf2")


def cross_links(leaves: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between the sets of joined leaves, ``a`` and ``b`` nodes."""
    data = leaves.select("leaf", "nodes", "labels", "sizes", "members")
    second = data.select(*[F.col(c).alias(f"{c}2") for c in data.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1).to_pylist()[0]
                left, right = (_unpack(row[f"members{x}"], np.array(row[f"sizes{x}"])) for x in ("", "2"))
                labels = np.concatenate([np.array(row["labels"]), np.array(row["labels2"]) + len(left)])
                nodes = row["nodes"] + row["nodes2"]
                links = join_leaves(left, right, labels, percent)
                yield pa.record_batch([pa.array([nodes[i] for i, _ in links], pa.int64()), pa.array([nodes[j] for _, j in links], pa.int64())], names=["a", "b"])

    return pairs.join(data, "leaf").join(second, "leaf2").select(
        "nodes", "labels", "sizes", "members", "nodes2", "labels2", "sizes2", "members2").mapInArrow(run, "a LONG, b LONG")


def similar_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``_key`` (hash of the text), ``n_shingles`` and ``component_id`` (smallest id reachable by links) of every row."""
    spark = docs.sparkSession
    scanned = stage(digests_and_sketch(docs, id_col, text_col), "shingle-digests")
    digests = scanned.filter("block IS NULL")
    levels = frequency_levels(scanned.filter("block IS NOT NULL"))
    sets = stage(
        digests.filter("n > 0").groupBy("hi", "lo").agg(F.min(F.struct("_id", "_key")).alias("_rep"), F.min("_id").alias("first"), F.max("n").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "shingle-sets")
    total = sets.agg(F.coalesce(F.sum(F.expr(f"n - ceil({percent} * n / 100) + 1")), F.lit(0)).alias("t")).head()["t"]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // CELL_ROWS))
    links = cell_pairs(cell_entries(docs, levels, 8 * partitions, text_col, percent), partitions, percent)
    clusters = stage(connected_components(links), "clusters")
    wanted = sets.join(clusters.select(F.col("node").alias("hi"), F.col("root").alias("cluster")), "hi").select("_rep", "node", "cluster")
    packed = stage(points(docs, wanted, id_col, text_col), "points")
    leaves = stage(build_leaves(packed.repartitionByRange("cluster", "curve", "node").sortWithinPartitions("cluster", "curve", "node"), percent), "leaves")
    across = cross_links(leaves, leaf_pairs(leaves, percent), percent)
    inside = leaves.filter("size(links) > 0").select(F.explode(F.expr(
        "transform(sequence(0, size(links) div 2 - 1), i -> struct(links[2 * i] AS a, links[2 * i + 1] AS b))")).alias("l")).select("l.a", "l.b")
    found = connected_components(inside.unionByName(across))
    named = sets.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    classes = named.join(smallest, "root").select("hi", "lo", "component")
    return digests.join(classes, ["hi", "lo"], "left").select(
        F.col("_id").alias(id_col), "_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component_id"))


def drop_similar(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of similar texts, with all their columns."""
    groups = similar_groups(docs, percent, id_col, text_col)
    stay = groups.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_stay"), "_key").distinct()
    match = docs[id_col].eqNullSafe(stay["_stay"]) & (F.xxhash64(docs[text_col]) == stay["_key"])
    return docs.join(stay, match, "left_semi")
