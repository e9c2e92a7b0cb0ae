"""Removal of repeated passages: a logarithmic family of sampled suffix arrays finds every string of ``WIDTH`` bytes that
also starts in a document with a smaller id.

* *Sampling.* Of the k-grams in a window of ``WIDTH`` bytes the one with the smallest hash is the window's anchor, so
  equal windows have equal anchors. Consecutive windows with one anchor form a segment; a text has about one
  segment per 14 bytes. A segment is the suffix at its anchor, cut off where its windows end.
* *Index family.* Segments are dealt by their anchor's hash. A task takes them in batches by ascending id. Each batch is
  sorted into an array, merge-scanned against the levels there are for equal segments and equal anchors, and becomes a
  level itself; levels of equal size merge, so there are about log2(batches) of them and each entry is merged as often.
* *Matches.* A segment equal to one of a smaller id is repeated as a whole. Segments that share an anchor with a different
  segment may share some windows only: those are compared window by window, in a second round.

A map task settles what it can and sends one entry per anchor, or window, and ``FLUSH_BYTES`` of text, so a passage in a third
of all documents does not end in one task. Entries travel as packed arrays. All comparisons are by hash: 32 bits of
anchor within a bucket and 64 of segment, 64 bits of a window.

Defined results: null and empty texts have no bytes. Documents with a null id neither lose nor cause to lose bytes. Rows
with one id are one document: they take nothing from each other. Empty tables give an empty result; columns
other than id and text play no part.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.llm import textnum
from seriesprep.workspace import stage

WIDTH = 50
GRAM = 24
FLUSH_BYTES = 2 << 20
BATCH = 1 << 17
MIXED = 128  # set in the number of windows of an entry that stands for several segments of its anchor
TASK_BYTES = 12 << 20  # text whose entries go to one task
HOME_BYTES = 4 << 20  # text of a group of documents

U = np.uint64
ENTRY = np.dtype([("key", "<u4"), ("value", "<u8"), ("doc", "<u2"), ("at", "<u4"), ("n", "u1")])
WINDOW = np.dtype([("key", "<u4"), ("value", "<u4"), ("doc", "<u2"), ("at", "<u4"), ("n", "u1")])
DOC = np.dtype([("id", "<i8"), ("mark", "<i4")])
# windows found in a document: the first, their number, and whether they are only to be compared
SPAN = np.dtype([("id", "<i8"), ("mark", "<i4"), ("at", "<u4"), ("n", "u1"), ("part", "?")])
PACKED = "bucket INT, docs BINARY, entries BINARY, home INT, spans BINARY"
RESULT = "home INT, spans BINARY"


def _minima(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    n, size, out = len(x) - width + 1, 1, x
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:n], out[width - size : width - size + n])


def segments(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor hash, and segment hash of all segments of a slice of texts."""
    none = np.empty(0, np.int64)
    if len(buf) < WIDTH:
        return none, none, none, none.view(U), none.view(U)
    values = textnum.BYTE_VALUE[buf]
    grams = textnum.mix64(textnum.window_hashes(values, GRAM))
    bits = U(max(24, len(buf).bit_length()))
    ranked = (grams >> bits << bits) | np.arange(len(grams), dtype=U)  # of equal hashes the leftmost
    anchor = (_minima(ranked, WIDTH - GRAM + 1) & ((U(1) << bits) - U(1))).astype(np.int64)
    fits = np.ones(len(anchor), bool)
    for end in offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(buf))].tolist():  # windows stay within a text
        fits[max(0, end - WIDTH + 1) : end] = False
    first = fits.copy()
    first[1:] &= ~fits[:-1] | (anchor[1:] != anchor[:-1])
    last = fits.copy()
    last[:-1] &= ~fits[1:] | (anchor[1:] != anchor[:-1])
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buf) + 1, U)
        np.cumsum(values * textnum._powers(textnum.BASE, len(buf)), out=sums[1:])
        whole = textnum.mix64((sums[hi + WIDTH] - sums[lo]) * textnum._powers(textnum._INVERSE, len(buf))[lo] + (hi - lo).astype(U))
    return np.searchsorted(offs, lo, "right") - 1, lo, hi - lo + 1, grams[anchor[lo]], whole


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before in any key."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _spread(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value at the first row of each group, for all rows."""
    return values[first][np.cumsum(first) - 1]


def _several(first: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each group of sorted rows, whether it has more than one id."""
    starts = np.flatnonzero(first)
    return np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts) if len(starts) else np.empty(0, bool)


def _spans(ids: np.ndarray, marks: np.ndarray, at: np.ndarray, n: np.ndarray, part: bool) -> np.ndarray:
    out = np.empty(len(ids), SPAN)
    out["id"], out["mark"], out["at"], out["n"], out["part"] = ids, marks, at, n, part
    return out


def _by_home(spans: np.ndarray, homes: int) -> list[tuple[int, bytes]]:
    """Spans by the group of documents that they belong to."""
    if not len(spans):
        return []
    home = spans["id"] % homes
    order = np.argsort(home, kind="stable")
    spans, home = spans[order], home[order]
    names, starts = np.unique(home, return_index=True)
    return [(int(h), part.tobytes()) for h, part in zip(names, np.split(spans, starts[1:]), strict=True)]


def _packed(
    bucket: np.ndarray, key: np.ndarray, value: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray, ids: np.ndarray, marks: np.ndarray,
    spans: np.ndarray, homes: int, buckets: int, kind: np.dtype = ENTRY,
) -> pa.RecordBatch:
    """Entries as one row per bucket, with the documents they come from (``row`` in ``ids`` and ``marks``).

    Spans that are settled already travel along, dealt to any bucket.
    """
    order = np.argsort(bucket, kind="stable")
    bucket, key, value, row, at, n = (x[order] for x in (bucket, key, value, row, at, n))
    names, starts = np.unique(bucket, return_index=True)
    rows = []
    for b, lo, hi in zip(names.tolist(), starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
        for at_ in range(lo, hi, 1 << 16):  # so that numbers of documents fit
            own = slice(at_, min(hi, at_ + (1 << 16)))
            used, where = np.unique(row[own], return_inverse=True)
            docs, out = np.empty(len(used), DOC), np.empty(len(where), kind)
            docs["id"], docs["mark"] = ids[used], marks[used]
            out["key"], out["value"], out["doc"], out["at"], out["n"] = key[own], value[own], where, at[own], n[own]
            rows.append((b, docs.tobytes(), out.tobytes(), None, None))
    rows += [(h % buckets, None, None, h, data) for h, data in _by_home(spans, homes)]
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["bucket", "docs", "entries", "home", "spans"])


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of rounds whose results are written; Spark drops them when the driver collects garbage."""
    for _ in range(2):  # first the handles of Python go, then what they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, a mark of the text, and text of the documents that have an id."""
    return docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.hash(text_col).alias("_mark"), F.col(text_col).cast("string").alias("_text"))


def segment_entries(rows: DataFrame, buckets: int, homes: int) -> DataFrame:
    """First round, map side: entries by anchor, and what is settled within ``FLUSH_BYTES`` of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every_id, every_mark = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int32)
            for lo, _, buf, offs in textnum.slices(b.column(2), FLUSH_BYTES):
                row, at, n, anchor, whole = segments(buf, offs)
                if not len(row):
                    continue
                own_ids, own_marks = every_id[lo:], every_mark[lo:]
                order = np.lexsort((own_ids[row], whole, anchor))
                row, at, n, anchor, whole = (x[order] for x in (row, at - offs[row], n, anchor, whole))
                ids = own_ids[row]
                new_anchor, new_whole = _first_of(anchor), _first_of(anchor, whole)
                repeated = ids > _spread(new_whole, ids)
                group = np.cumsum(new_anchor) - 1
                # several segments, and of several documents: an anchor that one document repeats is not compared with itself
                mixed = ((np.bincount(group, new_whole) > 1) & _several(new_anchor, ids))[group]
                some = mixed & ~repeated
                spans = np.concatenate([_spans(ids[x], own_marks[row[x]], at[x], n[x], part) for x, part in ((repeated, False), (some, True))])
                sent = np.where(mixed, new_anchor, ~repeated)
                anchor, whole, row, at, n = (x[sent] for x in (anchor, whole, row, at, np.where(mixed, n | MIXED, n)))
                yield _packed(
                    (anchor % U(buckets)).astype(np.int32), (anchor >> U(32)).astype(np.uint32), whole, row, at, n,
                    own_ids, own_marks, spans, homes, buckets)

    return rows.mapInArrow(run, PACKED)


class IndexFamily:
    """Sorted arrays of (anchor, segment) pairs; levels of equal size merge."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # batches, anchors, segments, entry numbers

    def scan(self, anchor: np.ndarray, value: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Whether each pair of a sorted batch is in a level; marks the entries, here and there, whose anchor meets other pairs."""
        known = np.zeros(len(anchor), bool)
        for _, anchors, values, entries in self.levels:
            lo, hi = np.searchsorted(anchors, anchor), np.searchsorted(anchors, anchor, "right")
            meets = np.flatnonzero(hi > lo)
            if not len(meets):
                continue
            # a pair's place in the level: where its anchor begins, and its value's rank
            names, rank = np.unique(values, return_inverse=True)
            own_rank = np.minimum(np.searchsorted(names, value[meets]), len(names) - 1)
            start = np.flatnonzero(_first_of(anchors))[np.cumsum(_first_of(anchors)) - 1]
            pairs, own = start << 32 | rank, lo[meets] << 32 | own_rank
            same = (pairs[np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)] == own) & (names[own_rank] == value[meets])
            known[meets[same]] = True
            other = meets[~same | (hi[meets] - lo[meets] > 1)]
            touched = np.zeros(len(anchors) + 1, np.int64)
            np.add.at(touched, lo[other], 1)
            np.add.at(touched, hi[other], -1)
            mixed[entries[np.cumsum(touched[:-1]) > 0]] = True
            self.meeting[meets[~same]] = True
        return known

    def add(self, anchor: np.ndarray, value: np.ndarray, entry: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Take a batch, sorted by anchor and value; returns which of its pairs are in the family already."""
        self.meeting = np.zeros(len(anchor), bool)
        known = self.scan(anchor, value, mixed)
        mixed[entry[self.meeting]] = True
        new = ~known
        level = (1, anchor[new], value[new], entry[new])
        while self.levels and self.levels[-1][0] == level[0]:
            size, anchors, values, entries = self.levels.pop()
            anchors, values, entries = (np.concatenate(x) for x in ((anchors, level[1]), (values, level[2]), (entries, level[3])))
            order = np.lexsort((values, anchors))
            level = (2 * size, anchors[order], values[order], entries[order])
        self.levels.append(level)
        return known


def _unpack(batches: Iterator[pa.RecordBatch], kind: np.dtype = ENTRY) -> tuple[tuple[np.ndarray, ...] | None, np.ndarray]:
    """Bucket and anchor as one number, value, id, mark, window, number of windows of all entries of a task; settled spans."""
    parts, settled = [], [np.empty(0, SPAN)]
    for b in batches:
        for bucket, docs, data, spans in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(4), strict=True):
            if spans.is_valid:
                settled.append(np.frombuffer(spans.as_py(), SPAN))
            else:
                own = np.frombuffer(data.as_py(), kind)
                docs = np.frombuffer(docs.as_py(), DOC)[own["doc"]]
                parts.append((own["key"].astype(U) | U(bucket) << U(32), own["value"], docs["id"], docs["mark"], own["at"], own["n"]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else None, np.concatenate(settled)


def _result(spans: np.ndarray, homes: int) -> pa.RecordBatch:
    rows = _by_home(spans, homes)
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["home", "spans"])


def match_segments(entries: DataFrame, partitions: int, homes: int) -> DataFrame:
    """First round, reduce side: whole repeated segments (``whole``), and those to be compared by window (``part``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, spans = _unpack(batches)
        if got is not None:
            order = np.argsort(got[2], kind="stable")  # batches by ascending id
            anchor, value, ids, marks, at, n = (x[order] for x in got)
            got = None
            mixed, repeated, family = np.zeros(len(ids), bool), np.zeros(len(ids), bool), IndexFamily()
            lo = 0
            while lo < len(ids):
                hi = min(len(ids), lo + BATCH)
                while hi < len(ids) and ids[hi] == ids[hi - 1]:  # a document is not cut
                    hi += 1
                own = lo + np.lexsort((ids[lo:hi], value[lo:hi], anchor[lo:hi]))
                new_anchor, new_pair = _first_of(anchor[own]), _first_of(anchor[own], value[own])
                repeated[own] = ids[own] > _spread(new_pair, ids[own])
                group = np.cumsum(new_anchor) - 1
                mixed[own] |= (np.bincount(group, new_pair) > 1)[group]
                pair = own[new_pair]
                known = family.add(anchor[pair], value[pair], pair, mixed)
                of_pair = np.cumsum(new_pair) - 1
                repeated[own] |= known[of_pair]
                mixed[own] |= mixed[pair][of_pair]
                lo = hi
            # an anchor of several segments in some map task is compared by window everywhere
            order = np.lexsort((ids, value, anchor))
            group = np.cumsum(_first_of(anchor[order])) - 1
            mixed[order] |= (np.bincount(group, n[order] & MIXED) > 0)[group]
            mixed[order] &= _several(_first_of(anchor[order]), ids[order])[group] | (np.bincount(group, n[order] & MIXED) > 0)[group]
            n = n & (MIXED - 1)
            # entries of one pair and document stand and fall together
            first = _first_of(anchor[order], value[order], ids[order])
            group = np.cumsum(first) - 1
            mixed[order] = (np.bincount(group, mixed[order]) > 0)[group]
            some = mixed & ~repeated
            spans = np.concatenate([spans, *[_spans(ids[x], marks[x], at[x], n[x], part) for x, part in ((repeated, False), (some, True))]])
        yield _result(spans, homes)

    return entries.repartition(partitions, "bucket").mapInArrow(run, RESULT)


def _grouped_texts(docs: DataFrame, spans: DataFrame, homes: int):
    """Texts and spans side by side, by home; ``docs`` has ``_id`` among others."""
    home = F.pmod(F.coalesce(F.col("_id"), F.col("_mark").cast("long")), F.lit(homes)).cast("int").alias("home")
    return docs.select(home, "*").groupBy("home").cogroup(spans.groupBy("home"))


def _spans_of(table: pa.Table, part: bool) -> np.ndarray:
    """The spans in a table that are, or are not, to be compared only, by id, mark and place."""
    parts = [np.frombuffer(x.as_py(), SPAN) for x in table["spans"]]
    spans = np.concatenate([np.empty(0, SPAN), *parts])
    spans = spans[spans["part"] == part]
    return spans[np.lexsort((spans["at"], spans["mark"], spans["id"]))]


def _ranges(spans: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> list[tuple[int, int]]:
    """Where the spans of each document begin and end among the sorted spans."""
    starts = np.flatnonzero(_first_of(spans["id"], spans["mark"]))
    ends = np.append(starts[1:], len(spans))
    keys = zip(spans["id"][starts].tolist(), spans["mark"][starts].tolist(), strict=True)
    at = dict(zip(keys, zip(starts.tolist(), ends.tolist(), strict=False), strict=False))
    return [at.get(k, (0, 0)) for k in zip(ids, marks, strict=True)]


def window_entries(rows: DataFrame, first: DataFrame, buckets: int, homes: int) -> DataFrame:
    """Second round, map side: the windows of segments that may be repeated in part."""
    names = ["bucket", "docs", "entries", "home", "spans"]

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        parts = _spans_of(found, True)
        ids, marks = texts["_id"].to_numpy(), texts["_mark"].to_numpy().astype(np.int32)
        ranges = np.array(_ranges(parts, ids.tolist(), marks.tolist()), np.int64).reshape(-1, 2)
        out = []
        for lo, hi, buf, offs in textnum.slices(texts["_text"]):
            size = ranges[lo:hi, 1] - ranges[lo:hi, 0]
            own = parts[np.repeat(ranges[lo:hi, 0], size) + _counting(size)]
            n = own["n"].astype(np.int64)
            row = np.repeat(np.repeat(np.arange(hi - lo), size), n)
            at = np.repeat(own["at"].astype(np.int64), n) + _counting(n)
            if len(at):
                hashes = textnum.mix64(textnum.window_hashes(textnum.BYTE_VALUE[buf], WIDTH))
                out.append((hashes[at + offs[row]], lo + row, at))
        if not out:
            return pa.table([pa.array([], k) for k in (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())], names=names)
        hashes, row, at = (np.concatenate(c) for c in zip(*out, strict=True))
        own = ids[row]
        order = np.lexsort((at, row, own, hashes))
        hashes, row, at, own = (x[order] for x in (hashes, row, at, own))
        repeated = own > _spread(_first_of(hashes), own)
        one = np.ones(len(at), np.uint8)
        spans = _spans(own[repeated], marks[row[repeated]], at[repeated], one[repeated], False)
        hashes, row, at, one = (x[~repeated] for x in (hashes, row, at, one))
        return pa.Table.from_batches([_packed(
            (hashes % U(buckets)).astype(np.int32), (hashes >> U(32)).astype(np.uint32), (hashes & U(0xFFFFFFFF)).astype(np.uint32), row, at, one,
            ids, marks, spans, homes, buckets, WINDOW)])

    return _grouped_texts(rows, first, homes).applyInArrow(run, PACKED)


def match_windows(entries: DataFrame, partitions: int, homes: int) -> DataFrame:
    """Second round, reduce side: the windows that also start in a document with a smaller id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, spans = _unpack(batches, WINDOW)
        if got is not None:
            anchor, value, ids, marks, at, n = got
            order = np.lexsort((ids, value, anchor))
            anchor, value, ids, marks, at, n = (x[order] for x in (anchor, value, ids, marks, at, n))
            repeated = ids > _spread(_first_of(anchor, value), ids)
            spans = np.concatenate([spans, _spans(ids[repeated], marks[repeated], at[repeated], n[repeated], False)])
        yield _result(spans, homes)

    return entries.repartition(partitions, "bucket").mapInArrow(run, RESULT)


def _counting(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n - 1 for each n, one after the other."""
    n = n.astype(np.int64)
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)


def removed_spans(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of ``spans``."""
    if not len(spans):
        return []
    order = np.argsort(spans["at"], kind="stable")
    lo = spans["at"][order].astype(np.int64)
    hi = np.maximum.accumulate(lo + spans["n"][order] + WIDTH - 1)
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[new].tolist(), hi[np.append(new[1:] - 1, len(lo) - 1)].tolist(), strict=True))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and the removed ``spans`` (start, end) of every row."""
    spark = docs.sparkSession
    rows = _documents(docs, id_col, text_col)
    size = int(rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("b")).head()["b"])
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    homes = -(-size // HOME_BYTES) + partitions
    first = stage(match_segments(segment_entries(rows, partitions, homes), partitions, homes), "segments")
    release(spark)
    second = stage(match_windows(window_entries(rows, first, partitions, homes), partitions, homes), "windows")
    release(spark)
    texts = docs.select(F.col(id_col).alias("_own"), F.col(id_col).cast("long").alias("_id"), F.hash(text_col).alias("_mark"), F.col(text_col).cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(texts: pa.Table, found: pa.Table) -> pa.Table:
        spans = _spans_of(found, False)
        ranges = _ranges(spans, texts["_id"].to_pylist(), texts["_mark"].to_pylist())
        sizes, removed, runs, codes, cuts = [], [], [], [], []
        for text, (first_, last) in zip(texts["_text"], ranges, strict=True):
            data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            cut = removed_spans(spans[first_:last])
            code, at = hashlib.sha256(), 0
            for lo, hi in cut:
                code.update(data[at:lo])
                at = hi
            code.update(data[at:])
            sizes.append(len(data))
            removed.append(sum(hi - lo for lo, hi in cut))
            runs.append(len(cut))
            codes.append(code.hexdigest())
            cuts.append([{"start": lo, "end": hi} for lo, hi in cut])
        return pa.table([
            texts["_own"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(codes, pa.string()),
            pa.array(cuts, kind)], names=["_own", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return _grouped_texts(texts, first.unionByName(second), homes).applyInArrow(finish, (
        f"_own {id_type}, n_bytes LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING, spans ARRAY<STRUCT<start: LONG, end: LONG>>"
    )).withColumnRenamed("_own", id_col)
