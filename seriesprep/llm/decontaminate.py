"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are partitioned by their number of shingles into classes [u/2, u). An item's sketch holds its smallest shingle
hashes, as many as its class needs: if a share ``t`` of at most u shingles is contained in a document, at
most u - ceil(t * u) are not, so one more hash than that always meets the document. The sketches meet the documents'
whole shingle sets, since a document's own MinHash values cannot find an item that makes up a small part of it.
Candidates are verified with all shingles of item and document.

A document is compared through a filter of ``FILTER_SLOTS`` slots at most, whatever the number of items, so nothing
that grows is sent to the tasks; what passes is joined with the items by shingle hash (64 bits).

Defined results: an item of fewer than five words is searched as one shingle of its own length; an item without words
is in no document, a null text is empty. Repeated rows of documents, or of items, are reported each. Null ids are kept.
Empty tables give an empty result. Columns other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import textnum
from seriesprep.workspace import stage

PERCENT = 80
FILTER_SLOTS = 1 << 24
SKETCH, SHINGLE = 2, 1
BROADCAST_ROWS = 200_000


def sketch_size(n: int, percent: int = PERCENT) -> int:
    """Hashes in the sketch of an item of n shingles: by the largest size of its class."""
    largest = (1 << n.bit_length()) - 1
    return min(n, largest - -(-percent * largest // 100) + 1)


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``_item``, ``_item_row``, ``n``, ``width``, ``hash``, ``in_sketch``: one row per item and distinct shingle."""
    rows = items.select(F.col(id_col).alias("_item"), F.monotonically_increasing_id().alias("_item_row"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in textnum.slices(b.column(2)):
                starts, ends, before = textnum.word_bounds(buf, offs)
                found, at = textnum.shingles(textnum.word_hashes(buf, starts, ends), before)
                sets = list(textnum.row_sets(found, at))
                sizes = np.array([len(s) for s in sets])
                sketch = [np.arange(len(s)) < sketch_size(len(s), percent) for s in sets]  # sets are sorted
                row = np.repeat(np.arange(lo, hi), sizes)
                yield pa.record_batch([
                    b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(np.repeat(sizes, sizes), pa.int32()),
                    pa.array(np.repeat(np.minimum(np.diff(before), textnum.SHINGLE_WORDS), sizes), pa.int32()),
                    pa.array(np.concatenate(sets).view(np.int64)), pa.array(np.concatenate(sketch))],
                    names=["_item", "_item_row", "n", "width", "hash", "in_sketch"])

    id_type = rows.schema["_item"].dataType.simpleString()
    return rows.mapInArrow(run, f"_item {id_type}, _item_row LONG, n INT, width INT, hash LONG, in_sketch BOOLEAN")


def slot_filter(shingles: DataFrame, most: int = FILTER_SLOTS) -> np.ndarray:
    """Flags by the low bits of a hash: a sketch, or any item, has a shingle there. At most ``most`` bytes."""
    count = shingles.count()
    slots = min(most, 1 << max(16, (512 * count).bit_length()))
    flag = F.when(F.col("in_sketch"), SKETCH | SHINGLE).otherwise(SHINGLE)
    found = shingles.groupBy(F.col("hash").bitwiseAND(F.lit(slots - 1)).alias("slot")).agg(F.bit_or(flag).alias("flag")).toPandas()
    out = np.zeros(slots, np.uint8)
    out[found["slot"].to_numpy(np.int64)] = found["flag"].to_numpy(np.uint8)
    return out


def document_hits(docs: DataFrame, flags: np.ndarray, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """``_doc``, ``_key``, ``hash``: filtered shingles of the documents that have one where a sketch has one."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(flags)
    rows = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        low = np.uint64(len(table) - 1)
        for b in batches:
            for lo, hi, buf, offs in textnum.slices(b.column(2)):
                starts, ends, before = textnum.word_bounds(buf, offs)
                words = textnum.word_hashes(buf, starts, ends)
                rows_, hashes = [], []
                for width in widths:
                    found, at = textnum.shingles(words, before, width)
                    flag = table[(found & low).astype(np.int64)]
                    kept = np.flatnonzero(flag)
                    rows_.append(np.searchsorted(at, kept, "right") - 1)
                    hashes.append(found[kept])
                row, hash_ = np.concatenate(rows_), np.concatenate(hashes)
                hit = np.zeros(hi - lo, bool)
                hit[row[(table[(hash_ & low).astype(np.int64)] & SKETCH) > 0]] = True
                row, hash_ = row[hit[row]], hash_[hit[row]]
                if len(row):
                    order = np.lexsort((hash_, row))
                    row, hash_ = row[order], hash_[order]
                    first = np.concatenate([[True], (row[1:] != row[:-1]) | (hash_[1:] != hash_[:-1])])
                    row, hash_ = row[first], hash_[first]
                    yield pa.record_batch([
                        b.column(0).take(pa.array(lo + row)), b.column(1).take(pa.array(lo + row)), pa.array(hash_.view(np.int64))],
                        names=["_doc", "_key", "hash"])

    id_type = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"_doc {id_type}, _key LONG, hash LONG")


def contaminated(
    docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs of document and item whose shingles the document contains to ``percent`` or more.

    Returns the ids, ``_key`` (hash of the document's text), ``n_item``, ``n_shared`` and ``containment``. Rows of documents
    with equal id and text are one pair.
    """
    shingles = stage(item_shingles(items, item_id, item_text, percent), "items")
    size = shingles.count()
    # an item of fewer words adds its own width: at most four more
    widths = sorted({textnum.SHINGLE_WORDS} | {r["width"] for r in shingles.select("width").distinct().collect()})
    hits = document_hits(docs, slot_filter(shingles), widths, id_col, text_col)
    sought = shingles.select("hash", "_item", "_item_row", "n", "in_sketch")
    joined = hits.join(F.broadcast(sought) if size <= BROADCAST_ROWS else sought, "hash")
    pairs = joined.groupBy("_doc", "_key", "_item", "_item_row", "n").agg(
        F.count("*").alias("n_shared"), F.max("in_sketch").alias("candidate"))
    found = pairs.filter(F.col("candidate") & (100 * F.col("n_shared") >= percent * F.col("n")))
    return found.select(
        F.col("_doc").alias(id_col), "_key", F.col("_item").alias(item_id), F.col("n").cast("long").alias("n_item"), "n_shared",
        (F.col("n_shared") / F.col("n")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    found = contaminated(docs, items, percent, id_col, text_col).select(F.col(id_col).alias("_doc"), "_key").distinct()
    match = docs[id_col].eqNullSafe(found["_doc"]) & (F.xxhash64(docs[text_col]) == found["_key"])
    return docs.join(found, match, "left_anti")
