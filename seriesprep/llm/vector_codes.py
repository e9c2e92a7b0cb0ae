"""Product-quantised vectors with exact integer arithmetic.

Components become integers, ``floor(scale * x)``. A vector is cut into equal parts, and every part position has a codebook
of a few entries, refined by Lloyd rounds: assign each part to its nearest entry, replace each entry by the floor of
the mean of its parts. All of it is exact, so codes depend neither on partitioning nor on the order of sums: integers
are split into limbs so short that a float64 matrix product of limbs stays below 2**53, the products are put together
again in int64, and the first of equal distances wins. Vectors too large for int64 distances take the same steps in
Python's integers. A round is one scan; tasks return sums and counts per entry, split into 32-bit limbs as well, and
Spark adds them. The driver sees the codebooks only (``entries`` x the vector's length).

Defined results: vectors that are null, or hold a null or non-finite component, are dropped. The table's vector length is
its most frequent one (of equally frequent ones the longest); vectors of other lengths are dropped, too. A length that the number of
parts doesn't divide is filled up with zeros. The first codebooks are the vectors with the smallest ids, null ids last, equal ids by
vector; a table with fewer vectors has fewer entries. Entries without parts stay. Repeated rows count each. Errors beyond a
64-bit integer are null. An empty table gives an empty result. Columns other than id, vector and label play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MOST_LABELS = 100_000  # label sums that are broadcast; more are joined by shuffle
SALTS = 16
_DIGIT = 32  # bits of a limb of a sum
_LONG = 2**63 - 1


def limb_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact as long as the result fits into int64.

    With limbs of w bits, a product of two limbs summed over the inner dimension n is below n * 4**w, hence w.
    """
    inner = max(a.shape[1], 1)
    width = (52 - math.ceil(math.log2(inner))) // 2

    def limbs(m: np.ndarray) -> list[np.ndarray]:
        out = []
        while m.size and (m.min() < -(1 << width) or m.max() > 1 << width):
            out.append((m & ((1 << width) - 1)).astype(np.float64))
            m = m >> width
        return [*out, m.astype(np.float64)]

    total = np.zeros((a.shape[0], b.shape[1]), np.int64)
    right = limbs(b)
    for i, x in enumerate(limbs(a)):
        for j, y in enumerate(right):
            total += (x @ y).astype(np.int64) << (width * (i + j))
    return total


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``: int64, or Python's integers if there are values too large for that."""
    if not values.size or np.abs(values).max() < 2.0**48 / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = np.frompyfunc(lambda x: math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale, 1, 1)
    return exact(values)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, ties to the lower index, and the squared distance."""
    most = max([abs(int(m)) for a in (x, book) if a.size for m in (a.min(), a.max())], default=0)
    if 4 * max(x.shape[1], 1) * most**2 < 2**54:  # leaves room for the sum over up to 256 parts
        x, book = x.astype(np.int64), book.astype(np.int64)
        product = limb_product(x, book.T)
    else:
        x, book = x.astype(object), book.astype(object)
        product = x @ book.T
    away = (book * book).sum(axis=1)[None, :] - 2 * product
    best = away.argmin(axis=1)
    return best, away[np.arange(len(x)), best] + (x * x).sum(axis=1)


@dataclass(frozen=True)
class Codebooks:
    """Entries of shape (parts, entries, length of a part), as Python's integers."""

    books: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.books.ravel()).encode()).hexdigest()

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part, (rows, parts), and the squared distances summed over the parts."""
        codes = np.zeros((len(x), len(self.books)), np.int64)
        error = np.zeros(len(x), object if x.dtype == object else np.int64)
        for p, (part, book) in enumerate(zip(_cut(x, len(self.books)), _narrow(self.books), strict=True)):
            codes[:, p], away = nearest(part, book)
            error = error + away
        return codes, error


def _narrow(books: np.ndarray) -> list[np.ndarray]:
    return [b.astype(np.int64) if all(abs(v) < 2**62 for v in b.ravel()) else b for b in books]


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """The parts of all vectors, which are filled up with zeros to a multiple."""
    spare = -x.shape[1] % parts
    if spare:
        x = np.concatenate([x, np.zeros((len(x), spare), x.dtype)], axis=1)
    return np.split(x, parts, axis=1)


def _vectors(column: pa.Array, length: int, scale: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return integers(flat.reshape(len(lists), length), scale)


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, int]:
    """``_id``, ``_label`` and ``_vector`` of the rows that count, staged, and the length of their vectors."""
    kind = vectors.schema[vec_col].dataType.simpleString()
    rows = vectors.select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label"),
        F.col(vec_col).cast(kind if kind == "array<float>" else "array<double>").alias("_vector"))
    finite = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("_vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    usual = rows.groupBy(F.size("_vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = usual["n"] if usual else 0
    return stage(rows.filter(F.size("_vector") == length), "vectors"), length


def fit_codebooks(kept: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks after all rounds, of a table with ``_id`` and ``_vector``."""
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_vector").select("_vector").limit(entries).collect()
    start = integers(np.array([r["_vector"] for r in first], np.float64).reshape(len(first), length), scale)
    books = np.stack(_cut(start.astype(object), parts))
    slots, width = parts * len(first), books.shape[2]

    def sums(current: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for b in batches:
                x = _vectors(b.column(0), length, scale)
                codes, _ = current.encode(x)
                found = np.zeros((parts, len(first), width + 1), x.dtype)  # a column more for the counts
                for p, part in enumerate(_cut(x, parts)):
                    owner = (codes[:, p][None, :] == np.arange(len(first))[:, None]).astype(np.int64)
                    found[p, :, :-1] = limb_product(owner, part) if part.dtype != object else owner.astype(object) @ part
                    found[p, :, -1] = owner.sum(axis=1)
                level, rest = 0, found.ravel()
                while rest.any():  # limbs of two's complement: the last one is 0 or -1, and -1 is kept as it is
                    last = bool(((rest == -1) | (rest == 0)).all())
                    digit = rest if last else rest & ((1 << _DIGIT) - 1)
                    totals[level] = totals.get(level, 0) + digit.astype(np.int64)
                    rest = rest * 0 if last else rest >> _DIGIT
                    level += 1
            for level, total in totals.items():
                at = np.flatnonzero(total)
                yield pa.record_batch([pa.array(at, pa.int64()), pa.array(np.full(len(at), level), pa.int32()), pa.array(total[at], pa.int64())],
                                      names=["slot", "level", "value"])

        return run

    for _ in range(rounds if slots else 0):
        found = kept.select("_vector").mapInArrow(sums(Codebooks(books)), "slot LONG, level INT, value LONG")
        total = np.zeros(slots * (width + 1), object)
        for r in found.groupBy("slot", "level").agg(F.sum("value").alias("value")).collect():  # entries x length, and counts
            total[r["slot"]] += r["value"] << (_DIGIT * r["level"])
        total = total.reshape(parts, len(first), width + 1)
        books = books.copy()
        for p, e in zip(*np.nonzero(total[:, :, -1]), strict=True):
            books[p, e] = total[p, e, :-1] // total[p, e, -1]
    return Codebooks(books)


def _with_label_sums(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label."""
    sums = coded.groupBy("_label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    sums = stage(sums.select("_label", F.expr("try_cast(_sum AS BIGINT)").alias("label_error")), "label-sums")
    if sums.count() <= MOST_LABELS:
        other = F.broadcast(sums.withColumnRenamed("_label", "_other"))
        return coded.join(other, F.col("_label").eqNullSafe(F.col("_other")), "left").drop("_other")
    # many labels, of which one may hold many rows: its rows are dealt over salts, its sum is repeated
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("_id", "code", "error"), F.lit(SALTS)).cast("int"))
    other = sums.withColumnRenamed("_label", "_other").withColumn("_other_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match = F.col("_label").eqNullSafe(F.col("_other")) & (F.col("_salt") == F.col("_other_salt"))
    return salted.join(other, match, "left").drop("_other", "_salt", "_other_salt")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Id, ``code``, ``error`` and ``label_error`` of every vector that counts, and the codebooks.

    ``code`` has two hex digits per part: at most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has room for 256 entries")
    kept, length = kept_vectors(vectors, id_col, vec_col, label_col)
    books = fit_codebooks(kept, length, parts, entries, rounds, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, error = books.encode(_vectors(b.column(2), length, scale))
            text = codes.astype(np.uint8).tobytes().hex()
            step = 2 * parts
            yield pa.record_batch([
                b.column(0), b.column(1), pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()),
                pa.array([e if e <= _LONG else None for e in error.tolist()], pa.int64())], names=["_id", "_label", "code", "error"])

    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    coded = kept.select("_id", "_label", "_vector").mapInArrow(run, f"_id {types['_id']}, _label {types['_label']}, code STRING, error LONG")
    out = _with_label_sums(stage(coded, "codes"))
    return out.select(F.col("_id").alias(id_col), "code", "error", "label_error"), books
