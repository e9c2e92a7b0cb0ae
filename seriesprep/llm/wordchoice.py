"""Tokens of texts for bag-of-words classifiers, and the choice of those that tell labelled classes apart.

Tokens are runs of letters and digits, lower case, and runs of other visible ASCII characters. Texts longer than a slice are read in
pieces that end at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import textnum

LETTERS, MARKS = 1, 2
_KIND = np.array([LETTERS if b >= 128 or chr(b).isalnum() else MARKS if 32 < b < 127 else 0 for b in range(256)], np.uint8)


def token_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every token, and the number of tokens before each row and after the last."""
    kind = _KIND[buf]
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    change = np.ones(len(buf) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offs] = True
    starts = np.flatnonzero(change[:-1] & (kind > 0))
    ends = np.flatnonzero(change[1:] & (kind > 0)) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _pieces(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The slice itself, or pieces of its only text if that is long."""
    if len(offs) > 2 or len(buf) <= textnum.SLICE_BYTES:
        yield buf, offs
        return
    lo = 0
    while lo < len(buf):
        hi = min(lo + textnum.SLICE_BYTES, len(buf))
        gap = np.flatnonzero(~textnum.IN_WORD[buf[hi : hi + textnum.SLICE_BYTES]])
        while hi < len(buf) and not len(gap):
            hi = min(hi + textnum.SLICE_BYTES, len(buf))
            gap = np.flatnonzero(~textnum.IN_WORD[buf[hi : hi + textnum.SLICE_BYTES]])
        hi = hi + int(gap[0]) if hi < len(buf) else hi
        yield buf[lo:hi], np.array([0, hi - lo])
        lo = hi


def token_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, end row, the distinct token hashes of these rows, their bounds by row, and the words (between white space) of each row."""
    for lo, hi, buf, offs in textnum.slices(column):
        found, words = [], np.zeros(hi - lo, np.int64)
        for part, at in _pieces(buf, offs):
            starts, ends, before = token_bounds(part, at)
            words += np.diff(textnum.word_bounds(part, at)[2])
            codes, row = textnum.word_hashes(part, starts, ends), np.repeat(np.arange(hi - lo), np.diff(before))
            found.append(_distinct(codes, row))
        codes, row = found[0] if len(found) == 1 else _distinct(*(np.concatenate(x) for x in zip(*found, strict=True)))
        yield lo, hi, codes, np.searchsorted(row, np.arange(hi - lo + 1)), words


def _distinct(codes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    return codes[new], row[new]


def known_features(vocabulary: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence of the tokens of a sorted vocabulary: flat index, value, and bounds of rows."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0), np.zeros(len(bounds), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
    known = vocabulary[at] == codes
    return at[known], np.ones(int(known.sum())), np.concatenate([[0], np.cumsum(known)])[bounds]


def choose_words(rows: DataFrame, classes: int, size: int, least: int) -> np.ndarray:
    """Sorted hashes of the ``size`` tokens with the largest chi-square of presence against class, in ``least`` rows at least.

    ``rows`` has the class as a number and the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, codes, bounds, _ in token_sets(b.column(1)):
                if len(codes):
                    words, where = np.unique(codes, return_inverse=True)
                    own = kind[lo:hi][np.repeat(np.arange(hi - lo), np.diff(bounds))]
                    counts = np.bincount(where * classes + own, minlength=len(words) * classes).reshape(-1, classes)
                    yield pa.record_batch([pa.array(words.view(np.int64)), *[pa.array(counts[:, k]) for k in range(classes)]],
                                          names=["word", *[f"n{k}" for k in range(classes)]])

    kind, text = rows.columns
    sizes = {r[0]: r[1] for r in rows.groupBy(kind).count().collect()}
    total, names = float(sum(sizes.values())), [f"n{k}" for k in range(classes)]
    counts = rows.select(kind, text).mapInArrow(run, "word LONG, " + ", ".join(f"{n} LONG" for n in names)).groupBy("word").agg(
        *[F.sum(n).cast("double").alias(n) for n in names])
    held = sum((F.col(n) for n in names), F.lit(0.0))
    chi = F.lit(0.0)
    for k, n in enumerate(names):
        if 0 < sizes.get(k, 0) < total:
            wanted = F.col("held") * (sizes[k] / total)
            chi = chi + (F.col(n) - wanted) ** 2 * (1 / wanted + 1 / (F.lit(float(sizes[k])) - wanted + 1e-9))
    best = counts.withColumn("held", held).filter(F.col("held") >= least).select("word", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(size)
    return np.sort(np.array([r["word"] for r in best.collect()], np.int64).view(np.uint64))
