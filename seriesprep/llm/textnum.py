"""Word and byte arithmetic on whole Arrow batches with NumPy.

Texts are UTF-8 bytes. ``A-Z`` count as lower case; words are runs of bytes other than blank and
``0x09``-``0x0D``. All hashes have 64 bits: a polynomial over random byte values, finished by a mixing
step, so that equal bytes always get equal hashes on every machine. A batch is worked on in slices of about
``SLICE_BYTES``; a longer text makes one longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below n."""
    with np.errstate(over="ignore"):
        out = np.full(n, base % 2**64, U)
        out[:1] = 1
        return np.cumprod(out)


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _word_table() -> np.ndarray:
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    return table


BASE = 0x9E3779B97F4A7C15
LOWER = _lower_table()
IN_WORD = _word_table()
BYTE_VALUE = mix64(np.arange(1, 257, dtype=U) * U(BASE))
LOWER_VALUE = BYTE_VALUE[LOWER]
_INVERSE = pow(BASE, -1, 2**64)
_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _known.get(base)
    if have is None or len(have) < n:
        have = powers(base, max(n, SLICE_BYTES + 1))
        if len(have) <= 4 * SLICE_BYTES:
            _known[base] = have
    return have[:n]


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes, and byte offsets of the rows; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, bytes_[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row and after the last."""
    inside = IN_WORD[buf]
    if not len(buf):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    cut = offs[(offs > 0) & (offs < len(buf))]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[cut] = inside[cut]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each lower-cased word."""
    if not len(starts):
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buf) + 1, U)
        np.cumsum(LOWER_VALUE[buf] * _powers(BASE, len(buf)), out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * _powers(_INVERSE, len(buf))[starts] + (ends - starts).astype(U))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash, not yet mixed, of every run of ``width`` values; ``len - width + 1`` of them."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        out, done, part, size = None, 0, values.astype(U, copy=False), 1
        while True:  # doubling: part[i] covers size values from i
            if width & size:
                piece = part[done : done + n]
                out = piece.copy() if out is None else out * U(pow(BASE, size, 2**64)) + piece
                done += size
            if 2 * size > width:
                return out
            part = part[:-size] * U(pow(BASE, size, 2**64)) + part[size:]
            size *= 2


def shingles(words: np.ndarray, before: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a row, and how many stand before each row.

    A row with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    counts = np.diff(before)
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(per_row)])
    first = np.repeat(before[:-1] - starts[:-1], per_row) + np.arange(starts[-1])
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(width, U)])
        out = mix64(window_hashes(padded, width)[first] + U(width)) if len(first) else np.empty(0, U)
        for row in np.flatnonzero((counts > 0) & (counts < width)):
            part = words[before[row] : before[row + 1]]
            out[starts[row]] = mix64(window_hashes(part, len(part)) + U(len(part)))[0]
    return out, starts


def row_sets(hashes: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each row."""
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        part = hashes[lo:hi]
        if hi - lo > 1:
            part = np.sort(part)
            keep = np.empty(hi - lo, bool)
            keep[0] = True
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            part = part[keep]
        yield part


def words_column(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> pa.Array:
    """The chosen words, lower-cased, as an Arrow string column."""
    lengths = (ends - starts)[chosen]
    offs = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(starts[chosen] - offs[:-1], lengths) + np.arange(offs[-1])
    data = LOWER[buf[at]]
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data))
