"""Quality classifier by weak labels.

Heuristic labellers vote on every document: good, bad, or nothing. Expectation-maximisation over the counts of all vote
patterns estimates, for each labeller and class, how often it casts which vote, and so gives every pattern a
posterior. The posteriors then are the targets of a hashed linear scorer over word shapes, whose probability decides. The
counts of patterns cover all documents; the scorer is fitted on a bounded sample (``TRAINING_ROWS``).

Defined results: null or empty texts, and texts without words, are bad (probability 0) and rejected. Repeated rows are
judged alike. An empty table gives an empty result. Null ids are kept. Columns other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import linear, textnum
from seriesprep.workspace import stage

TRAINING_ROWS = 20_000
DIMS = 1 << 14
GOOD, NONE, BAD = 1, 0, -1
LABELLERS = (
    "symbols", "dirty_words", "shouting", "loud_words", "exclaiming", "exclaimed_words", "repeating_pairs", "repeating_words",
    "same_word", "loose_marks", "word_length", "sentences",
)
# how often a labeller that votes says bad of a good or a bad text: the start, and a prior as strong as PRIOR of all documents
BAD_IF_GOOD, BAD_IF_BAD, PRIOR = 0.01, 0.4, 0.1
# what every labeller is trusted with: each catches one kind of bad text only, but seldom blames a good one
MOST_IF_GOOD, LEAST_IF_BAD = 0.01, 0.2

_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_LOWER[97:123] = True
_LOWER[128:] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#$%&*|~^<>{}[]@=+_\\")] = True
_STOP[list(b".,;:!?")] = True
# letters and digits as one code each; other bytes stand for themselves
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[_UPPER], _SHAPE[_LOWER], _SHAPE[_DIGIT] = 1, 2, 3


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE)).astype(np.int8)


def votes(buf: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Votes of all labellers, one row per document."""
    n_words = np.diff(before).astype(float)
    words, size = np.maximum(n_words, 1), np.maximum(np.diff(offs), 1).astype(float)
    upper, lower = _per_row(_UPPER[buf], offs), _per_row(_LOWER[buf], offs)
    symbols = _per_row(_SYMBOL[buf], offs) / size
    shout = upper / np.maximum(upper + lower, 1)
    exclaim = _per_row(buf == 33, offs) / size
    dirty = _per_row(_per_row(_SYMBOL[buf], ends_of(starts, ends)) > 0, before) / words if len(starts) else np.zeros(len(words))
    capitals, small = (_per_row(t[buf], ends_of(starts, ends)) if len(starts) else np.empty(0) for t in (_UPPER, _LOWER))
    loud = _per_row((capitals >= 2) & (small == 0), before) / words
    hashes = textnum.word_hashes(buf, starts, ends)
    with np.errstate(over="ignore"):
        pairs = textnum.mix64(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    distinct_pairs, distinct_words = np.ones(len(n_words)), np.ones(len(n_words))
    for r in np.flatnonzero(n_words >= 20):
        own = pairs[before[r] : before[r + 1] - 1]
        distinct_pairs[r] = len(np.unique(own)) / len(own)
        distinct_words[r] = len(np.unique(hashes[before[r] : before[r + 1]])) / n_words[r]
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[before[:-1][before[:-1] < len(again)]] = False
    same = _per_row(again, before) / words
    length = _per_row(ends - starts, before) / words
    last = buf[ends - 1] if len(ends) else buf[:0]
    stops = _per_row(_STOP[last], before) / words
    exclaimed = _per_row(last == 33, before) / words
    loose = _per_row((ends - starts == 1) & ~(_LOWER | _UPPER | _DIGIT)[last], before) / words
    some = n_words >= 20
    return np.stack([
        _vote(symbols < 0.01, symbols > 0.03), _vote(dirty < 0.05, dirty > 0.2), _vote(shout < 0.2, some & (shout > 0.35)),
        _vote(loud < 0.1, some & (loud > 0.25)), _vote(exclaim < 0.005, some & (exclaim > 0.03)),
        _vote(exclaimed < 0.05, some & (exclaimed > 0.25)), _vote(some & (distinct_pairs > 0.8), some & (distinct_pairs < 0.4)),
        _vote(some & (distinct_words > 0.3), some & (distinct_words < 0.08)), _vote(same < 0.05, some & (same > 0.2)), _vote(loose < 0.03, some & (loose > 0.15)),
        _vote(some & (length > 2.5) & (length < 14), some & ((length < 1.5) | (length > 25))),
        _vote(some & (stops > 0.01) & (stops < 0.5), (n_words >= 60) & ((stops == 0) | (stops > 0.8))),
    ], axis=1) if len(n_words) else np.empty((0, len(LABELLERS)), np.int8)


def ends_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bounds for sums per word: separators between words hold none of the counted bytes, so words may run on."""
    return np.append(starts, ends[-1])


def features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, cast: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed shapes of all words, weighted by frequency, and the votes: flat index, value, and bounds of rows."""
    size = ends - starts
    shape = np.minimum(size, 12).astype(np.uint64)
    with np.errstate(over="ignore"):
        for at in (starts, np.minimum(starts + 1, ends - 1), np.maximum(ends - 3, starts), np.maximum(ends - 2, starts), ends - 1):
            shape = shape * np.uint64(131) + _SHAPE[buf[at]] if len(at) else shape
        code = (textnum.mix64(shape + np.uint64(7)) % np.uint64(DIMS)).astype(np.int64)
        named = textnum.mix64(np.arange(3 * len(LABELLERS), dtype=np.uint64) + np.uint64(1 << 40)) % np.uint64(DIMS)
    rows = len(before) - 1
    index, value, bounds = [], [], [0]
    for r in range(rows):
        own, counts = np.unique(code[before[r] : before[r + 1]], return_counts=True)
        index += [own, named[3 * np.arange(len(LABELLERS)) + cast[r] + 1].astype(np.int64)]
        value += [counts / max(1, counts.sum()), np.full(len(LABELLERS), 0.5)]
        bounds.append(bounds[-1] + len(own) + len(LABELLERS))
    flat = np.concatenate(index) if index else np.empty(0, np.int64)
    return flat, np.concatenate(value) if value else np.empty(0), np.array(bounds)


def _measured(docs: DataFrame, id_col: str, text_col: str, then, schema: str) -> DataFrame:
    """Run ``then(ids, keys, texts' words, votes)`` over slices of the documents in Arrow batches."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in textnum.slices(b.column(2)):
                starts, ends, before = textnum.word_bounds(buf, offs)
                cast = votes(buf, offs, starts, ends, before)
                yield then(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), buf, starts, ends, before, cast)

    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, schema.format(id=id_type))


def _pattern(cast: np.ndarray) -> np.ndarray:
    return (cast.astype(np.int64) + 1) @ (3 ** np.arange(len(LABELLERS)))


def vote_patterns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_key`` and ``pattern``: the votes as one number in base 3."""
    def then(ids, keys, buf, starts, ends, before, cast):
        return pa.record_batch([ids, keys, pa.array(_pattern(cast), pa.int64())], names=["_id", "_key", "pattern"])

    return _measured(docs, id_col, text_col, then, "_id {id}, _key LONG, pattern LONG")


def label_model(patterns: np.ndarray, counts: np.ndarray, prior: float = PRIOR, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation: posterior of every pattern, P(bad vote | class) by class and labeller, share of good ones.

    Votes are independent given the class; a labeller that does not vote says nothing.
    """
    m, total = len(LABELLERS), counts.sum()
    cast = (patterns[:, None] // 3 ** np.arange(m)) % 3 - 1
    start = np.array([BAD_IF_BAD, BAD_IF_GOOD])
    rates, share = np.repeat(start[:, None], m, axis=1), 0.9
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        logs = [((cast == BAD) * np.log(rates[c]) + (cast == GOOD) * np.log(1 - rates[c])).sum(axis=1) + np.log(p)
                for c, p in enumerate((1 - share, share))]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        done = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        if done:
            break
        for c, weight in enumerate((counts * (1 - posterior), counts * posterior)):
            bad, voted = (weight[:, None] * (cast == BAD)).sum(axis=0), (weight[:, None] * (cast != NONE)).sum(axis=0)
            rates[c] = np.clip((bad + prior * total * start[c]) / np.maximum(voted + prior * total, 1e-9), 1e-6, 1 - 1e-6)
        rates[0], rates[1] = np.maximum(rates[0], LEAST_IF_BAD), np.minimum(rates[1], MOST_IF_GOOD)
        share = min(max((counts * posterior).sum() / max(total, 1), 0.01), 0.99)
    return posterior, rates, share


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training_rows: int = TRAINING_ROWS, threshold: float = 0.5,
) -> DataFrame:
    """Id, ``_key`` (hash of the text), ``weak_posterior``, ``p_good`` and ``keep`` of every row."""
    cast = stage(vote_patterns(docs, id_col, text_col), "votes")
    table = cast.groupBy("pattern").count().collect()  # at most 3 ** labellers rows
    patterns = np.array([r["pattern"] for r in table], np.int64)
    counts = np.array([r["count"] for r in table], float)
    posterior, _, _ = label_model(patterns, counts)
    by_pattern = dict(zip(patterns.tolist(), posterior.tolist(), strict=True))
    rows = int(counts.sum())

    def training(ids, keys, buf, starts, ends, before, cast):
        index, value, bounds = features(buf, starts, ends, before, cast)
        good = np.array([by_pattern[p] for p in _pattern(cast).tolist()])
        offsets = pa.array(bounds, pa.int32())
        target = np.stack([1 - good, good], axis=1).ravel() if len(good) else np.empty(0)
        return pa.record_batch([
            pa.ListArray.from_arrays(offsets, pa.array(index, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32())),
            pa.ListArray.from_arrays(pa.array(np.arange(len(good) + 1) * 2, pa.int32()), pa.array(target, pa.float32()))],
            names=["index", "value", "target"])

    sample = linear.bounded_sample(docs, F.xxhash64(text_col), rows, training_rows)
    model = linear.fit(
        _measured(sample, id_col, text_col, training, "index ARRAY<INT>, value ARRAY<FLOAT>, target ARRAY<FLOAT>"), 2, DIMS)

    def scoring(ids, keys, buf, starts, ends, before, cast):
        index, value, bounds = features(buf, starts, ends, before, cast)
        good = np.where(np.diff(before) > 0, model.posteriors(index, value, bounds)[:, 1], 0.0)
        weak = np.array([by_pattern.get(p, 0.5) for p in _pattern(cast).tolist()])
        return pa.record_batch([
            ids, keys, pa.array(weak, pa.float64()), pa.array(good, pa.float64()), pa.array(good >= threshold)],
            names=["_id", "_key", "weak_posterior", "p_good", "keep"])

    scored = _measured(docs, id_col, text_col, scoring, "_id {id}, _key LONG, weak_posterior DOUBLE, p_good DOUBLE, keep BOOLEAN")
    return scored.withColumnRenamed("_id", id_col)
