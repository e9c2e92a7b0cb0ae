"""Class-based bigram language model: exchange clustering assigns words to classes.

A token's probability is that of its class after the class before it, times that of the word in its class:

    P(w | v) = (n(c', c) + A * b(c)) / (n(c') + A) * b(w) / b(c),  c = class of w, c' = class of v

where b(w) = (n(w) + 0.5) / (N + 0.5 * (V + 1)) is the smoothed share of a word in the training tokens, the same with
n(w) = 0 for every unseen word, and b(c) sums b over the class and one unseen word. A text is its words and one
end token; it begins after an end token.

Every word has a class. The most frequent ``WORDS`` words are units of their own; all others are gathered into
``ENDINGS`` units by their last three bytes, unseen words too, so the units' number is fixed while counts cover all
tokens. Classes start by rank and are improved by exchange: each unit moves to the class that raises the likelihood
most. What an exchange needs, each unit's counts of neighbouring classes, is summed by Spark from the table of unit
bigrams; the driver sees units times classes numbers, whatever the corpus.

Counts of all words stay in a table. The most frequent, at most ``DICTIONARY`` words, are sent to the tasks; the other
words of a text are joined with the table.

Defined results: a null or empty text is one end token. A null id is never held out. Repeated rows are counted
and scored each. An empty training set leaves every word unseen (b = 1 for one unseen word). Columns other than id and text
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import textnum
from seriesprep.workspace import stage

END = " "  # no word holds a blank
WORDS, ENDINGS, CLASSES = 2048, 512, 64
DICTIONARY = 1 << 17
EXCHANGES = 6
PRIOR = 20.0  # A
END_UNIT = WORDS + ENDINGS
UNITS = END_UNIT + 1
END_CLASS = CLASSES

U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts within each batch, and the end tokens."""
    for b in batches:
        hashes, counts, words = [], [], []
        for _, _, buf, offs in textnum.slices(b.column(0)):
            starts, ends, _ = textnum.word_bounds(buf, offs)
            own, first, n = np.unique(textnum.word_hashes(buf, starts, ends), return_index=True, return_counts=True)
            hashes.append(own)
            counts.append(n)
            words.append(textnum.words_column(buf, starts, ends, first))
        own, first, where = np.unique(np.concatenate(hashes) if hashes else np.empty(0, U), return_index=True, return_inverse=True)
        sums = np.bincount(where, np.concatenate(counts) if counts else None, len(own)).astype(np.int64)
        every = pa.concat_arrays(words).take(pa.array(first)) if words else pa.array([], pa.string())
        yield pa.record_batch([pa.concat_arrays([every, pa.array([END])]), pa.array(np.append(sums, b.num_rows))], names=["word", "n"])


def count_words(training: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all training tokens."""
    return training.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(_word_counts, "word STRING, n LONG").groupBy(
        "word").agg(F.sum("n").alias("n"))


def frequent_words(vocabulary: DataFrame, most: int = DICTIONARY) -> tuple[pa.Array, np.ndarray]:
    """The most frequent words, at most ``most``, with their counts, from the most frequent on; without the end token.

    A count is taken or left as a whole, so words of equal count are treated alike.
    """
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    sizes = sorted(vocabulary.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])  # at most 1024 levels
    taken, least = 0, None
    for r in sizes:
        if taken + r["count"] > most:
            break
        taken, least = taken + r["count"], r["level"]
    if least is None:
        return pa.array([], pa.string()), np.empty(0, np.int64)
    found = vocabulary.filter((level >= least) & (F.col("word") != END)).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return found["word"].combine_chunks(), found["n"].to_numpy().astype(np.int64)


def hash_words(words: pa.Array) -> np.ndarray:
    """Hashes of words, as the tasks compute them."""
    out = []
    for _, _, buf, offs in textnum.slices(words):
        out.append(textnum.word_hashes(buf, offs[:-1], offs[1:]))
    return np.concatenate(out) if out else np.empty(0, U)


@dataclass(frozen=True)
class Units:
    """The frequent words by hash, and their numbers."""

    hashes: np.ndarray
    numbers: np.ndarray

    def of(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Unit of every word."""
        ending = np.zeros(len(starts), U)
        with np.errstate(over="ignore"):
            for back in (1, 2, 3):
                at = ends - back
                ending = ending * U(257) + np.where(at >= starts, textnum.LOWER[buf[np.maximum(at, 0)]].astype(U) + U(1), U(0))
        out = WORDS + (textnum.mix64(ending) % U(ENDINGS)).astype(np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.numbers[at[known]]
        return out

    def sequence(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Units of all rows, one after the other, each row closed by an end token."""
        rows = len(before) - 1
        out = np.full(len(starts) + rows, END_UNIT, np.int64)
        out[np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(before))] = self.of(buf, starts, ends, hashes)
        return out


def make_units(words: pa.Array) -> Units:
    hashes = hash_words(words[:WORDS])
    order = np.argsort(hashes)
    return Units(hashes[order], order.astype(np.int64))


def count_bigrams(training: DataFrame, units: Units, text_col: str = "text") -> DataFrame:
    """``a``, ``b``, ``n``: how often unit b follows unit a."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for b in batches:
            counts = np.zeros(UNITS * UNITS, np.int64) if counts is None else counts
            for _, _, buf, offs in textnum.slices(b.column(0)):
                starts, ends, before = textnum.word_bounds(buf, offs)
                seq = units.sequence(buf, starts, ends, textnum.word_hashes(buf, starts, ends), before)
                pair, n = np.unique(np.concatenate([[END_UNIT], seq[:-1]]) * UNITS + seq, return_counts=True)
                counts[pair] += n
        if counts is not None:
            pair = np.flatnonzero(counts)
            for lo in range(0, len(pair), 1 << 18):
                own = pair[lo : lo + (1 << 18)]
                yield pa.record_batch([pa.array(own // UNITS, pa.int32()), pa.array(own % UNITS, pa.int32()), pa.array(counts[own])], names=["a", "b", "n"])

    return training.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "a INT, b INT, n LONG").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _phi(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log likelihood: their bigrams' mutual information."""
    return float(_phi(table).sum() - _phi(table.sum(axis=0)).sum() - _phi(table.sum(axis=1)).sum())


def exchange(classes: np.ndarray, right: np.ndarray, left: np.ndarray, itself: np.ndarray, table: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """Move each movable unit, in turn, to the class that raises the likelihood most; returns the new classes.

    ``right`` and ``left`` hold each unit's counts of the classes that follow and precede it, without itself;
    ``table`` the class bigrams. Classes of neighbours count as they were before the call.
    """
    classes, g = classes.copy(), table.astype(float)
    last = g.shape[0] - 1  # the end token's class takes no word
    for u in movable.tolist():
        own, r, l, s = classes[u], right[u], left[u], itself[u]
        if r.sum() + l.sum() + s == 0:
            continue
        g[own] -= r
        g[:, own] -= l
        g[own, own] -= s
        # totals of the classes with the unit back among their neighbours, wherever it goes
        rows, cols, diagonal = g.sum(axis=1) + l, g.sum(axis=0) + r, np.diagonal(g)
        base = _phi(g)
        with_row, with_col = _phi(g + r[None, :]) - base, _phi(g + l[:, None]) - base
        gain = (
            with_row.sum(axis=1) - np.diagonal(with_row) + with_col.sum(axis=0) - np.diagonal(with_col)
            + _phi(diagonal + r + l + s) - _phi(diagonal) - _phi(rows + r.sum() + s) + _phi(rows) - _phi(cols + l.sum() + s) + _phi(cols))
        gain[last] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= gain[own] + 1e-9:
            best = own
        classes[u] = best
        g[best] += r
        g[:, best] += l
        g[best, best] += s
    return classes


def neighbour_counts(bigrams: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Right and left class counts of every unit, its counts beside itself, and the class bigrams."""
    spark = bigrams.sparkSession
    k = CLASSES + 1
    named = spark.createDataFrame([(int(i), int(c)) for i, c in enumerate(classes)], "u INT, c INT")  # UNITS rows
    a, b = (F.broadcast(named.select(F.col("u").alias(x), F.col("c").alias(f"c{x}"))) for x in ("a", "b"))
    joined = bigrams.join(a, "a").join(b, "b")
    apart = F.col("a") != F.col("b")
    sides = F.inline(F.when(apart, F.array(
        F.struct(F.col("a").alias("u"), F.col("cb").alias("c"), F.lit(0).alias("side")),
        F.struct(F.col("b").alias("u"), F.col("ca").alias("c"), F.lit(1).alias("side")),
    )).otherwise(F.array(F.struct(F.col("a").alias("u"), F.lit(0).alias("c"), F.lit(2).alias("side")))))
    found = joined.select("n", sides).groupBy("u", "c", "side").agg(F.sum("n").alias("n")).toPandas()  # at most UNITS * (2 * classes + 1) rows
    out = np.zeros((3, UNITS, k))
    np.add.at(out, (found["side"].to_numpy(np.int64), found["u"].to_numpy(np.int64), found["c"].to_numpy(np.int64)), found["n"].to_numpy(float))
    right_, left_, self_ = out[0], out[1], out[2][:, 0]
    table = np.zeros((k, k))
    np.add.at(table, classes, right_)
    np.add.at(table, (classes, classes), self_)
    return right_, left_, self_, table


def cluster(bigrams: DataFrame, rounds: int = EXCHANGES) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units, and the class bigrams; the best of the rounds is returned."""
    classes = np.append(np.arange(END_UNIT) % CLASSES, END_CLASS)
    best = None
    for i in range(rounds + 1):
        right, left, itself, table = neighbour_counts(bigrams, classes)
        score = likelihood(table)
        if best is None or score > best[0]:
            best = (score, classes, table)
        if i == rounds:
            break
        # a third of the units each time: neighbours that move at once would judge each other by outdated classes
        movable = np.arange(END_UNIT)[i % 3 :: 3] if i >= 1 else np.arange(END_UNIT)
        classes = exchange(classes, right, left, itself, table, movable)
    return best[1], best[2]


@dataclass(frozen=True)
class ClassModel:
    """What scoring needs: units, the log factor of each pair of classes, frequent counts, and the totals."""

    units: Units
    classes: np.ndarray
    factors: np.ndarray  # log10 of P(c | c') / b(c)
    hashes: np.ndarray
    counts: np.ndarray
    end_count: int
    tokens: int
    types: int
    vocabulary: DataFrame

    @property
    def denominator(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def fit(training: DataFrame, text_col: str = "text", rounds: int = EXCHANGES) -> ClassModel:
    vocabulary = stage(count_words(training, text_col), "vocabulary")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                           F.coalesce(F.sum(F.when(F.col("word") == END, F.col("n"))), F.lit(0)).alias("e")).head()
    words, counts = frequent_words(vocabulary)
    units = make_units(words)
    bigrams = stage(count_bigrams(training, units, text_col), "bigrams")
    classes, table = cluster(bigrams, rounds)

    def by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in textnum.slices(b.column(0)):
                starts, ends = offs[:-1], offs[1:]
                unit = units.of(buf, starts, ends, textnum.word_hashes(buf, starts, ends))
                yield pa.record_batch([pa.array(unit, pa.int32()), b.column(1).slice(lo, hi - lo)], names=["u", "n"])

    sizes = vocabulary.filter(F.col("word") != END).select("word", "n").mapInArrow(by_unit, "u INT, n LONG").groupBy("u").agg(
        F.sum(F.col("n") + 0.5).alias("mass")).collect()  # at most UNITS rows
    mass = np.full(CLASSES + 1, 0.5)  # an unseen word in each class
    for r in sizes:
        mass[classes[r["u"]]] += r["mass"]
    mass[END_CLASS] = total["e"] + 0.5
    share = mass / (total["n"] + 0.5 * (total["v"] + 1))
    prior = mass / mass.sum()
    transition = (table + PRIOR * prior[None, :]) / (table.sum(axis=1, keepdims=True) + PRIOR)
    hashes = hash_words(words)
    order = np.argsort(hashes)
    return ClassModel(units, classes, np.log10(transition / share[None, :]), hashes[order], counts[order], total["e"], total["n"], total["v"], vocabulary)


def score(docs: DataFrame, model: ClassModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.units, model.classes, model.factors, model.hashes, model.counts))
    down, end_count = model.denominator, model.end_count
    rows = docs.select(F.col(id_col).alias("_id"), held_out(F.col(id_col)).alias("_held"), F.col(text_col).cast("string").alias("_text"))
    id_type = rows.schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes, factors, known, counts = shared.value
        part, number = TaskContext.get().partitionId() << 40, 0
        for b in batches:
            for lo, hi, buf, offs in textnum.slices(b.column(2)):
                m = hi - lo
                starts, ends, before = textnum.word_bounds(buf, offs)
                hashes = textnum.word_hashes(buf, starts, ends)
                row = np.repeat(np.arange(m), np.diff(before))
                c = classes[units.sequence(buf, starts, ends, hashes, before)]
                factor = factors[np.concatenate([[END_CLASS], c[:-1]]), c]
                tokens = np.diff(before) + 1
                last = np.cumsum(tokens)
                sums = np.concatenate([[0.0], np.cumsum(factor)])
                at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                found = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                logs = np.log10((counts[at[found]] + 0.5) / down) if len(known) else np.empty(0)
                base = np.bincount(row[found], logs, m) + np.log10((end_count + 0.5) / down)
                n_known = np.bincount(row[found], minlength=m) + (end_count > 0)
                ids = part + number + np.arange(m)
                number += m
                nothing = pa.nulls(m, pa.string())
                yield pa.record_batch([
                    pa.array(ids), b.column(0).slice(lo, m), b.column(1).slice(lo, m), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()),
                    pa.array(base), pa.array(sums[last] - sums[last - tokens]), nothing, pa.array(np.zeros(m, np.int64))], names=names)
                rare = np.flatnonzero(~found)
                if len(rare):
                    with np.errstate(over="ignore"):
                        pair = textnum.mix64(hashes[rare] + U(0x9E3779B97F4A7C15) * (row[rare].astype(U) + U(1)))
                    _, first, n = np.unique(pair, return_index=True, return_counts=True)
                    own, k = rare[first], len(first)
                    yield pa.record_batch([
                        pa.array(ids[row[own]]), pa.nulls(k, b.column(0).type), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                        pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), textnum.words_column(buf, starts, ends, own), pa.array(n.astype(np.int64))],
                        names=names)

    names = ["row", "_id", "_held", "tokens", "known", "base", "factor", "word", "times"]
    scanned = stage(rows.mapInArrow(run, (
        f"row LONG, _id {id_type.simpleString()}, _held BOOLEAN, tokens LONG, known LONG, base DOUBLE, factor DOUBLE, word STRING, times LONG")), "scored")
    rare = scanned.filter("word IS NOT NULL").select("row", "word", "times").join(model.vocabulary, "word", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.log10((n + 0.5) / down) * F.col("times")).alias("more"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"))
    base = F.col("base") + F.coalesce("more", F.lit(0.0))
    return scanned.filter("word IS NULL").drop("word", "times").join(sums, "row", "left").select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + F.col("factor")).alias("score"))


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents that are not held out, and score all."""
    return score(docs, fit(docs.filter(~held_out(F.col(id_col))), text_col), id_col, text_col)
