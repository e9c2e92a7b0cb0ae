"""Toxicity by a convolutional text classifier.

Words (runs of letters and digits, lower case) are hashed, and hashes are looked up among the ``VOCABULARY`` hashes that tell the classes of the
training rows apart best by chi-square, each in ``LEAST_ROWS`` of them at least; all other words share one row of the embedding.
Training rows are all labelled rows that aren't held out. One in ``CALIBRATION`` of them chooses thresholds, all others count in the
choice of words and in every step.
Filters of several widths run over the word vectors, the largest answer of each filter over the whole text is kept, and a logistic layer
makes the score of these. All weights are trained in NumPy by synchronous steps (Adam): every step, the tasks return
the gradients of their shard of the training rows, which are added up, by more tasks first if there are many. Since maxima don't care how
often a window occurs, a run of other words is cut to the widest filter's width; that changes no score.

The threshold is calibrated by language: on training rows that took no part in the steps, the score at which F1 is highest, for every
language with ``LEAST_TOXIC`` toxic rows among them; the others use the one of all languages. Language decides nothing but which threshold
holds: scores come from texts alone.

Bounds: vocabulary and weights are as large whatever the corpus. Fitting takes time in proportion to the training rows, which are dealt to
tasks by hash, and ``STEPS`` passes over their numbered words; the driver gets words, gradients and thresholds, never rows. Scoring is
one pass without a shuffle. Who wants a quicker fit may ask for fewer rows (``training``); nothing does so by itself.

Defined results: null or empty texts get the score of a text without words. Labels that are null, other than 0 and 1, of unknown documents
or of held-out ids are not used; if an id has several labels, it is toxic if one says so. Without labels of both classes
all scores are the share of toxic rows (0 without any). Repeated rows score alike. A null id isn't held out. An empty table gives an
empty result. Very long texts are read in pieces. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesprep.llm import linear, textnum
from seriesprep.workspace import stage

VOCABULARY, LEAST_ROWS = 3000, 4
SIZE, WIDTHS, FILTERS = 12, (1, 2, 3), 8
STEPS, RATE, DECAY = 60, 0.05, 1e-3
SHARDS = 4  # at least; more if a shard would have over SHARD_ROWS
SHARD_ROWS = 2500
GRADIENTS = 32  # that one task or the driver adds up
SLICE_POSITIONS = 1 << 15
CALIBRATION = 5  # one row in so many chooses thresholds
LOGIT_BINS = 64  # blocks of scores per unit of the logit
LEAST_TOXIC = 15
PAD, OTHER = 0, 1  # rows of the embedding before those of the vocabulary
_REACH = max(WIDTHS)
_PLAIN = textnum.LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32


def held_out(id_column: Column) -> Column:
    """Whether a document's label must not be learned from."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


# --- words

def _bounds(n: int, buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a text that end between words."""
    lo = 0
    while lo < n:
        hi = min(lo + textnum.SLICE_BYTES, n)
        while hi < n and textnum.IN_WORD[buf[hi]]:
            hi += 1
        yield lo, hi
        lo = hi


def word_codes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, hashes of their words, and the number of words before each row."""
    for lo, hi, buf, offs in textnum.slices(column):
        buf = _PLAIN[buf]
        if hi - lo > 1 or len(buf) <= textnum.SLICE_BYTES:
            starts, ends, before = textnum.word_bounds(buf, offs)
            yield lo, hi, textnum.word_hashes(buf, starts, ends), before
        else:
            parts = []
            for a, b in _bounds(len(buf), buf):
                starts, ends, _ = textnum.word_bounds(buf[a:b], np.array([0, b - a]))
                parts.append(textnum.word_hashes(buf[a:b], starts, ends))
            codes = np.concatenate(parts)
            yield lo, hi, codes, np.array([0, len(codes)])


def row_numbers(codes: np.ndarray, before: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding for all words, long runs of other words cut, every text followed by padding; and where texts start.

    A text has one position at least.
    """
    at = np.minimum(np.searchsorted(vocabulary, codes), max(len(vocabulary) - 1, 0))
    known = vocabulary[at] == codes if len(vocabulary) else np.zeros(len(codes), bool)
    number = np.where(known, at + OTHER + 1, OTHER).astype(np.int32)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    keep = np.ones(len(codes), bool)
    for back in range(1, _REACH + 1):
        same = np.zeros(len(codes), bool)
        same[back:] = ~known[:-back] & (text[back:] == text[:-back])
        keep &= same
    keep = ~(keep & ~known)
    number, text = number[keep], text[keep]
    size = np.bincount(text, minlength=len(before) - 1)
    room = np.maximum(size, 1) + _REACH - 1
    starts = np.concatenate([[0], np.cumsum(room)])
    out = np.full(starts[-1], PAD, np.int32)
    first = np.concatenate([[0], np.cumsum(size)])
    out[starts[text] + np.arange(len(text)) - first[text]] = number
    return out, starts


# --- the network

@dataclass
class Network:
    """Embedding (rows, size), filters per width (width, size, filters), bias and output weights of all filters, intercept."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    intercept: np.ndarray

    @classmethod
    def start(cls, rows: int, intercept: float = 0.0, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (rows, SIZE))
        embedding[PAD] = 0
        filters = [rng.normal(0, 1 / np.sqrt(w * SIZE), (w, SIZE, FILTERS)) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(embedding, filters, np.zeros(n), rng.normal(0, 0.5, n), np.array([intercept]))

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.output, self.intercept]

    def like(self, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for a in self.arrays():
            parts.append(flat[at : at + a.size].reshape(a.shape))
            at += a.size
        return Network(parts[0], parts[1:-3], *parts[-3:])

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def tables(self) -> list[np.ndarray]:
        """Per width, what each row of the embedding adds at each place of each filter: (width, rows, filters)."""
        return [np.stack([self.embedding @ f[j] for j in range(len(f))]) for f in self.filters]

    def answers(self, tables: list[np.ndarray], number: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per width, each filter's answer at all positions that belong to texts, and where the texts start among these."""
        size = np.diff(starts) - _REACH + 1
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts[:-1] - first[:-1], size) + np.arange(first[-1])
        for table in tables:
            total = table[0][number[at]]
            for j in range(1, len(table)):
                total = total + table[j][number[at + j]]
            yield total, first, at

    def scores(self, number: np.ndarray, starts: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        if len(starts) < 2:
            return np.empty(0)
        top = [np.maximum.reduceat(a, first[:-1], axis=0) for a, first, _ in self.answers(tables or self.tables(), number, starts)]
        z = np.maximum(np.concatenate(top, axis=1) + self.bias, 0) @ self.output + self.intercept[0]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def peaks(self, number: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per width, each filter's largest answer in every text, and the first position that gives it: (texts, filters) both.

        Texts are worked on in slices of some ``SLICE_POSITIONS``, which bounds the memory.
        """
        n, tables = len(starts) - 1, [np.ascontiguousarray(t.transpose(2, 0, 1)) for t in self.tables()]
        top, place = np.empty((len(tables), n, FILTERS)), np.empty((len(tables), n, FILTERS), np.int64)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SLICE_POSITIONS, "right")) - 1)
            size = np.diff(starts[lo : hi + 1]) - _REACH + 1
            first = np.concatenate([[0], np.cumsum(size)])
            text = np.repeat(np.arange(hi - lo), size)
            at = np.repeat(starts[lo:hi] - first[:-1], size) + np.arange(first[-1])
            word = [number[at + j].astype(np.int64) for j in range(_REACH)]
            for k, table in enumerate(tables):
                for f in range(FILTERS):
                    a = table[f, 0][word[0]]
                    for j in range(1, len(table[f])):
                        a += table[f, j][word[j]]
                    best = np.maximum.reduceat(a, first[:-1])
                    hit = np.flatnonzero(a == best[text])
                    top[k, lo:hi, f], place[k, lo:hi, f] = best, at[hit[np.searchsorted(hit, first[:-1])]]
            lo = hi
        yield from zip(top, place, strict=True)

    def gradient(self, number: np.ndarray, starts: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
        """Of the summed log loss of rows: its gradient, flat, and its value."""
        tops, places = zip(*self.peaks(number, starts), strict=True)
        raw = np.concatenate(tops, axis=1) + self.bias
        feature = np.maximum(raw, 0)
        z = np.clip(feature @ self.output + self.intercept[0], -60, 60)
        p = 1 / (1 + np.exp(-z))
        off = p - toxic
        d_feature = np.where(raw > 0, off[:, None] * self.output, 0.0)
        d_embedding, d_filters = np.zeros_like(self.embedding), []
        for k, (f, place) in enumerate(zip(self.filters, places, strict=True)):
            own = d_feature[:, k * FILTERS : (k + 1) * FILTERS]
            d_filter = np.zeros_like(f)
            for j in range(len(f)):
                slot = number[place + j].astype(np.int64) * FILTERS + np.arange(FILTERS)
                d_table = np.bincount(slot.ravel(), own.ravel(), len(self.embedding) * FILTERS).reshape(-1, FILTERS)
                d_embedding += d_table @ f[j].T
                d_filter[j] = self.embedding.T @ d_table
            d_filters.append(d_filter)
        d_embedding[PAD] = 0
        loss = (np.logaddexp(0, z) - toxic * z).sum()
        return Network(d_embedding, d_filters, d_feature.sum(axis=0), feature.T @ off, np.array([off.sum()])).flat(), float(loss)


# --- training

def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str | None, most: int | None = None,
) -> DataFrame:
    """``_toxic``, ``_lang``, ``_part``, ``_deal`` and ``_text`` of the labelled rows that aren't held out, staged.

    All of them, or about ``most`` if the caller asks for fewer.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_own")).agg(F.max("toxic").cast("double").alias("_toxic"))
    if most is not None:
        known = linear.bounded_sample(known, F.col("_own"), known.count(), most)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.join(known, docs[id_col] == known["_own"]).select(
        "_own", "_toxic", (docs[lang_col].cast("string") if lang_col else F.lit(None).cast("string")).alias("_lang"),
        F.xxhash64(text).alias("_key"), text.alias("_text"))
    rows = rows.dropDuplicates(["_own", "_key"])
    if most is not None:  # ids may be shared by many texts; then rows are drawn once more
        rows = linear.bounded_sample(rows, F.xxhash64("_own", "_key"), rows.select("_own", "_key").distinct().count(), most)
    deal = F.xxhash64("_own", "_key", F.lit(3))
    part = F.pmod(deal, F.lit(CALIBRATION * SHARDS)).cast("int")
    return stage(rows.select("_toxic", "_lang", part.alias("_part"), deal.alias("_deal"), "_text"), "toxic-training")


def choose_words(rows: DataFrame, size: int = VOCABULARY, least: int = LEAST_ROWS) -> np.ndarray:
    """Sorted hashes of the words whose presence tells toxic rows apart best by chi-square."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column(0).to_numpy()
            for lo, hi, codes, before in word_codes(b.column(1)):
                own = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(before))
                order = np.lexsort((own, codes))
                code, row = codes[order], own[order]
                if not len(code):
                    continue
                new = np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
                code, row = code[new], row[new]
                words, where, n = np.unique(code, return_inverse=True, return_counts=True)
                yield pa.record_batch([
                    pa.array(words.view(np.int64)), pa.array(n), pa.array(np.bincount(where, toxic[lo + row], len(words)))],
                    names=["word", "n", "t"])

    found = rows.select("_toxic", "_text").mapInArrow(run, "word LONG, n LONG, t DOUBLE").groupBy("word").agg(
        F.sum("n").cast("double").alias("n"), F.sum("t").alias("t")).filter(F.col("n") >= least)
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_toxic"), F.lit(0.0)).alias("t")).head()
    if not 0 < whole["t"] < whole["n"]:
        return np.empty(0, np.uint64)
    total, bad = float(whole["n"]), float(whole["t"])
    apart = F.col("t") * total - F.col("n") * bad
    chi = apart * apart * total / (F.col("n") * (total - F.col("n") + 1e-9) * bad * (total - bad))
    best = found.select("word", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(size).collect()
    return np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))


def _added(parts: list[bytes]) -> np.ndarray:
    """The sum of gradients, whatever their order."""
    return sum(np.frombuffer(g, np.float32).astype(np.float64) for g in sorted(map(bytes, parts)))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(g, value) for b in batches for g, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    if parts:
        g = _added([g for g, _ in parts]).astype(np.float32).tobytes()
        yield pa.record_batch([pa.array([g], pa.binary()), pa.array([sum(value for _, value in parts)])], names=["g", "loss"])


def _groups(parts: int) -> list[int]:
    """How many tasks add up the gradients of ``parts`` tasks, round by round, until the driver can."""
    sizes = []
    while parts > GRADIENTS:
        parts = -(-parts // GRADIENTS)
        sizes.append(parts)
    return sizes


def fit_network(rows: DataFrame, vocabulary: np.ndarray, steps: int = STEPS) -> Network:
    """Synchronous steps over all rows that don't calibrate, shard by shard."""
    spark = rows.sparkSession
    used = rows.filter(F.col("_part") >= SHARDS)
    whole = used.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_toxic"), F.lit(0.0)).alias("t")).head()
    n, share = whole["n"], (whole["t"] / whole["n"] if whole["n"] else 0.0)
    if not 0 < share < 1:  # nothing to tell apart: the intercept alone decides
        net = Network.start(len(vocabulary) + OTHER + 1, 60.0 if share else -60.0)
        net.output[:] = 0
        return net
    shards = max(SHARDS, -(-n // SHARD_ROWS))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, codes, before in word_codes(b.column(2)):
                number, starts = row_numbers(codes, before, vocabulary)
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(number))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), lists], names=["shard", "toxic", "number"])

    own = F.col("_part") % SHARDS if shards == SHARDS else F.hash("_deal")  # row by row, so that many shards are of one size
    used = used.select(own.alias("shard"), F.col("_toxic").alias("toxic"), "_text")
    numbers = used.mapInArrow(numbered, "shard INT, toxic DOUBLE, number ARRAY<INT>")
    data = stage(numbers.repartition(shards, "shard"), "toxic-shards").coalesce(shards)
    groups = _groups(data.rdd.getNumPartitions())
    net = Network.start(len(vocabulary) + OTHER + 1, float(np.log(share / (1 - share))))
    moment, square = np.zeros(net.flat().size), np.zeros(net.flat().size)
    for step in range(1, steps + 1):
        shared = spark.sparkContext.broadcast(net.flat().astype(np.float32))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, size=len(net.embedding)) -> Iterator[pa.RecordBatch]:
            own = Network.start(size).like(shared.value.astype(np.float64))
            total, loss = 0.0, 0.0
            for b in batches:
                number, starts = b.column(1).flatten().to_numpy(), b.column(1).offsets.to_numpy().astype(np.int64)
                if b.num_rows:
                    g, value = own.gradient(number, starts - starts[0], b.column(0).to_numpy())
                    total, loss = total + g, loss + value
            if np.ndim(total):
                yield pa.record_batch([pa.array([total.astype(np.float32).tobytes()], pa.binary()), pa.array([loss])], names=["g", "loss"])

        parts = data.select("toxic", "number").mapInArrow(run, "g BINARY, loss DOUBLE")
        for size in groups:
            parts = parts.repartition(size).mapInArrow(_merged, "g BINARY, loss DOUBLE")
        g = _added([r["g"] for r in parts.collect()]) / n + DECAY * net.flat()  # at most GRADIENTS
        shared.destroy()
        moment, square = 0.9 * moment + 0.1 * g, 0.99 * square + 0.01 * g * g
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        net = net.like(net.flat() - rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8))
        net.embedding[PAD] = 0
    return net


def best_threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The score at or above which F1 is highest, halfway to the next lower one; 0.5 without toxic rows."""
    if not len(scores) or not toxic.sum():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], toxic[order]
    last = np.append(s[1:] != s[:-1], True)
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    at = np.flatnonzero(last)[np.argmax(f1[last])]
    return float((s[at] + (s[at + 1] if at + 1 < len(s) else 0.0)) / 2)


def thresholds(judged: DataFrame) -> dict[str | None, float]:
    """``best_threshold`` of all rows of ``score``, ``_toxic`` and ``_lang``, under None, and of each language with ``LEAST_TOXIC`` toxic rows.

    Equal scores are counted first. Counts run down over blocks of neighbouring scores, then within each block, so no task
    holds a language.
    """
    each = judged.withColumn("_lang", F.explode(F.array_distinct(F.array(F.lit(None).cast("string"), "_lang"))))
    counts = each.groupBy("_lang", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("_toxic").alias("t"))
    logit = F.log(F.col("score") / (1 - F.least(F.col("score"), F.lit(1 - 2.0**-53))))
    counts = stage(counts.withColumn("block", F.floor(logit * LOGIT_BINS)), "toxic-judged")
    down = Window.partitionBy("_lang").orderBy(F.desc("block"))  # a row per block
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("_lang", "block").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.max("score").alias("top")).select(
        F.col("_lang").alias("own"), F.col("block").alias("at"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0.0)).alias("t_above"), F.lead("top").over(down).alias("next_top"),
        F.sum("t").over(Window.partitionBy("_lang")).alias("bad"))
    blocks = blocks.filter((F.col("bad") > 0) & (F.col("own").isNull() | (F.col("bad") >= LEAST_TOXIC)))
    inside = Window.partitionBy("_lang", "block").orderBy(F.desc("score"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = counts.join(blocks.hint("merge"), F.col("_lang").eqNullSafe(F.col("own")) & (F.col("block") == F.col("at"))).select(
        "_lang", "score", F.coalesce(F.lead("score").over(inside), "next_top", F.lit(0.0)).alias("below"),
        (2 * (F.col("t_above") + F.sum("t").over(so_far)) / (F.col("n_above") + F.sum("n").over(so_far) + F.col("bad"))).alias("f1"))
    best = steps.groupBy("_lang").agg(F.max_by(F.struct("score", "below"), F.struct("f1", "score")).alias("best"))
    found = best.select("_lang", ((F.col("best.score") + F.col("best.below")) / 2).alias("threshold")).collect()  # one row per language
    return {None: 0.5} | {r["_lang"]: r["threshold"] for r in found}


@dataclass
class Classifier:
    """Vocabulary, network, and the thresholds by language; None stands for all languages."""

    vocabulary: np.ndarray
    network: Network
    thresholds: dict[str | None, float]

    def score(self, rows: DataFrame, text: str, *others: str) -> DataFrame:
        """The columns ``others`` and ``score`` of all rows."""
        shared = rows.sparkSession.sparkContext.broadcast((self.vocabulary, self.network.flat()))
        chosen = rows.select(text, *others)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, flat = shared.value
            network = Network.start(len(vocabulary) + OTHER + 1).like(flat)
            tables = [t.astype(np.float32) for t in network.tables()]
            for b in batches:
                for lo, hi, codes, before in word_codes(b.column(0)):
                    p = network.scores(*row_numbers(codes, before, vocabulary), tables)
                    yield pa.record_batch([*[b.column(k).slice(lo, hi - lo) for k in range(1, b.num_columns)], pa.array(p, pa.float64())],
                                          names=[*others, "score"])

        types = {f.name: f.dataType.simpleString() for f in chosen.schema}
        return chosen.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in others) + ", score DOUBLE")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
    training: int | None = None,
) -> Classifier:
    """Words, weights and thresholds from all labelled documents that aren't held out, or from about ``training`` of them."""
    rows = training_rows(docs, labels, id_col, text_col, lang_col, training)
    vocabulary = choose_words(rows.filter(F.col("_part") >= SHARDS))
    made = Classifier(vocabulary, fit_network(rows, vocabulary), {})
    made.thresholds = thresholds(made.score(rows.filter(F.col("_part") < SHARDS), "_text", "_toxic", "_lang"))
    return made


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
    training: int | None = None,
) -> DataFrame:
    """Id, ``held_out``, ``score``, ``predicted`` (score of one half or more), ``threshold`` of the language and ``toxic`` (score
    at or above it) of every row."""
    made = fit(docs, labels, id_col, text_col, lang_col, training)
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")).alias("_lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    scored = made.score(rows, "_text", "_id", "_lang")
    known = [(k, v) for k, v in made.thresholds.items() if k is not None]  # each stands for LEAST_TOXIC training rows
    whole = F.lit(made.thresholds[None])
    threshold = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in known for x in kv]), F.col("_lang")), whole) if known else whole
    return scored.withColumn("threshold", threshold).select(
        F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold", (F.col("score") >= F.col("threshold")).alias("toxic"))
