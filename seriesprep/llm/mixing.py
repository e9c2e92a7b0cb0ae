"""Mixing to target weights with soft memberships.

Domains are the classes of the labelled table: good, poor and toxic. A classifier over the ``WORDS`` tokens that tell the labelled
documents' domains apart best, fitted on ``TRAINING_ROWS`` of them at most, predicts each document's posterior over the domains. Every
document gets a nonnegative rate, so that the expected tokens of each domain, the sum of rate * tokens * posterior, match their
targets. Rates start at 1 and are fitted by distributed projected gradient steps on the squared distance of the domains' expected tokens from
their targets: a step moves each rate against its own slope, its posteriors times one weight per domain, and cuts it off at zero. The slope is
measured in the inverse Gram matrix of the documents that are not cut off, and a step is halved until the distance falls, down to ``LEAST_STEP``. A step
needs the domains' totals only, which Spark sums up; a document's rate follows from the steps so far, three numbers each, so rates are neither
moved nor stored. Steps end when the targets are met within ``TOLERANCE`` of all tokens, when the distance has stopped falling
(``SETTLED``), or after ``STEPS``; the nearest step is taken, and what distance remains is given as a warning.

Defined results: null or empty texts have no tokens and the intercept's posterior. Labels that are null or of unknown
documents are left out; of several labels of one id the largest domain counts, so toxic before poor before good. Without any labels all
posteriors are equal. Repeated rows count each. A target of None leaves the domain its share among the domains of no target. Targets of
unreachable domains (no tokens expected) are left out. Very long texts are read in
pieces. An empty table gives an empty result; columns other than id and text play no part.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep.llm import linear, wordchoice
from seriesprep.workspace import stage

DOMAINS = ("good", "poor", "toxic")
# clean documents themselves are expected to hold some 2.5 % of poor and of toxic tokens each; lower targets would cost clean documents
TARGETS = (0.94, 0.03, 0.03)
TRAINING_ROWS = 20_000
WORDS, LEAST_ROWS = 300, 8  # of 300, 1000 and 3000 words, 300 did best on folds of training labels
STEPS = 60
TOLERANCE = 1e-6
LEAST_STEP = 1e-3  # of a full step; taken even if the distance grows, which leads past edges of the cut-off
SETTLED = 0.01  # of the squared distance, gained in 25 steps
SLACK = 1e-9  # keeps the Gram matrix of few documents regular
MISSED = 1e-4  # share of all tokens


def domain_of(quality: Column, toxic: Column) -> Column:
    """Index of a labelled document's domain; null if a label is missing."""
    known = quality.isNotNull() & toxic.isNotNull()
    return F.when(known, F.when(toxic == 1, 2).when(quality == 1, 0).otherwise(1))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """``_domain`` and ``_text`` of the labelled documents, about ``most`` ids at most."""
    known = labels.select(F.col(id_col).alias("_own"), domain_of(F.col("quality"), F.col("toxic")).alias("_domain")).filter(
        "_domain IS NOT NULL AND _own IS NOT NULL").groupBy("_own").agg(F.max("_domain").alias("_domain"))
    chosen = linear.bounded_sample(known, F.col("_own"), known.count(), most)
    rows = docs.join(F.broadcast(chosen), docs[id_col] == chosen["_own"])  # some `most` rows of two numbers
    return stage(rows.select("_domain", F.col(text_col).cast("string").alias("_text")), "domain-training")


def fit_rows(rows: DataFrame, words: int = WORDS, least: int = LEAST_ROWS) -> tuple[np.ndarray, linear.Linear]:
    """Vocabulary and weights of the classifier from rows of ``_domain`` and ``_text``."""
    vocabulary = wordchoice.choose_words(rows, len(DOMAINS), words, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, codes, bounds, _ in wordchoice.token_sets(b.column(1)):
                index, value, bounds = wordchoice.known_features(vocabulary, codes, bounds)
                target = np.eye(len(DOMAINS))[b.column(0).to_numpy(zero_copy_only=False)[lo:hi]]
                at = pa.array(bounds, pa.int32())
                yield pa.record_batch([
                    pa.ListArray.from_arrays(at, pa.array(index, pa.int32())), pa.ListArray.from_arrays(at, pa.array(value, pa.float32())),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(target) + 1) * len(DOMAINS), pa.int32()), pa.array(target.ravel(), pa.float32()))],
                    names=["index", "value", "target"])

    features = rows.mapInArrow(run, "index ARRAY<INT>, value ARRAY<FLOAT>, target ARRAY<FLOAT>")
    return vocabulary, linear.fit(features, len(DOMAINS), max(len(vocabulary), 1), steps=60, rate=0.5, decay=3e-4)


def fit_domains(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", training_rows_: int = TRAINING_ROWS,
) -> tuple[np.ndarray, linear.Linear]:
    """The classifier of documents into domains; ``labels`` has the id, ``quality`` and ``toxic``."""
    return fit_rows(training_rows(docs, labels, id_col, text_col, training_rows_))


def memberships(docs: DataFrame, model: tuple[np.ndarray, linear.Linear], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_key``, ``n_tokens`` and one posterior per domain, ``p0``, ``p1``, ..., of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0], model[1].weights))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    names = [f"p{k}" for k in range(len(DOMAINS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        own = linear.Linear(weights)
        for b in batches:
            for lo, hi, codes, bounds, words in wordchoice.token_sets(b.column(2)):
                p = own.posteriors(*wordchoice.known_features(vocabulary, codes, bounds))
                yield pa.record_batch([
                    b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(words, pa.int64()),
                    *[pa.array(p[:, k]) for k in range(p.shape[1])]], names=["_id", "_key", "n_tokens", *names])

    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {id_type}, _key LONG, n_tokens LONG, " + ", ".join(f"{n} DOUBLE" for n in names))


def _rate(steps: list[np.ndarray]) -> Column:
    """A document's rate: 1, less its posteriors times the weights of each step, cut off at zero after each."""
    rate = F.lit(1.0)
    for weights in steps:
        rate = F.greatest(F.lit(0.0), rate - sum((F.col(f"p{k}") * float(w) for k, w in enumerate(weights)), F.lit(0.0)))
    return rate


def _totals(members: DataFrame, steps: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain, and the Gram matrix of the documents that are not cut off."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    names = [*[f"t{i}" for i in range(k)], *[f"g{i}_{j}" for i, j in pairs]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for b in batches:
            n = b.column(0).to_numpy().astype(float)
            p = np.stack([b.column(1 + i).to_numpy() for i in range(k)], axis=1)
            rate = np.ones(len(n))
            for weights in steps:
                rate = np.maximum(0.0, rate - p @ weights)
            left = np.where(rate > 0, n, 0.0)
            total += [*((rate * n) @ p), *[(left * p[:, i]) @ p[:, j] for i, j in pairs]]
        yield pa.record_batch([pa.array([x]) for x in total], names=names)

    rows = members.select("n_tokens", *[f"p{i}" for i in range(k)]).mapInArrow(run, ", ".join(f"{x} DOUBLE" for x in names))
    row = rows.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in names]).head()
    gram = np.zeros((k, k))
    for (i, j), g in zip(pairs, row[k:], strict=True):
        gram[i, j] = gram[j, i] = g
    return np.array(row[:k]), gram


def wanted_tokens(have: np.ndarray, targets: tuple[float | None, ...]) -> np.ndarray:
    """Tokens by domain: shares as given; domains without a target share what is left as they do now."""
    given = np.array([0.0 if t is None else t for t in targets])
    free = np.array([t is None for t in targets])
    if not free.any() or not have[free].sum():
        return given / max(given.sum(), 1e-300) * have.sum()
    return np.where(free, have / have[free].sum() * (1 - given.sum()), given) * have.sum()


def fit_rates(members: DataFrame, targets: tuple[float | None, ...] = TARGETS, steps: int = STEPS) -> tuple[Column, np.ndarray, np.ndarray]:
    """The rate as a column over ``members``, and the expected and the wanted tokens of each domain."""
    taken: list[np.ndarray] = []
    have, whole = _totals(members, taken, len(targets))
    total, gram = have.sum(), whole
    wanted = wanted_tokens(have, targets)
    if not total:
        return _rate(taken), have, wanted
    metric = np.linalg.pinv(whole, rcond=1e-9, hermitian=True)
    distance = lambda x: float((x - wanted) @ metric @ (x - wanted))
    best = [(distance(have), 0, have)]  # after each step: the least distance so far, by how many steps, and the tokens there
    while len(taken) < steps and np.abs(have - wanted).max() > TOLERANCE * total:
        if len(best) > 25 and best[-1][0] > best[-26][0] * (1 - SETTLED):
            break
        full, size = np.linalg.pinv(gram + SLACK * whole, rcond=1e-14, hermitian=True) @ (have - wanted), 1.0
        while True:
            now, now_gram = _totals(members, [*taken, full * size], len(targets))
            if distance(now) < distance(have) or size < LEAST_STEP:
                break
            size /= 2
        taken.append(full * size)
        have, gram = now, now_gram
        best.append(min(best[-1], (distance(have), len(taken), have), key=lambda b: b[0]))
    _, count, have = best[-1]
    taken = taken[:count]
    return _rate(taken), have, wanted


def mix(
    docs: DataFrame, labels: DataFrame, targets: tuple[float | None, ...] = TARGETS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Id, ``_key``, ``n_tokens``, the posteriors by name of domain, and ``rate`` of every row."""
    members = stage(memberships(docs, fit_domains(docs, labels, id_col, text_col), id_col, text_col), "memberships")
    rate, have, wanted = fit_rates(members, targets)
    if np.abs(have - wanted).max() > MISSED * wanted.sum():
        warnings.warn(f"targets out of reach: expected tokens {have.tolist()}, wanted {wanted.tolist()}", stacklevel=2)
    return members.select(
        F.col("_id").alias(id_col), "_key", "n_tokens", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(DOMAINS)], rate.alias("rate"))


def with_rates(
    docs: DataFrame, labels: DataFrame, targets: tuple[float | None, ...] = TARGETS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that have a positive rate, with all their columns and ``n_tokens``, posteriors and ``rate``.

    Columns of ``docs`` that have one of these names are replaced.
    """
    added = ["n_tokens", *[f"p_{d}" for d in DOMAINS], "rate"]
    mixed = mix(docs, labels, targets, id_col, text_col).filter("rate > 0").select(
        F.col(id_col).alias("_mixed"), F.col("_key").alias("_mixed_key"), *[F.col(c).alias(f"_new_{c}") for c in added]).distinct()
    match = docs[id_col].eqNullSafe(mixed["_mixed"]) & (F.xxhash64(docs[text_col]) == mixed["_mixed_key"])
    kept = [c for c in docs.columns if c not in added]
    return docs.join(mixed, match).select(*[docs[f"`{c}`"] for c in kept], *[mixed[f"_new_{c}"].alias(c) for c in added])
