"""The toxicity classifier: gradients against differences, held-out labels, and tables with everything wrong."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import hard
from seriesprep.llm import textnum
from seriesprep.llm import toxicity as tx

BAD = ["awful", "vile", "rotten"]
GOOD = [f"w{i}" for i in range(200)]


@pytest.fixture
def few_steps(monkeypatch):
    monkeypatch.setattr(tx.fit_network, "__defaults__", (12,))


def made(spark, n=400, seed=1, extra=()):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(GOOD, k=rng.randrange(5, 60))
        toxic = rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD).title() + rng.choice([",", "!", ""])
        rows.append((i, " ".join(words), rng.choice(["aa", "bb"]), "s"))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows + list(extra), "doc_id LONG, text STRING, lang STRING, source STRING").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    net = tx.Network.start(12, 0.3, seed=5)
    net.bias[:] = rng.normal(0, 0.1, len(net.bias))  # away from the corner of a text without words
    number, starts = tx.row_numbers(rng.integers(0, 14, 60).astype(np.uint64), np.array([0, 10, 10, 11, 60]), np.arange(2, 12, dtype=np.uint64))
    toxic = np.array([1.0, 0.0, 1.0, 0.0])
    g, loss = net.gradient(number, starts, toxic)
    flat = net.flat()
    for k in rng.choice(np.arange(tx.SIZE, flat.size), 60, replace=False):  # the padding has no weights
        up, down = (net.like(np.where(np.arange(flat.size) == k, flat + d, flat)).gradient(number, starts, toxic)[1] for d in (1e-6, -1e-6))
        assert abs((up - down) / 2e-6 - g[k]) < 1e-5
    p = net.scores(number, starts)
    assert abs(loss + (toxic * np.log(p) + (1 - toxic) * np.log(1 - p)).sum()) < 1e-9


def test_cutting_runs_changes_no_score(monkeypatch):
    rng = np.random.default_rng(3)
    net = tx.Network.start(6, seed=7)
    for _ in range(200):
        size = rng.integers(0, 30, 5)
        before = np.concatenate([[0], np.cumsum(size)])
        codes = np.where(rng.random(before[-1]) < 0.8, 99, rng.integers(0, 4, before[-1])).astype(np.uint64)
        cut = net.scores(*tx.row_numbers(codes, before, np.arange(4, dtype=np.uint64)))
        for k in range(5):  # every window of every text, one by one
            own = [tx.OTHER if c == 99 else int(c) + 2 for c in codes[before[k] : before[k + 1]]] or [tx.PAD]
            own += [tx.PAD] * 2
            top = [max(sum(net.embedding[own[p + j]] @ f[j][:, c] for j in range(len(f))) for p in range(len(own) - 2)) for f in net.filters for c in range(tx.FILTERS)]
            z = np.maximum(np.array(top) + net.bias, 0) @ net.output + net.intercept[0]
            assert abs(cut[k] - 1 / (1 + np.exp(-z))) < 1e-9
        if before[-1] > 60:
            break


def test_words_of_long_texts_in_pieces(monkeypatch):
    texts = pa.array([hard.LONG + "!", None, "A b,C", "", "x" * 5000, "ÉÉ été"])
    whole = [(hi - lo, codes.tolist(), before.tolist()) for lo, hi, codes, before in tx.word_codes(texts)]
    flat = [c for _, codes, _ in whole for c in codes]
    monkeypatch.setattr(textnum, "SLICE_BYTES", 997)
    monkeypatch.setattr(textnum.slices, "__defaults__", (997,))
    assert [c for *_, codes, _ in tx.word_codes(texts) for c in codes] == flat


def test_planted_words_are_found_on_held_out_rows(spark):
    docs, labels = made(spark)
    out = tx.classify(docs, labels).join(labels.withColumnRenamed("toxic", "y"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 40 and (held.predicted == held.y).mean() > 0.95 and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= 0.5)).all() and (out.toxic == (out.score >= out.threshold)).all()


def test_held_out_labels_of_the_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = tx.classify(docs, labels).join(labels.withColumnRenamed("toxic", "y"), "doc_id").filter("held_out").toPandas()
    bad, rank = out.y == 1, out.score.rank()
    area = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert area > 0.93 and out.predicted[bad].mean() > 0.75 and out.predicted[~bad].mean() < 0.01


def test_held_out_labels_and_other_columns_change_nothing(spark, few_steps):
    docs, labels = made(spark, 120)
    first = sorted(map(tuple, tx.classify(docs, labels).collect()))
    flipped = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, tx.classify(docs.withColumn("source", F.lit("x")), flipped).collect())) == first
    other = {r["doc_id"]: r["score"] for r in tx.classify(docs.withColumn("lang", F.lit(None).cast("string")), labels).collect()}
    assert all(abs(other[r[0]] - r[2]) < 1e-12 for r in first)


def test_hard_rows_and_labels(spark, few_steps):
    docs = hard.table(spark).withColumn("lang", F.when(F.col("doc_id") > 9, "zz"))
    some = [(i, 1, i % 2) for i in range(1, 18)] + [(1, 1, 0), (2, None, None), (None, 1, 1), (3, 1, 7), (999, 1, 1)]
    for labels in (some, [], [(1, 1, 1), (2, 1, 1)], [(1, 1, 0), (2, 1, 0)]):
        table = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
        out = tx.classify(docs, table).toPandas()
        assert len(out) == len(hard.ROWS) and out.score.between(0, 1).all() and out.predicted.isin([0, 1]).all()
        assert not out[out.doc_id.isna()].held_out.any()
        empty = out[out.doc_id.isin([3, 4, 5])].score
        assert empty.nunique() == 1
        if labels == []:
            assert (out.score < 1e-9).all()
        assert tx.classify(docs.limit(0), table).count() == 0
    assert tx.classify(docs, table).columns == ["doc_id", "held_out", "score", "predicted", "threshold", "toxic"]


def test_thresholds():
    assert tx.best_threshold(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) == pytest.approx(0.55)
    assert tx.best_threshold(np.array([0.4, 0.4, 0.4]), np.array([1, 0, 1])) == pytest.approx(0.2)
    assert tx.best_threshold(np.array([0.4]), np.array([0])) == 0.5 and tx.best_threshold(np.array([]), np.array([])) == 0.5


def test_training_rows_are_bounded(spark):
    docs, labels = made(spark, 300, extra=[(5, f"copy {k}", "aa", "s") for k in range(300)])
    rows = tx.training_rows(docs, labels, "doc_id", "text", "lang", 60)
    assert 20 <= rows.count() <= 110


def test_all_labelled_rows_are_learned_from(spark, few_steps):
    """Each bad word stands in a dozen of 40,000 rows: a sample of 10,000 would miss most of them."""
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"))
    bad = F.when(F.col("doc_id") < 600, F.concat(F.lit(" bad"), (F.col("doc_id") % 50).cast("string"))).otherwise(F.lit(""))
    docs = ids.withColumn("text", F.concat(F.lit("w"), (F.col("doc_id") % 97).cast("string"), bad)).withColumn("lang", F.lit("aa"))
    labels = ids.withColumn("toxic", (F.col("doc_id") < 600).cast("int"))
    kept = ids.filter(~tx.held_out(F.col("doc_id")))
    assert tx.training_rows(docs, labels, "doc_id", "text", "lang").count() == kept.count() > 30_000
    made = tx.fit(docs, labels)
    words = np.concatenate([codes for _, _, codes, _ in tx.word_codes(pa.array([f"bad{k}" for k in range(50)]))])
    assert np.isin(words, made.vocabulary).all()
    found = made.score(docs.filter("doc_id < 700"), "text", "doc_id").toPandas()
    assert (found.score[found.doc_id < 600].min() > found.score[found.doc_id >= 600].max())


def test_thresholds_of_a_table(spark, monkeypatch):
    rng = np.random.default_rng(4)
    score = np.concatenate([rng.random(300).round(2).clip(1e-26, 1), 1 / (1 + np.exp(-rng.normal(0, 9, 300))), [1.0, 1.0, 1 / (1 + np.exp(60.0))]])
    toxic = (rng.random(len(score)) < score).astype(float)
    lang = rng.choice(["aa", "bb", "cc", None], len(score), p=[0.6, 0.3, 0.02, 0.08])
    rows = [(float(s), float(t), k) for s, t, k in zip(score, toxic, lang, strict=True)]
    table = spark.createDataFrame(rows, "score DOUBLE, _toxic DOUBLE, _lang STRING").repartition(3)
    wanted = {None: tx.best_threshold(score, toxic)} | {k: tx.best_threshold(score[lang == k], toxic[lang == k]) for k in ("aa", "bb")}
    for bins in (tx.LOGIT_BINS, 1):
        monkeypatch.setattr(tx, "LOGIT_BINS", bins)
        assert tx.thresholds(table) == wanted
    assert tx.thresholds(table.limit(0)) == tx.thresholds(table.filter("_toxic = 0")) == {None: 0.5}


def test_many_shards_learn_the_same(spark, few_steps, monkeypatch):
    docs, labels = made(spark, 200)
    first = tx.classify(docs, labels).toPandas().sort_values("doc_id").score.to_numpy()
    monkeypatch.setattr(tx, "SHARD_ROWS", 16)
    monkeypatch.setattr(tx, "GRADIENTS", 2)
    monkeypatch.setattr(tx, "SLICE_POSITIONS", 50)
    assert tx._groups(9) == [5, 3, 2] and tx._groups(2) == []
    again = tx.classify(docs, labels).toPandas().sort_values("doc_id").score.to_numpy()
    assert np.abs(first - again).max() < 1e-3
