"""Exact, near and passage deduplication against plain versions, on hard tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import hard
from seriesprep.llm import exact_dedup, jaccard_join, suffix_dedup


def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return [(i, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]


def test_exact_groups(spark):
    got = exact_dedup.exact_groups(hard.table(spark))
    hard.same(got.select("doc_id", "keep_id", "group_size", "text_sha256").collect(), exact(hard.ROWS))
    kept = got.filter("kept").groupBy("text_sha256").count()
    assert kept.filter("count <> 1").count() == 0 and kept.count() == len({t or "" for _, t in hard.ROWS})
    assert got.filter("kept AND NOT doc_id <=> keep_id").count() == 0


def test_drop_copies(spark):
    docs = hard.table(spark)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["text"] or "" for r in out.collect()) == sorted({t or "" for _, t in hard.ROWS})


def test_clashing_digests_move_on_to_the_next(spark):
    docs = hard.table(spark)
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1).cast("binary")
    got = exact_dedup.exact_groups(docs, digests=(weak, exact_dedup.short_digest))
    hard.same(got.select("doc_id", "keep_id", "group_size", "text_sha256").collect(), exact(hard.ROWS))
    with pytest.raises(ValueError):
        exact_dedup.verified_digest(docs, (weak,))


def test_chunks_make_up_the_text(spark):
    docs = hard.table(spark)
    joined = docs.select("text", F.array_join(exact_dedup.chunks(F.col("text")), "").alias("j"), exact_dedup.chunks(F.col("text")).alias("c"))
    assert joined.filter("coalesce(text, '') <> j").count() == 0
    assert joined.selectExpr("max(array_max(transform(c, x -> length(x)))) AS m").head()["m"] <= exact_dedup.MOST


@pytest.mark.parametrize("pairs", [64, 2])
def test_similar_groups(spark, monkeypatch, pairs):
    monkeypatch.setattr(jaccard_join, "CELL_PAIRS", pairs)
    monkeypatch.setattr(jaccard_join, "LEAF", 64 if pairs > 2 else 3)
    rng = random.Random(pairs)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(hard.ROWS)
    common = [rng.choice(vocabulary) for _ in range(30)]
    for i in range(12):  # groups of near copies, some at the edge of 0.8; all share a passage
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 40, 90]))] + common
        for j in range(rng.choice([1, 3, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((1000 + 20 * i + j, " ".join(own)))
    got = jaccard_join.similar_groups(hard.table(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    hard.same(got, hard.components(rows))


def test_drop_similar_keeps_one_of_each_group(spark):
    rows = sorted({r for r in hard.ROWS if r[0] is not None}, key=repr)
    docs = hard.table(spark, rows)
    out = jaccard_join.drop_similar(docs)
    assert out.columns == docs.columns
    want = [(i, t) for (i, t), (_, n, c) in zip(rows, hard.components(rows), strict=True) if i == c]
    hard.same(out.select("doc_id", "text").collect(), want)


def small(rows):
    return [(i, t[:900] if t else t) for i, t in rows]


@pytest.mark.parametrize("flush", [4 << 20, 700])
def test_repeated_bytes(spark, monkeypatch, flush):
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", flush)
    monkeypatch.setattr(suffix_dedup, "BATCH", 1 << 17 if flush > 700 else 40)
    rng = random.Random(flush)
    rows = small(hard.ROWS)
    passages = ["".join(rng.choice("abcd \n") for _ in range(rng.choice([49, 50, 51, 120, 300]))) for _ in range(6)]
    for i in range(60):
        rows.append((rng.choice([100 + i, 100 + i, 120]), "".join(rng.choice([*passages, "ab" * 30, "".join(rng.choice("abcdef ") for _ in range(40))]) for _ in range(4))))
    got = suffix_dedup.repeated_bytes(hard.table(spark, rows))
    hard.same(got.drop("spans").collect(), hard.without_repeats(rows))
    assert got.filter("n_spans <> size(spans)").count() == 0


def test_segments_that_share_half_a_hash_stay(spark, monkeypatch):
    def clashing(*args, own=suffix_dedup.segments):
        *rest, whole = own(*args)
        return *rest, whole & suffix_dedup.U(0xFFFFFFFF)

    monkeypatch.setattr(suffix_dedup, "segments", clashing)
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", 700)
    rng = random.Random(12)
    middle = "".join(rng.choice("abcdefghij ") for _ in range(40))
    rows = [(i, "".join(rng.choice("abcdefghij ") for _ in range(60)) + middle + "".join(rng.choice("abcdefghij ") for _ in range(60))) for i in range(40)]
    got = suffix_dedup.repeated_bytes(hard.table(spark, rows))
    hard.same(got.drop("spans").collect(), hard.without_repeats(rows))


def test_empty_tables(spark):
    docs = hard.table(spark, [])
    assert exact_dedup.exact_groups(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0
    assert jaccard_join.similar_groups(docs).count() == 0 and suffix_dedup.repeated_bytes(docs).count() == 0
