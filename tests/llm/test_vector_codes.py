"""Vector codes against a plain version in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from seriesprep.llm import vector_codes as vc

NAN, INF = float("nan"), float("inf")
EXTRA = ["_id", "_label", "_vector", "code", "error", "slot", "_salt"]


def plain(rows, entries=16, parts=8, rounds=6):
    kept = [(i, [math.floor(x * 4096) if abs(x) < 2**52 else int(x) * 4096 for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    step = len(kept[0][1]) // parts
    cut = [[v[p * step : (p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0], rows.index(next(r for r in rows if r[0] == kept[k][0]))))[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((away(c[p], e), j) for j, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for j in range(len(first)):
                own = [c[p] for c, g in zip(cut, got, strict=True) if g[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    got = assign()
    errors = [sum(d for d, _ in g) for g in got]
    by_label = {}
    for (_, _, g), e in zip(kept, errors, strict=True):
        by_label[g] = by_label.get(g, 0) + e
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{j:02x}" for _, j in g), e, by_label[la]) for (i, _, la), g, e in zip(kept, got, errors, strict=True)), digest


def made(spark, rows, kind="double"):
    full = [(*r, *[f"{c}-{k}" for c in EXTRA]) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, f"vec_id LONG, embedding ARRAY<{kind}>, label INT, " + ", ".join(f"`{c}` STRING" for c in EXTRA)).repartition(5)


def result(spark, rows, **kw):
    out, books = vc.compress(made(spark, rows), **kw)
    return sorted(map(tuple, out.collect())), books.digest()


def vectors(seed, n, size, scale=1.0):
    rng = random.Random(seed)
    return [(i * 3 - 20, [rng.gauss(0, scale) for _ in range(size)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("scale", [0.2, 300.0, 1e5, 1e9])
def test_codes_equal_plain_ones(spark, scale):
    rows = vectors(1, 150, 16, scale) + [(5000, None, 1), (5001, [NAN] * 16, 1), (5002, [0.1] * 15 + [None], 2), (5003, [INF] + [0.0] * 15, 2)]
    want, digest = plain(rows)
    got, found = result(spark, rows)
    assert found == digest
    long = lambda e: e if e < 2**63 else None
    assert [g[:3] for g in got] == [(*w[:2], long(w[2])) for w in want]
    if scale < 1e8:  # beyond, some errors are null and have no part in the sums
        assert [g[3] for g in got] == [long(w[3]) for w in want]


def test_ties_repeats_and_few_rows(spark):
    same = [(i, [0.5, -0.25] * 4, None) for i in range(40)] + [(100 + i, [float(i % 2)] * 8, 3) for i in range(10)]
    assert result(spark, same) == plain(same)
    few = vectors(2, 5, 8)
    assert result(spark, few) == plain(few)
    twice = vectors(3, 30, 8)
    got, _ = result(spark, twice + twice)
    assert len(got) == 60 and got[::2] == got[1::2]


def test_other_lengths_and_empty_tables(spark):
    rows = vectors(4, 30, 16)
    assert result(spark, rows + [(900, [1.0] * 8, 1), (901, [], 1)]) == result(spark, rows)
    odd = vectors(5, 30, 13)
    assert result(spark, odd) == result(spark, odd) and len(result(spark, odd)[0]) == 30
    out, _ = vc.compress(made(spark, []))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error"]
    assert result(spark, [(1, [], 2), (2, [], 2)])[0] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    nulls = [(None, v, g) for _, v, g in vectors(6, 20, 8)]
    assert len(result(spark, nulls)[0]) == 20


def test_codes_do_not_depend_on_partitions(spark):
    rows = vectors(7, 400, 16)
    df = made(spark, rows)
    one, a = vc.compress(df.coalesce(1))
    many, b = vc.compress(df.repartition(23))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and a.digest() == b.digest()


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    rows = vectors(8, 60, 8)
    want = result(spark, rows)
    monkeypatch.setattr(vc, "MOST_LABELS", 1)
    assert result(spark, rows) == want


def test_limb_product_is_exact():
    rng = np.random.default_rng(0)
    for bits in (5, 20, 28):
        a, b = (rng.integers(-(2**bits), 2**bits, s) for s in ((40, 33), (33, 16)))
        assert (vc.limb_product(a, b) == (a.astype(object) @ b.astype(object))).all()
