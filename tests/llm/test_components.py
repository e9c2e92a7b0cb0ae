"""Connected components against a plain walk."""

import random

import pytest

from seriesprep.llm.components import connected_components


def walk(links):
    near, out = {}, {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


@pytest.mark.parametrize("task_rows", [1_000, 20])
def test_components(spark, task_rows):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(90)]
    links += [(400, k) for k in range(401, 440)] + [(7, 7), (3, 4), (4, 3)]
    rng.shuffle(links)
    got = connected_components(spark.createDataFrame(links, "a LONG, b LONG").repartition(7), task_rows)
    rows = [tuple(r) for r in got.collect()]
    want = walk([x for x in links if x[0] != x[1]])
    assert len(rows) == len(want) and dict(rows) == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0
