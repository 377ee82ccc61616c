"""op2: what is dealt to tasks, and its kernel against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from smelter.llm import topk_segments


def test_candidates_are_dealt_once_and_queries_once_a_group(spark):
    """Rows to shuffle grow with candidates and with groups of them, not with blocks of candidates times blocks of queries."""
    r = np.random.default_rng(5)
    table = spark.createDataFrame([(k, r.normal(size=6).tolist()) for k in range(900)], "vec_id long, embedding array<double>")
    numbers = topk_segments.usable(table)
    known = topk_segments._packed(numbers, ["vec_id"], 10).localCheckpoint()
    packed = topk_segments._packed(numbers.where("vec_id % 100 = 0"), ["vec_id"], 1).localCheckpoint()
    assert known.count() >= 90 and packed.count() == 9
    rows = topk_segments.dealt(known, packed, 4).groupBy("asks", "part", "at").agg(F.count("*").alias("n"), F.countDistinct("g").alias("g")).collect()
    assert {(x.asks, x.n, x.g) for x in rows} == {(False, 1, 1), (True, 4, 4)}
    assert sum(x.n for x in rows) == known.count() + 4 * 9


def test_nearest_against_brute_force(monkeypatch):
    """Ties, equal vectors, ids given twice, large and narrow numbers, tiles that follow one another."""
    r = np.random.default_rng(6)
    monkeypatch.setattr(topk_segments, "SEEDS", 20)
    monkeypatch.setattr(topk_segments, "TILE", 64)
    monkeypatch.setattr(topk_segments, "PAIRS", 50)
    for trial in range(30):
        n, width, k = int(r.integers(1, 700)), int(r.choice([1, 3, 8, 40])), int(r.choice([1, 4, 11]))
        reach = int(r.choice([1, 3, 1000, 2**28]))
        m = r.integers(-reach, reach + 1, (n, width))
        m[r.random(n) < r.choice([0, 0.5])] = m[0]
        ids = r.integers(0, n, n)
        q = np.concatenate([m[::9], np.zeros((1, width), dtype=np.int64), r.integers(-reach, reach + 1, (5, width))])
        where, scores, found = topk_segments.nearest(q, topk_segments.prepared(ids, topk_segments._narrow(m), k), k)
        for x in range(len(q)):
            want = sorted(zip((-(m @ q[x])).tolist(), ids.tolist()))[:k]
            assert list(zip((-scores[where == x]).tolist(), found[where == x].tolist())) == want


def test_equal_vectors_take_no_more_room_than_the_best():
    """A vector that a third of all rows have is looked at k times a group."""
    m = np.concatenate([np.ones((1000, 4), dtype=np.int16), np.arange(8000, dtype=np.int16).reshape(2000, 4)])
    ids = np.random.default_rng(7).permutation(3000)
    kept = topk_segments.prepared(ids, m, 11)
    assert len(kept.ids) == 2011 and kept.ids[(kept.m == 1).all(axis=1)].tolist() == sorted(ids[:1000].tolist())[:11]
