"""Exact top-k search against all pairs."""

import math
import random

import numpy as np
import pytest

from adlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(whole):
        if i is None or i % 20:
            continue
        scores = [(-max(-(1 << 63) + 1, min((1 << 63) - 1, sum(a * b for a, b in zip(v, w)))), j is None, j or 0, j)
                  for m, (j, w) in enumerate(whole) if m != n]
        out += [(i, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:20])]
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA).repartition(parts)
    got = topk.top_k(frame)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def near(rng, center):
    return [c + rng.gauss(0, 0.1) for c in center]


def clustered(rng):
    centers = [[rng.gauss(0, 1) for _ in range(70)] for _ in range(6)]
    rows = [(i, near(rng, centers[i % 6])) for i in range(400)]
    return rows + [(1000 + i, rows[0][1]) for i in range(60)] + rows[:3]  # ties and repeated rows


@pytest.mark.parametrize("parts", [1, 30])
def test_top_k(spark, monkeypatch, parts):
    monkeypatch.setattr(topk, "GROUP_QUERIES", 8)
    monkeypatch.setattr(topk, "SLICE_BLOCKS", 1)
    check(spark, clustered(random.Random(3)), parts)


@pytest.mark.parametrize("sizes", [(512, 0.1, 1 << 15), (3, 0.1, 7), (16, 1.0, 100), (16, -1.0, 100)])
def test_search(monkeypatch, sizes):
    for name, value in zip(("CHUNK", "SPARSE", "PIECE_PAIRS"), sizes, strict=True):
        monkeypatch.setattr(topk, name, value)
    vectors = np.floor(np.array([v for _, v in clustered(random.Random(6))]) * 64)
    n = len(vectors)
    cut = [range(a, min(a + 50, n)) for a in range(0, n, 50)]

    def record(k):
        own = vectors[cut[k]]
        return {"block": k, "n": len(own), "dims": 70, "dtype": "float64", "ids": np.array(cut[k]).tobytes(),
                "places": np.arange(len(own)).tobytes(), "vectors": own.tobytes()}

    search = topk.Search(7)
    for k in (2, 5):
        search.add_queries(record(k))
    search.start()
    for k in range(len(cut)):
        search.show(record(k))
    exact = vectors @ vectors.T
    want = []
    for q, row in enumerate([*cut[2], *cut[5]]):
        order = sorted((j for j in range(n) if j != row), key=lambda j: (-exact[row, j], j))[:7]
        want += [(q, int(exact[row, j]), j) for j in order]
    assert [tuple(x) for x in search.best[:3].T.tolist()] == want


def test_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice((0, 1, 5, 17, 64, 65)))]) for i in range(60)]
    rows += [(0, None), (20, [1.0, None]), (40, [float("nan")]), (60, [float("inf"), 1.0]), (80, [0.5, 0.5]), (None, [1.0, 2.0]),
             (100, []), (120, [1e30, -1e30, 3.0]), (121, [1e30, 1e30]), (140, [1e8] * 64), (141, [1e8] * 64)]
    check(spark, rows)
    check(spark, [(20, [1.0])])
    check(spark, [(1, [1.0]), (2, [1.0])])
    check(spark, [])


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    a = np.floor(rng.normal(size=(50, 70)) * 20 + rng.normal(size=(50, 1)) * 30)
    exact = a @ a.T
    last = None
    for length in topk.LEVELS:
        s = topk.statistics(a, length)
        bound = s @ s.T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.sum() <= last
        last = bound.sum()
    search = topk.Search(5)
    records = [{"kind": 2, "block": b, "n": 200, "dims": 70, "dtype": "float64", "ids": np.arange(200).tobytes(), "places": b"",
                "vectors": np.floor(rng.normal(size=(200, 70)) * 5 + (100 if b == 0 else 0)).tobytes()} for b in range(9)]
    search.add_queries({**records[0], "n": 1, "vectors": np.full(70, 100.0).tobytes(), "places": np.zeros(1, np.int64).tobytes()})
    search.start()
    for r in records:
        search.show(r)
    assert search.exact == 199  # only the block with the like vectors is multiplied
