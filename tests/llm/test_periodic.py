"""Periodic runs against a plain search over all periods and starts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from adlake.llm import periodic


def brute_runs(words):
    """All runs, by their definition: for every period the maximal stretches that keep it."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - first
            if length >= max(6, 4 * q):
                found.setdefault((first, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_row(doc_id, text):
    words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in text or "").split(" ") if w]
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{length},{q}\n" for s, length, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *sha)


def random_text(rng):
    out = []
    while len(out) < rng.choice((3, 20, 80, 300)):
        piece = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.randint(1, 12))]
        out += piece * rng.choice((1, 1, 2, 5, 9))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(60)] + [[], [1], [1] * 5, [1] * 6, [1, 2] * 4, [5] * 700]
    rng.shuffle(texts)
    ptr = np.cumsum([0, *map(len, texts)])
    text, start, length, period = periodic.runs(np.array([x + 1 for t in texts for x in t]), ptr)
    got = [[] for _ in texts]
    for k, *run in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        got[k].append(tuple(run))
    assert got == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_extensions(seed):
    rng = np.random.default_rng(seed)
    texts = [np.tile(rng.integers(1, 4, k), 30)[:n] for k, n in ((1, 40), (5, 130), (29, 200), (64, 0), (100, 90))]
    ids, ptr = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    pairs = [(a, b) for lo, hi in zip(ptr[:-1], ptr[1:]) for a in range(lo, hi) for b in range(a + 1, hi)]
    i, j = np.array(pairs).T
    end = ptr[np.searchsorted(ptr, i, "right")]
    want = [next((h for h in range(e - b) if ids[a + h] != ids[b + h]), e - b) for a, b, e in zip(i, j, end)]
    assert periodic.Extensions(ids, ptr)(i, j).tolist() == want


def test_chunks_of_grids_change_nothing(monkeypatch):
    rng = random.Random(9)
    texts = [random_text(rng) for _ in range(20)]
    ids, ptr = np.array([x + 1 for t in texts for x in t]), np.cumsum([0, *map(len, texts)])
    whole = [x.tolist() for x in periodic.runs(ids, ptr)]
    monkeypatch.setattr(periodic, "PAIRS", 5)
    assert [x.tolist() for x in periodic.runs(ids, ptr)] == whole


def test_digests(spark, documents, odd, empty):
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{x}" for x in random_text(rng))) for i in range(80)]
    rows = docs + [(200 + i, " ".join(f"w{x}" for x in range(90))) for i in range(40)] + [(7, "Aa aA Aa aA x \x0b\x0c\x1f b")]
    for frame in (documents(rows), odd):
        got = [tuple(r) for r in periodic.digests(periodic.periodic(frame, plant=True)).collect()]
        want = [brute_row(r["doc_id"], r["text"]) for r in frame.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.digests(periodic.periodic(empty)).count() == 0
    clash = odd.selectExpr("*", "1 as runs", "'x' as collapsed", "2 as start")
    assert periodic.periodic(clash).columns == ["doc_id", "runs", "collapsed"] and periodic.periodic(clash).count() == odd.count()


def test_a_long_text_is_linear_enough(spark, documents):
    words = [f"w{random.Random(3).randrange(50)}" for _ in range(1)] + [f"w{i % 977}" for i in range(300_000)]
    row = periodic.periodic(documents([(1, " ".join(words))])).collect()[0]
    assert [tuple(r) for r in row["runs"]] == brute_long(words)


def brute_long(words):
    """One run of period 977 from the first word of the cycle on."""
    first = 0 if words[0] == words[977] else 1
    return [(first, len(words) - first, 977)]
