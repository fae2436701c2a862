"""Similarity operators against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import common, decontaminate, prefix_tree, spotsigs
from adlake.llm.prefix_tree import Trie, forest


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            same = len(x & y)
            if x and y and 100 * same >= 80 * (len(x) + len(y) - same):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {(i, len(s), find(i)) for i, s in sets}


def near_copies(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows, common = [], rng.choices(words, k=60)
    for i in range(n):
        if i and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.choice((0, 1, 1, 2, 5))):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = rng.choices(words, k=rng.randrange(3, 150)) + (common if rng.random() < 0.4 else [])
        rows.append((i, " ".join(w)))
    return rows


def test_prefix_tree_join(documents):
    rows = near_copies(300, 3)
    got = prefix_tree.near_components(documents(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


def test_prefix_tree_join_cuts_large_groups(documents, monkeypatch):
    monkeypatch.setattr(prefix_tree, "GROUP_VALUES", 500)
    rows = near_copies(200, 4)
    got = prefix_tree.near_components(documents(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


def test_prefix_tree_join_odd_rows(odd, empty):
    got = sorted(map(tuple, prefix_tree.near_components(odd).collect()), key=str)
    by_key = {r[0]: r[1:] for r in got}
    assert len(got) == 10 and by_key[1] == (0, 1) and by_key[2] == (0, 2) and by_key[3] == (0, 3)
    assert by_key[4] == (1, 4) and by_key[5] == (1, 4) and by_key[7] == (3, 7) and by_key[None][1] is None
    assert prefix_tree.near_components(empty).count() == 0


def brute_by_key(rows):
    """As ``brute_components``, where rows of one key are one node."""
    by_place = {k: root for k, _, root in brute_components([(k, t) for k, (_, t) in enumerate(rows)])}
    key_of = {k: i for k, (i, _) in enumerate(rows)}
    near = [(key_of[k], key_of[root]) for k, root in by_place.items()]
    root = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    return sorted((i, len(shingle_set(t)), root[i]) for i, t in rows)


def test_prefix_tree_join_keeps_the_links_of_all_texts_of_a_key(documents, monkeypatch):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(3, a), (5, a), (5, b), (7, f"{b} end"), (5, b), (5, b.upper())]
    assert {r[2] for r in prefix_tree.near_components(documents(rows)).collect()} == {3}
    monkeypatch.setattr(prefix_tree, "GROUP_VALUES", 300)
    rows = [(i % 70 if i % 3 else 11, t) for i, t in near_copies(200, 6)]
    got = sorted(tuple(r) for r in prefix_tree.near_components(documents(rows)).collect())
    assert got == brute_by_key(rows)


@pytest.mark.parametrize("tasks, held", [(1, 1 << 19), (1, 50), (7, 1 << 19)])
def test_components(spark, monkeypatch, tasks, held):
    rng = random.Random(tasks + held)
    way = [(i, i + 1) for i in range(500)]
    edges = [*way, *((600 + rng.randrange(300), 600 + rng.randrange(300)) for _ in range(150)), (1000, 1000), (None, 5), (-7, 2000)]
    rng.shuffle(edges)
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root.get(a, a), root.get(b, b)))
            root |= {n: low for n in (a, b, *(n for n, r in root.items() if r == high))}
    steps, plain = [], common.written
    monkeypatch.setattr(common, "written", lambda df, label: (steps.append(label), plain(df, label))[1])
    monkeypatch.setattr(common, "EDGES", held)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many tasks as asked for
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = common.components(spark.createDataFrame(edges, "a long, b long"), "tested").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(root) and {tuple(r) for r in got} == set(root.items())
    assert len(steps) == 1 or tasks > 1 or held < 1 << 19  # edges of one task need no round


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([(1, 1)], "a long, b long"), "tested").count() == 0


def test_trie_finds_all(seed=5):
    rng = np.random.default_rng(seed)
    base = rng.choice(200, 40, replace=False)
    sets = [np.unique(np.concatenate([rng.choice(base, 36, replace=False), rng.integers(200, 400, 5)])).astype(np.uint32) for _ in range(80)]
    trie = Trie(sets)
    for s in sets:
        want = {j for j, t in enumerate(sets) if 9 * len(np.intersect1d(s, t)) >= 4 * (len(s) + len(t))}
        assert set(trie.alike(s, 400, 4, 5)) == want
    assert len(forest([s.astype(np.uint64) for s in sets], None, 4, 5)) < len(sets)


ITEMS = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (1, "one two three"),
         (2, "Große Straße über alle Berge hinweg und weiter hinaus ins Land"), (3, None), (4, "")]


def test_decontamination(spark, documents):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    filler = " ".join(f"f{k}" for k in range(400))
    rows = [(1, f"{filler} {ITEMS[0][1]}. {filler}"), (2, filler), (3, f"x {ITEMS[0][1].upper()} y {ITEMS[0][1]}"),
            (4, "one, two, three!"), (5, "zero one two three"), (6, "GROSSE STRASSE ÜBER ALLE BERGE HINWEG UND WEITER HINAUS INS LAND"),
            (7, f"a beta gamma delta epsilon zeta eta theta iota kappa lambda mu {filler}"), (8, "alpha beta gamma delta epsilon")]
    docs = documents(rows)
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["start_word"]) for r in found} == {(1, 0, 400), (3, 0, 1), (3, 0, 14), (4, 1, 0), (6, 2, 0)} \
        | {(r["doc_id"], r["item_id"], r["start_word"]) for r in found if r["doc_id"] == 7}
    assert all(r["similarity"] >= 0.8 for r in found)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {r["doc_id"] for r in found}


def test_decontamination_of_texts_shorter_than_the_item(spark, documents):
    words = [f"w{k}" for k in range(59)]
    bench = spark.createDataFrame([(0, " ".join(words)), (1, "b1 b2 b3 b4 b5 b6 b7 b8 b9")], "item_id long, text string")
    rows = [(1, words[:-1]), (2, words[1:]), (3, words[:48]), (4, words[:47]), (5, words), (6, words[20:24]), (7, [f"b{k}" for k in range(1, 8)])]
    found = decontaminate.contaminated(documents([(i, " ".join(w)) for i, w in rows]), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["start_word"], r["n_words"], r["similarity"]) for r in found} == {
        (1, 0, 0, 58, 54 / 55), (2, 0, 0, 58, 54 / 55), (3, 0, 0, 48, 44 / 55), (5, 0, 0, 59, 1.0)}
    assert {r["doc_id"] for r in decontaminate.clean(documents([(i, " ".join(w)) for i, w in rows]), bench).collect()} == {4, 6, 7}


def test_decontamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.clean(odd, bench).count() == 10 and decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.clean(empty, bench).count() == 0
    assert decontaminate.clean(odd, bench.limit(0)).count() == 10


def test_multi_index_finds_all_within_the_radius():
    index = decontaminate.ItemIndex(list(range(40)), [" ".join(f"i{i}w{k}" for k in range(20)) for i in range(40)])
    rng = np.random.default_rng(1)
    for item in range(40):
        flips = rng.choice(64, decontaminate.RADIUS, replace=False)
        near = index.prints[item] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        _, items, apart = index.near(np.array([near]), 20)
        assert item in items and (apart <= decontaminate.RADIUS).all()


def test_spotsigs(documents, odd, empty):
    rows = [(5, "The cat of my house sat on a warm mat near the old door"), (2, "the cat of my house sat on a warm mat near the old door!"),
            (9, "ein ganz anderer Text von der Straße"), (11, None)]
    got = {r["doc_id"]: r for r in spotsigs.fingerprints_of_edits(documents(rows)).collect()}
    assert got[5]["fingerprint"] == got[2]["fingerprint"] and got[2]["near_next"] == 1.0 and got[5]["near_next"] < 0.2
    assert got[11]["n_chars"] == 0 and all(0 <= r[c] <= 1 for r in got.values() for c in ("near_edited", "near_next"))
    assert spotsigs.fingerprints_of_edits(odd).count() == 10 and spotsigs.fingerprints_of_edits(empty).count() == 0


def brute_signatures(text, anchors, chain=2):
    w = re.findall(r"[^\W_]+", text.lower())
    found = {("^", *[x for x in w if x not in anchors][:chain])} if w else set()
    for i, x in enumerate(w):
        if x in anchors and (after := [y for y in w[i + 1:] if y not in anchors][:chain]):
            found.add((x, *after))
    at = 0
    for is_anchor, run in itertools.groupby(w, lambda x: x in anchors):
        run = list(run)
        at += len(run)
        if not is_anchor and (len(run) >= spotsigs.STRETCH or len(run) == len(w)):
            found |= {tuple(run[i:i + chain + 1]) for i in range(len(run))}
    return found


def test_spotsigs_see_the_whole_text(documents):
    tail = " ".join(f"x{k}" for k in range(30))
    rows = [(k, f"so k{k} but l{k}, so m{k}") for k in range(100, 140)] + [
        (1, "alfa beta " + tail), (2, "alfa beta " + tail.replace("x", "z")), (3, "so n1 but n2 " + tail), (4, "so n1 but n2 " + tail[:-6] + "y y"),
        (5, "uno dos tres"), (6, "uno dos tres quatro")]
    docs = documents(rows)
    words = spotsigs.common_words(docs)
    assert {"so", "but"} <= set(words)
    sets = {r["doc_id"]: r["n"] for r in docs.selectExpr("doc_id", "text").withColumn("n", F.size(spotsigs.signatures(F.col("text"), words))).collect()}
    brute = {i: brute_signatures(t, set(words)) for i, t in rows}
    assert sets == {i: len(b) for i, b in brute.items()}
    got = {r["doc_id"]: r for r in spotsigs.fingerprints_of_edits(docs).collect()}
    assert len({got[i]["fingerprint"] for i in range(1, 7)}) == 6
    for i in range(1, 6):
        assert got[i]["near_next"] == pytest.approx(len(brute[i] & brute[i + 1]) / len(brute[i] | brute[i + 1]))
    assert all(got[i]["near_edited"] < 1 for i in range(1, 5))


def test_next_rows_are_in_order(documents, monkeypatch):
    monkeypatch.setattr(spotsigs, "MIN_BLOCKS", 7)
    rows = [(i * i, f"t{i}") for i in range(100)]
    got = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(documents(rows)).collect()}
    assert got == {i * i: f"t{(i + 1) % 100}" for i in range(100)}


def test_spotsigs_groups(documents):
    text = " ".join(f"the w{k} x{k} of" for k in range(40))
    rows = [(1, text), (2, text), (3, text + " the last word"), (4, " ".join(f"and y{k} z{k}" for k in range(40))), (5, None)]
    got = {r["doc_id"]: r["group"] for r in spotsigs.near_groups(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


@pytest.mark.parametrize("text, n", [("", 0), ("word", 1), ("the the the", 3)])
def test_short_signatures(spark, text, n):
    from pyspark.sql import functions as F
    assert len(spark.range(1).select(spotsigs.signatures(F.lit(text))).first()[0]) <= n + 1
