"""Conversation repair against a search over all edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from adlake.llm import repair

SPACES = " \t\n\v\f\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        h = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
    return out


def brute_edits(rows):
    """Least (cost, letters) by a search from the front, and the rows they give. ``rows`` are
    (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, seen, made = heapq.heappop(heap)
        last = seen[-1:]
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", seen):
            return cost, audit, list(made)
        due = "assistant" if last == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, seen + due[0], (*made, (due, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, seen, made))
        if fault in ("blank", "duplicate"):
            continue
        more = int(fault == "truncated")
        for new, extra, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
            if new and re.fullmatch("(s?(ua)*u?)?", seen + new[0]):
                heapq.heappush(heap, (cost + extra + more, audit + letter, i + 1, seen + new[0], (*made, (new, text))))


def brute_report(rows):
    """What ``report`` gives, of undamaged rows (conv, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in brute_damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        marked, before = [], set()
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in before else "truncated" if bare[-1] not in ".!?" else None
            before.add((role, text))
            marked.append((role, text, fault))
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, made = brute_edits(marked)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in made))
        n = [sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, *n, bad, cost, audit, sha))
    return sorted(out, key=str)


def random_rows(rng, conversations, turns):
    texts = ["Yes.", "No!", "why", "and then  ", "", " \t\n", "So? ", "x" * 3000 + ".", None, "é . "]
    rows = []
    for conv in conversations:
        for turn in range(rng.randint(1, turns)):
            role = rng.choice(("user", "assistant")) if rng.random() < 0.5 else ("user", "assistant")[turn % 2]
            role = rng.choice(("system", "tool", "", None, "assistant")) if rng.random() < 0.15 else role
            text = rng.choice(texts) if rng.random() < 0.5 else f"Line {rng.random()}."
            rows.append((conv, rng.choice((turn, turn, turn, turn + 2, None)), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, place string")


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_report(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rows = random_rows(random.Random(bits), [*range(60), None, -5], 12)
    rows += rows[:5] + [(900, 1, "user", "Hi."), (900, 2, "assistant", "Hi.")]
    table = frame(spark, rows)
    got = repair.report(table, repair.damaged(table))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_report(rows)


def test_one_long_conversation(spark):
    """Far more rows than a segment has, all with a null key."""
    rng = random.Random(8)
    rows = [(None, t, rng.choice(("user", "assistant", "system")), rng.choice(("Yes.", "no", f"{t}."))) for t in range(3000)]
    table = frame(spark, rows)
    got = repair.report(table, repair.damaged(table)).collect()
    assert [tuple(r) for r in got] == brute_report(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Why"), (1, 3, "user", "Why"), (2, None, "user", " ")]
    found = repair.repair(frame(spark, rows))
    assert [tuple(r)[2:] for r in found.rows.where("conv = 1").collect()] == [
        (0, "K", "system", "Be kind."), (None, "I", "user", ""), (1, "K", "assistant", "Hi.")]
    assert tuple(found.edits.where("conv = 1").first()) == (1, 8, "KIKDD")  # to keep "Why" and answer it costs as much
    assert found.rows.where("conv = 2").count() == 0
    assert {r["audit"] for r in found.edits.where("conv = 2").collect()} == {"D"}


def test_no_rows(spark):
    table = frame(spark, [(1, 0, "user", "Hi.")])
    none = table.limit(0)
    assert repair.report(none, none).count() == 0
    row = repair.report(table, none).first()
    assert row["audit"] == "" and row["cost"] == 0 and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_nodes_are_made_once_per_suffix():
    path = repair.Path()
    signatures = sorted("".join(random.Random(k).choices("uaUx", k=k % 9)) for k in range(400))
    for backwards in signatures:
        path.node(repair.FINAL, backwards)
    assert path.made == len({s[:k] for s in signatures for k in range(1, len(s) + 1)})
