"""Conversation structure repair: the cheapest edits that give well-formed conversations.

A conversation is well formed if its role initials are ``(s?(ua)+)?``. Rows are kept (K, free),
given the role user or assistant (R, 2), deleted (D, 3; a must for blank and repeated rows),
or inserted with an empty text (I, 2); a cut-off row that is not deleted costs 1 more. Of the
cheapest edits those whose letters, in order, come first in ASCII are taken.

Method
  * A row is one letter of its conversation's signature: its role's initial, in capitals if it
    is cut off, or x if it must go. What the rows say besides does not matter to the edits.
  * Signatures share their ends in an automaton whose nodes are the different suffixes: sorted
    by their reversed text, each signature shares with the one before it a path from the end,
    and only the rest of it makes new nodes. A node holds, for every grammar state, the cost
    to go and the best edits from there, so these are found once per suffix and state, for all
    conversations together. A task keeps one path. Each letter leads to one state, so the
    first letter among the cheapest is the first text, too.
  * Signatures are cut into segments of at most SEGMENT rows by their place in the sorted
    table, so a conversation of any length is spread over tasks. Segments of one conversation
    meet through four numbers, the costs to go at their border: backwards for the costs,
    forwards for the states, one segment at a time.
  * A row is a repeat if it is not the first of its conversation, role and text; firsts are
    found by a grouped minimum of places and joined by place, so no key is hot.

Defined cases: rows come by turn, null turns first, then by role and text; null roles and
texts are one space; rows with a null conversation are one conversation with a null key. An
empty role has no initial and cannot be kept. An empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from adlake.llm.common import in_batches, written

SEGMENT_BITS = 10
SEGMENT = 1 << SEGMENT_BITS  # rows of a segment, at most
TEXT_KEY = 64  # code points of a text that part rows with one turn and role into ranges
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
LEGAL = ("su", "ua", "au")
FAR = 1 << 40  # no way
_NO_KEY = -(1 << 63)
_SPACE = r"\x20\x09-\x0D"

# Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a. An insertion or a new role is
# the initial that must come next; at the beginning u.
START, STATES = 0, 4
NEXT = (2, 2, 3, 2)
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, FAR, FAR, 0)  # cost of stopping
ROLE_OF = {2: "user", 3: "assistant"}
GONE = "x"
FINAL = ""  # the ending of a conversation's last segment


# --- the automaton -------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """A suffix, by grammar state: cost to go, edits of its rows, state behind its rows."""

    cost: tuple[int, ...]
    edits: tuple[str, ...]
    state: tuple[int, ...]


def _node(ways: list[list[tuple[int, str, str, int]]]) -> Node:
    """The node whose ways on, without insertions, are (cost, letter, edits, state) by state."""
    cost = [min((w[0] for w in some), default=FAR) for some in ways]
    for _ in range(STATES):
        cost = [min(c, INSERT + cost[NEXT[s]], FAR) for s, c in enumerate(cost)]
    edits, state = [""] * STATES, list(range(STATES))
    for s in sorted(range(STATES), key=cost.__getitem__):  # an insertion leads to a cheaper state
        if cost[s] == FAR:
            continue
        to = NEXT[s]
        ties = [w[1:] for w in ways[s] if w[0] == cost[s]]
        if INSERT + cost[to] == cost[s]:
            ties.append(("I", "I" + edits[to], state[to]))
        _, edits[s], state[s] = min(ties, key=lambda w: w[0])
    return Node(tuple(cost), tuple(edits), tuple(state))


def leaf(ending: str) -> Node:
    """The empty suffix: the conversation's end, or the costs to go at a segment's border."""
    if ending == FINAL:
        return _node([[(cost, "", "", s)] if cost < FAR else [] for s, cost in enumerate(ENDS)])
    return Node(tuple(map(int, ending.split(","))), ("",) * STATES, tuple(range(STATES)))


def before(letter: str, node: Node) -> Node:
    """The node of a suffix that is one row longer."""
    def way(cost, edit, to):
        return cost + node.cost[to], edit, edit + node.edits[to], node.state[to]

    extra = CUT_OFF if letter.isupper() else 0
    ways = []
    for s in range(STATES):
        some = [way(DELETE, "D", s)]
        if letter != GONE:
            some.append(way(REROLE + extra, "R", NEXT[s]))
            if (to := KEEP[s].get(letter.lower())) is not None:
                some.append(way(extra, "K", to))
        ways.append(some)
    return _node(ways)


class Path:
    """One path of the automaton, from the end; the next signature reuses what it shares."""

    def __init__(self):
        self.ending, self.shown, self.nodes, self.made = None, "", [], 0

    def node(self, ending: str, backwards: str) -> Node:
        if ending != self.ending:
            self.ending, self.shown, self.nodes = ending, "", [leaf(ending)]
        same = len(os.path.commonprefix((self.shown, backwards)))
        del self.nodes[same + 1:]
        for letter in backwards[same:]:
            self.nodes.append(before(letter, self.nodes[-1]))
        self.made += len(backwards) - same
        self.shown = backwards
        return self.nodes[-1]


_SOLVED = "ending string, backwards string, bucket int, cost array<long>, edits array<string>, state array<int>"


def solved(wanted: DataFrame) -> DataFrame:
    """Nodes of the different (ending, backwards, bucket) of ``wanted``; backwards is a signature
    from its end."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Path()
        for batch in batches:
            nodes = [path.node(e, b) for e, b in zip(*(batch.column(c).to_pylist() for c in ("ending", "backwards")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("ending", "backwards", "bucket")), pa.array([n.cost for n in nodes], pa.list_(pa.int64())),
                 pa.array([n.edits for n in nodes], pa.list_(pa.string())), pa.array([n.state for n in nodes], pa.list_(pa.int32()))],
                names=["ending", "backwards", "bucket", "cost", "edits", "state"])

    keys = ["ending", "backwards", "bucket"]
    paths = wanted.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    return in_batches(paths).mapInArrow(per_task, _SOLVED)


# --- rows and faults -----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults by the crc32 of ``conv_id:turn``: of 20 remainders, 0 drops a row,
    1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fault.alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("_fault != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")) \
        .drop("_time")


def _key() -> Column:
    return F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_KEY)).alias("conv")


def placed(conversations: DataFrame) -> DataFrame:
    """All rows in order, written with their ``place`` in the table and what their text shows."""
    rows = conversations.select(
        _key(), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    ordered = rows.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(TEXT_KEY))) \
        .sortWithinPartitions("conv", "turn", "role", "text")
    return written(ordered.select(
        F.monotonically_increasing_id().alias("place"), "conv", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
        (~F.col("text").rlike(f"[.!?][{_SPACE}]*\\z")).alias("open")), "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """(place, conv, turn, initial, fault, letter) of ``placed`` rows; a row's first fault is
    blank, duplicate, truncated, or null."""
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    narrow = rows.select("place", "conv", "turn", "initial", "blank", "open").join(firsts, "place", "left")
    return narrow.select("place", "conv", "turn", "initial", fault.alias("fault")).withColumn("letter", letter)


def counts(marked: DataFrame) -> DataFrame:
    """Per conversation: gaps between its turn numbers, and rows by their first fault."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return marked.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *(
        F.count_if(F.col("fault") == f).cast("long").alias(f) for f in ("blank", "duplicate", "truncated")))


def segments(marked: DataFrame) -> DataFrame:
    """(conv, seg, signature, initials): each conversation's rows, SEGMENT at most together."""
    seg = F.shiftright("place", SEGMENT_BITS).alias("seg")
    grouped = marked.groupBy("conv", seg).agg(F.sort_array(F.collect_list(F.struct("place", "letter", "initial"))).alias("rows"))
    return grouped.select("conv", "seg", F.array_join("rows.letter", "").alias("signature"), F.col("rows.initial").alias("initials"))


def illegal(cut: DataFrame) -> DataFrame:
    """Per conversation: neighbouring rows whose initials may not follow one another."""
    after = F.lead(F.get("initials", F.lit(0))).over(W.partitionBy("conv").orderBy("seg"))
    rest = F.expr("slice(initials, 2, size(initials))")
    following = F.when(after.isNull(), rest).otherwise(F.array_append(rest, after))
    pairs = F.zip_with(F.expr("slice(initials, 1, size(following))"), "following", lambda a, b: F.concat(a, b))
    wrong = F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL)))
    return cut.withColumn("following", following).groupBy("conv").agg(F.sum(wrong).cast("long").alias("illegal"))


# --- segments of one conversation ----------------------------------------------------


def _streamed(rows: DataFrame, order: Column, step, schema: str) -> DataFrame:
    """``step(record, carry) -> (out, carry)`` over each conversation's segments in order; the
    carry is None at its first. A task holds one record."""
    def per_task(batches):
        conv, carry, started = None, None, False
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if not started or r["conv"] != conv:
                    conv, carry, started = r["conv"], None, True
                made, carry = step(r, carry)
                out.append(made)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([("conv", pa.int64()), ("seg", pa.int64())] + {
        "ending": [("ending", pa.string())], "edits": [("first", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]}[schema])
    ddl = "conv long, seg long, " + {"ending": "ending string", "edits": "first int, cost long, edits string"}[schema]
    return in_batches(rows.repartition("conv").sortWithinPartitions("conv", order)).mapInArrow(per_task, ddl)


def _endings(several: DataFrame) -> DataFrame:
    """(conv, seg, ending) of the segments of conversations that have several, found from the
    last one backwards by the least costs between the states at both ends of each."""
    to = F.array(*(F.lit(",".join("0" if t == s else str(FAR) for t in range(STATES))) for s in range(STATES)))
    wanted = several.select("conv", "seg", "backwards", "bucket", F.posexplode(to).alias("to", "ending"))
    ways = wanted.join(solved(wanted), ["ending", "backwards", "bucket"])
    tables = ways.groupBy("conv", "seg").agg(F.sort_array(F.collect_list(F.struct("to", "cost"))).alias("ways"))
    closed = leaf(FINAL).cost

    def step(r, carry):
        after = closed if carry is None else carry
        cost = [min(w["cost"][s] + after[w["to"]] for w in r["ways"]) for s in range(STATES)]
        made = {"conv": r["conv"], "seg": r["seg"], "ending": FINAL if carry is None else ",".join(map(str, carry))}
        return made, [c - min(cost) for c in cost]

    return _streamed(tables, F.col("seg").desc(), step, "ending")


def _chosen(several: DataFrame) -> DataFrame:
    """(conv, seg, first, cost, edits): the edits from the state that the segment before leaves."""
    def step(r, carry):
        first = START if carry is None else carry
        last = r["state"][first]
        own = r["cost"][first] - (0 if r["ending"] == FINAL else int(r["ending"].split(",")[last]))
        return {"conv": r["conv"], "seg": r["seg"], "first": first, "cost": own, "edits": r["edits"][first]}, last

    return _streamed(several.select("conv", "seg", "ending", "cost", "edits", "state"), F.col("seg"), step, "edits")


def audits(cut: DataFrame) -> DataFrame:
    """(conv, seg, first, cost, edits): the cheapest edits of every segment, and the grammar
    state before it; written."""
    spark = cut.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = cut.select("conv", "seg", F.reverse("signature").alias("backwards"),
                       F.pmod(F.xxhash64("conv"), F.lit(buckets)).cast("int").alias("bucket"))
    sizes = cut.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    many = written(keyed.join(sizes, "conv", "left_semi"), "long-conversations")
    single = keyed.join(sizes, "conv", "left_anti").withColumn("ending", F.lit(FINAL))
    keys = ["ending", "backwards", "bucket"]
    plain = single.join(solved(single), keys).select(
        "conv", "seg", F.lit(START).alias("first"), F.get("cost", F.lit(START)).alias("cost"), F.get("edits", F.lit(START)).alias("edits"))
    if many.isEmpty():
        return written(plain, "conversation-audits")
    several = written(many.join(_endings(many), ["conv", "seg"]), "conversation-endings")
    return written(plain.unionByName(_chosen(several.join(solved(several), keys))), "conversation-audits")


# --- the repaired rows ---------------------------------------------------------------

_REPAIRED = "conv long, place long, turn long, edit string, role string, text string"


def _edited(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The rows after the edits, by conversation and in order within each partition; D rows
    are left out; an inserted one has the place of the row it comes before, or of the last."""
    kind = edits.select("conv", "seg", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("turn"),
                        F.lit(None).cast("string").alias("role"), F.col("edits").alias("text"), "first")
    seg = F.shiftright("place", SEGMENT_BITS).alias("seg")
    both = kind.unionByName(rows.select("conv", seg, "place", "turn", "role", "text", F.lit(None).cast("int").alias("first")))

    def per_task(batches):
        letters, state, tail, rows_left = iter(""), START, 0, 0
        for batch in batches:
            out = []

            def inserted(r):
                return {"conv": r["conv"], "place": r["place"], "turn": None, "edit": "I", "role": ROLE_OF[state], "text": ""}

            for r in batch.to_pylist():
                if r["place"] is None:  # a segment's edits come before its rows
                    todo, state = r["text"], r["first"]
                    tail, rows_left, letters = len(todo) - len(todo.rstrip("I")), len(todo) - todo.count("I"), iter(todo)
                    continue
                while (letter := next(letters)) == "I":
                    state = NEXT[state]
                    out.append(inserted(r))
                if letter != "D":
                    state = KEEP[state][r["role"][:1]] if letter == "K" else NEXT[state]
                    role = r["role"] if letter == "K" else ROLE_OF[state]
                    out.append({"conv": r["conv"], "place": r["place"], "turn": r["turn"], "edit": letter, "role": role, "text": r["text"]})
                rows_left -= 1
                if rows_left == 0:
                    for _ in range(tail):
                        next(letters)
                        state = NEXT[state]
                        out.append(inserted(r))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([("conv", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                       ("text", pa.string())])
    streams = both.repartition("conv").sortWithinPartitions("conv", "seg", F.col("place").asc_nulls_first())
    return in_batches(streams).mapInArrow(per_task, _REPAIRED)


@dataclass(frozen=True)
class Repair:
    """What was found and done: per conversation (conv) faults and edits, and the repaired rows."""

    faults: DataFrame
    edits: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame) -> Repair:
    """Faults (conv, gaps, blank, duplicate, truncated, illegal), edits (conv, cost, audit) and
    rows (conv, place, turn, edit, role, text). A null conversation has the smallest long."""
    rows = placed(conversations)
    marked = written(faults(rows), "conversation-faults")
    cut = written(segments(marked), "conversation-segments")
    edits = audits(cut)
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("seg", "edits")))["edits"], "")
    summary = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), audit.alias("audit"))
    return Repair(counts(marked).join(illegal(cut), "conv"), summary, _edited(rows, edits))


def text_digests(rows: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of each conversation's ``role:text`` lines, fed to the hash row by
    row. Such a hash is sequential, so a conversation is one task's; its text is never held."""
    def per_task(batches):
        conv, running = None, None
        for batch in batches:
            done = []
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
                line = f"{role}:{text}".encode()
                if running is not None and key == conv:
                    running.update(b"\n" + line)
                    continue
                if running is not None:
                    done.append((conv, running.hexdigest()))
                conv, running = key, hashlib.sha256(line)
            if done:
                yield pa.RecordBatch.from_pydict({"conv": [c for c, _ in done], "sha": [s for _, s in done]})
        if running is not None:
            yield pa.RecordBatch.from_pydict({"conv": [conv], "sha": [running.hexdigest()]})

    return in_batches(rows).mapInArrow(per_task, "conv long, sha string")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: faults, cost, audit and digest of the
    repair of ``rows``; zeros and empty texts where no row is left."""
    found = repair(rows)
    everyone = conversations.select(_key()).distinct()
    joined = everyone.join(found.faults, "conv", "left").join(found.edits, "conv", "left").join(text_digests(found.rows), "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.nullif("conv", F.lit(_NO_KEY)).alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
