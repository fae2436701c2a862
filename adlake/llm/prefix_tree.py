"""Prefix-tree join: pairs of sets whose Jaccard similarity reaches a threshold, exactly.

Method
  * Every set holds hashes of five-word runs in one global order: by value, and those that
    many rows share last, by a table of counts over all rows. Two sets that reach the
    threshold have KEPT of a set's values in common within their leading parts (see
    ``_lead``), so only these parts are shuffled, without the often shared values.
  * A set with fewer shared values in its leading part than that has no partner and is done.
    Of the others' shared values, the rarest suffice for every pair to meet in one.
  * Rows with one set are joined to their smallest key first. Sets that share a rare value
    are gathered into groups, and a group that is large is cut into blocks by size.
  * In a group, the sets are stored in a trie (frequent first, so that alike sets share
    their path). Each set walks down the trie level by level: the overlap with a path is
    counted once for all sets below it, and a subtree is left when its overlap and the
    longest rest below cannot reach the threshold any more.

The result is by components, since copies have no use for all their pairs: only a spanning
forest of the links leaves a task.

Defined cases: null or wordless texts have an empty set and link with nothing. Rows that
share a key are one node with the links of all its rows; each row keeps its own count. A
null key links with nothing and has a null component. Other columns are not read, whatever
their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.llm.common import by_ids, components, few_tasks, in_batches, pieces, sum_pieces, written
from adlake.llm.words import chunks, distinct, give_back, mix, shingles, split_words

WIDTH = 5
THRESHOLD = (4, 5)
KEPT = (1, 5)  # part of a set that a pair has in common in its leading parts
COUNT_BITS = 20  # of the table of counts that finds the often shared values
GROUP_VALUES = 1 << 16  # values of a group that one task takes whole
SENT_VALUES = 1 << 20  # of leading parts that leave a task together
_U = np.uint64


def _sets(data, at, width) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*shingles(split_words(data, at), width))


def _up(n, num: int, den: int):
    return (num * n + den - 1) // den


def _described(docs: DataFrame, width: int) -> DataFrame:
    """Per row: key, hash of the text, set size, and a 128-bit mark of the set; and pieces of the
    counts of values over 2**COUNT_BITS buckets."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, dtype=np.int64)

        def batch(ids=None, hashes=None, n=(), marks=(), place=(), length=(), piece=()):
            size = max(len(n), len(place))
            none = [None] * size
            return pa.RecordBatch.from_pydict({
                "id": pa.array(none, pa.int64()) if ids is None else ids,
                "hash": pa.array(none, pa.int64()) if hashes is None else hashes, "n": pa.array(n if len(n) else none, pa.int64()),
                "mark": pa.array(marks or none, pa.binary()), "place": pa.array(place or none, pa.int64()),
                "length": pa.array(length or none, pa.int64()), "piece": pa.array(piece or none, pa.binary())})

        for rows, data, at in chunks(batches):
            values, ptr = _sets(data, at, width)
            bucket, often = np.unique((values >> _U(64 - COUNT_BITS)).astype(np.int64), return_counts=True)
            total[bucket] += often
            count, marks = np.diff(ptr), np.zeros((len(ptr) - 1, 2), dtype=np.uint64)
            some = np.flatnonzero(count)
            if len(some):
                for k, salt in enumerate((0x5A5A5A5A5A5A5A5A, 0x3C3C3C3C3C3C3C3C)):
                    mixed = mix(values ^ _U(salt))
                    marks[some, k] = np.add.reduceat(mixed, ptr[:-1][some])
            yield batch(rows.column("id"), rows.column("hash"), count, [m.tobytes() if n else None for m, n in zip(marks, count, strict=True)])
        for p in pieces(total):
            yield batch(**p)

    return in_batches(few_tasks(docs)).mapInArrow(describe, "id long, hash long, n long, mark binary, place long, length long, piece binary")


def _often(counts: np.ndarray) -> np.ndarray:
    """Buckets that hold a value which many rows share: far more than the usual count."""
    usual = float(np.median(counts)) if len(counts) else 0.0
    return counts > usual + 6 * np.sqrt(usual) + 32


def _lead(docs: DataFrame, counts: np.ndarray, width: int, num: int, den: int, slices: int) -> DataFrame:
    """The leading parts of all sets, dealt by value into ``slices``; see KEPT.

    A part has n - ceil(t n) + ceil(k n) values, so a pair that reaches t has ceil(k n) of
    the smaller set's at least in common in both parts. Rows: of one slice, the values, which
    of ``ids`` holds each, and the sizes of their sets. Often shared values need no partner:
    they come in slices of their own, from ``slices`` on, with their bucket's count.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, _often(counts)))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, hot = shared.value
        turn = 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            values, ids, sizes = (np.concatenate(c) for c in zip(*held, strict=True))
            bucket = (values >> _U(64 - COUNT_BITS)).astype(np.int64)
            known = hot[bucket]
            slice_of = np.where(known, slices, (values % _U(slices)).astype(np.int64))
            order = np.argsort(slice_of, kind="stable")
            values, ids, sizes, bucket = values[order], ids[order], sizes[order], bucket[order]
            cuts = np.searchsorted(slice_of[order], np.arange(slices + 2))
            rows = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
            spare = slices + int(ids[0] + turn) % slices if len(ids) else slices
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([k if k < slices else spare for k, _, _ in rows], pa.int32()),
                "values": pa.array([values[a:b].tobytes() for _, a, b in rows], pa.binary()),
                "ids": pa.array([ids[a:b].tobytes() for _, a, b in rows], pa.binary()),
                "sizes": pa.array([sizes[a:b].tobytes() for _, a, b in rows], pa.binary()),
                "often": pa.array([often[bucket[a:b]].tobytes() if k == slices else None for k, a, b in rows], pa.binary())})

        sent = 0
        for rows, data, at in chunks(batches):
            values, ptr = _sets(data, at, width)
            n = np.diff(ptr)
            text = np.repeat(np.arange(len(n)), n)
            known = hot[(values >> _U(64 - COUNT_BITS)).astype(np.int64)]
            order = np.lexsort((known, text))  # keeps the order by value
            take = n - _up(n, num, den) + _up(n, *KEPT)
            first = (np.arange(len(values)) - ptr[text]) < take[text]
            at = order[first]
            ids = np.asarray(rows.column("id").to_numpy(zero_copy_only=False), dtype=np.int64)
            held.append((values[at], ids[text[at]], n[text[at]].astype(np.int32)))
            sent += len(at)
            if sent >= SENT_VALUES:
                yield from flush()
                held, sent, turn = [], 0, turn + 1
        if held:
            yield from flush()

    return in_batches(docs).mapInArrow(lead, "slice int, values binary, ids binary, sizes binary, often binary")


_SHARED = "id long, n int, value long, often long"


def _shared_values(lead: DataFrame) -> DataFrame:
    """(id, n, value, often): the values of the leading parts that two rows hold or more."""
    def table(ids, sizes, values, often):
        return pa.RecordBatch.from_pydict({"id": pa.array(ids), "n": pa.array(sizes), "value": pa.array(values.view(np.int64)),
                                           "often": pa.array(often)})

    def read(raws, dtype):
        return np.concatenate([np.frombuffer(r, dtype) for r in raws])

    def meet(batches):
        give_back()
        now, held = None, []

        def found():
            values, ids, sizes = (read(c, d) for c, d in zip(zip(*held, strict=True), (np.uint64, np.int64, np.int32), strict=True))
            order = np.argsort(values)
            values = values[order]
            first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
            times = np.diff(np.append(first, len(values)))
            often = np.repeat(times, times)
            keep = often > 1
            return table(ids[order][keep], sizes[order][keep], values[keep], often[keep])

        for batch in batches:
            for k, often, *raw in zip(*(batch.column(c).to_pylist() for c in ("slice", "often", "values", "ids", "sizes")), strict=True):
                if often is not None:
                    yield table(read(raw[1:2], np.int64), read(raw[2:], np.int32), read(raw[:1], np.uint64), read([often], np.int64))
                    continue
                if k != now:
                    if held:
                        yield found()
                    now, held = k, []
                held.append(raw)
        if held:
            yield found()

    return in_batches(lead.repartition("slice").sortWithinPartitions("slice")).mapInArrow(meet, _SHARED)


def _edges(shared: DataFrame, num: int, den: int) -> DataFrame:
    """(id, other): each row with the smallest key among those that share one of its rarest
    shared values; every pair that reaches the threshold meets in one of these.

    A pair has m = ceil(k t n) of a set's shared values in common at least, so it has one
    among all but the last m - 1 of either set.
    """
    need = F.ceil(F.col("n") * (KEPT[0] * num) / (KEPT[1] * den)).cast("int")
    rank = F.row_number().over(W.partitionBy("id", "n").orderBy("often", "value"))
    size = F.count("*").over(W.partitionBy("id", "n"))
    rare = (shared.withColumn("rank", rank).withColumn("size", size).withColumn("need", need)
            .where("rank <= size - need + 1").select("id", "value"))
    least = rare.groupBy("value").agg(F.min("id").alias("other"), F.max("id").alias("most")).where("other < most")
    return rare.join(least.select("value", "other"), "value").where("id != other").select("id", "other").distinct()


# --- the trie -----------------------------------------------------------------------------


class Trie:
    """Sets of ranks (ascending) as a tree of shared runs, stored level by level."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        parent, begin, end, source, ending = [-1], [0], [0], [0], [[]]
        path, before = [0], np.empty(0, np.uint32)
        for i in order:
            now = sets[i]
            n = min(len(before), len(now))
            differ = np.flatnonzero(before[:n] != now[:n])
            common = int(differ[0]) if len(differ) else n
            while len(path) > 1 and begin[path[-1]] >= common:
                path.pop()
            top = path[-1]
            if end[top] > common:  # the shared run ends inside a node: split it
                parent.append(parent[top])
                begin.append(begin[top])
                end.append(common)
                source.append(source[top])
                ending.append([])
                upper = len(parent) - 1
                parent[top], begin[top] = upper, common
                path[-1] = upper
            if len(now) > common:
                parent.append(path[-1])
                begin.append(common)
                end.append(len(now))
                source.append(i)
                ending.append([])
                path.append(len(parent) - 1)
            ending[path[-1]].append(i)
            before = now
        self._arrange(sets, parent, begin, end, source, ending)

    def _arrange(self, sets, parent, begin, end, source, ending) -> None:
        count = len(parent)
        children: list[list[int]] = [[] for _ in range(count)]
        for node in range(1, count):
            children[parent[node]].append(node)
        levels, now = [], [0]
        while now:
            levels.append(now)
            now = [c for node in now for c in children[node]]
        order = [node for level in levels for node in level]
        place = np.empty(count, np.int64)
        place[order] = np.arange(count)
        self.depth = np.array([end[v] for v in order])
        runs = [sets[source[v]][begin[v]:end[v]] if v else np.empty(0, np.uint32) for v in order]
        self.run_len = np.array([len(r) for r in runs])
        self.run_at = np.concatenate(([0], np.cumsum(self.run_len)))
        self.ranks = np.concatenate(runs) if runs else np.empty(0, np.uint32)
        self.child_at = np.array([place[children[v][0]] if children[v] else 0 for v in order])
        self.child_n = np.array([len(children[v]) for v in order])
        self.up = np.array([place[parent[v]] if v else 0 for v in order])
        self.last_rank = np.array([int(r[-1]) if len(r) else -1 for r in runs])
        self.ending = [ending[v] for v in order]
        self.ends = np.array([len(e) for e in self.ending])
        low = np.array([self.depth[k] if self.ends[k] else 1 << 40 for k in range(count)])
        high = np.array([self.depth[k] if self.ends[k] else 0 for k in range(count)])
        for k in range(count - 1, 0, -1):
            p = self.up[k]
            low[p], high[p] = min(low[p], low[k]), max(high[p], high[k])
        self.low, self.high = low, high

    def alike(self, probe: np.ndarray, width: int, num: int, den: int) -> list[int]:
        """The stored sets whose similarity to the probe is num/den at least."""
        size = len(probe)
        held = np.zeros(width + 1, dtype=np.int32)
        held[probe] = 1
        upto = np.cumsum(held)
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            many = self.child_n[nodes]
            next_nodes = _ranges(self.child_at[nodes], many)
            base = np.repeat(overlap, many)
            if not len(next_nodes):
                break
            lens = self.run_len[next_nodes]
            hits = held[self.ranks[_ranges(self.run_at[next_nodes], lens)]]
            got = base + np.add.reduceat(hits, np.concatenate(([0], np.cumsum(lens)[:-1])))
            least = np.maximum(self.low[next_nodes], -(-num * size // den))
            rest = np.minimum(self.high[next_nodes] - self.depth[next_nodes], size - upto[self.last_rank[next_nodes]])
            keep = ((got + rest) * (num + den) >= num * (least + size)) \
                & (self.high[next_nodes] * den >= num * size) & (self.low[next_nodes] * num <= den * size)
            nodes, overlap = next_nodes[keep], got[keep]
            done = (self.ends[nodes] > 0) & (overlap * (num + den) >= num * (self.depth[nodes] + size))
            for node in nodes[done]:
                found.extend(self.ending[node])
        return found


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0].., starts[1].., ... each of its length, as one array."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    some = lens > 0
    starts, lens = starts[some], lens[some]
    step = np.ones(total, np.int64)
    step[0] = starts[0]
    at = np.cumsum(lens)[:-1]
    step[at] = starts[1:] - (starts[:-1] + lens[:-1] - 1)
    return np.cumsum(step)


def forest(sets: list[np.ndarray], probes: list[np.ndarray] | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join what similarity joins: among sets, or between sets and probes.

    Indexes of probes follow those of the sets.
    """
    every = sets + (probes or [])
    if len(every) == 2:
        a, b = every
        same = len(np.intersect1d(a, b, assume_unique=True))
        return [(0, 1)] if same * (num + den) >= num * (len(a) + len(b)) else []
    flat = np.concatenate(every)
    _, which, often = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    at = np.concatenate(([0], np.cumsum([len(s) for s in every])))
    ranked = [np.sort(rank[which[a:b]]).astype(np.uint32) for a, b in zip(at[:-1], at[1:], strict=True)]
    trie = Trie(ranked[:len(sets)])
    root = list(range(len(every)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i in range(len(sets) if probes else 0, len(every)):
        for j in trie.alike(ranked[i], len(often), num, den):
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                links.append((i, j))
    return links


# --- the job --------------------------------------------------------------------------------


def _links(members: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """members: id, hash, grp, n, one for every set. Links (a, b) among the members of each group."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("int")
    sized = members.withColumn("band", band)
    total = sized.groupBy("grp").agg(F.sum("n").alias("total"))
    blocks = (sized.groupBy("grp", "band").agg(F.ceil(F.sum("n") / GROUP_VALUES).cast("int").alias("blocks")))
    above = blocks.select("grp", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("grp", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    plan = (sized.join(total, "grp").join(blocks, ["grp", "band"]).join(above, ["grp", "band"], "left")
            .join(below, ["grp", "band"], "left"))
    own = F.pmod(F.xxhash64("id", "hash"), F.col("blocks")).cast("int")

    def part(band_a, block_a, band_b, block_b, side):
        return F.struct(band_a.alias("p"), block_a.alias("q"), band_b.alias("r"), block_b.alias("s"),
                        F.lit(side).alias("side"))

    # A large group is cut by size bands, one threshold wide: partners lie in the same or the next band.
    zero, b = F.lit(0), F.col("band")
    parts = F.when(F.col("total") <= GROUP_VALUES, F.array(part(zero, zero, zero, zero, 0))).otherwise(F.concat(
        F.transform(F.sequence(zero, F.col("blocks") - 1), lambda k: F.struct(
            b.alias("p"), F.least(own, k).alias("q"), b.alias("r"), F.greatest(own, k).alias("s"),
            F.when(own <= k, 0).otherwise(1).alias("side"))),
        F.when(F.col("above").isNull(), F.array().cast("array<struct<p:int,q:int,r:int,s:int,side:int>>")).otherwise(
            F.transform(F.sequence(zero, F.coalesce("above", F.lit(1)) - 1), lambda k: part(b, own, b + 1, k, 0))),
        F.when(F.col("below").isNull(), F.array().cast("array<struct<p:int,q:int,r:int,s:int,side:int>>")).otherwise(
            F.transform(F.sequence(zero, F.coalesce("below", F.lit(1)) - 1), lambda k: part(b - 1, k, b, own, 1)))))
    asked = written(members.select("id").distinct(), "asked")
    texts = plan.select("id", "hash", "grp", parts.alias("parts")).join(by_ids(docs, "id", asked, "left_semi"), ["id", "hash"])

    def to_sets(batches):
        for rows, data, at in chunks(batches):
            values, ptr = _sets(data, at, width)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("grp"), rows.column("parts"),
                 pa.array([values[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:], strict=True)], pa.binary())],
                names=["id", "grp", "parts", "held"])

    kind = "array<struct<p:int,q:int,r:int,s:int,side:int>>"
    spread = (in_batches(texts).mapInArrow(to_sets, f"id long, grp long, parts {kind}, held binary")
              .select("id", "grp", F.explode("parts").alias("part"), "held")
              .select("id", "grp", "part.*", "held"))
    key = ["grp", "p", "q", "r", "s"]
    dealt = spread.repartition(*key).sortWithinPartitions(*key)

    def join(batches):
        now, ids, sides, held = None, [], [], []

        def links():
            if len(ids) < 2:
                return
            same = now[1:3] == now[3:5]
            first = [k for k, side in enumerate(sides) if same or side == 0]
            second = [] if same else [k for k, side in enumerate(sides) if side == 1]
            if not same and not (first and second):
                return
            order = first + second
            got = [np.frombuffer(held[k], dtype=_U) for k in order]
            found = forest(got[:len(first)], got[len(first):] or None, num, den)
            if found:
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array([ids[order[i]] for i, _ in found], pa.int64()),
                    "b": pa.array([ids[order[j]] for _, j in found], pa.int64())})

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for one, grp, p, q, r, s, side, raw in zip(*columns, strict=True):
                if (grp, p, q, r, s) != now:
                    yield from links()
                    now, ids, sides, held = (grp, p, q, r, s), [], [], []
                ids.append(one)
                sides.append(side)
                held.append(raw)
        yield from links()

    return in_batches(dealt).mapInArrow(join, "a long, b long")


def _once(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows, of those with one key and text one only; texts are shuffled for such keys alone."""
    again = written(sets.where("id is not null and n > 0").groupBy("id", "hash").agg(F.count("*").alias("rows"))
                    .where("rows > 1").select("id").distinct(), "again")
    if again.isEmpty():
        return rows
    return by_ids(rows, "id", again, "left_anti").unionByName(
        by_ids(rows, "id", again, "left_semi").dropDuplicates(["id", "hash"]))


def near_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                    threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(key, n_shingles, component_id) for every row; see the module for the cases.

    ``threshold`` is a fraction (numerator, denominator); the key is a whole number.
    """
    num, den = threshold
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    told = written(_described(rows, width), "described")
    sets = told.where("piece is null").select("id", "hash", "n", "mark")
    counts = sum_pieces(told.where("piece is not null"))
    counts = counts if len(counts) else np.zeros(1 << COUNT_BITS, dtype=np.int64)
    # Rows of one set: one with their smallest key stands for them.
    named = sets.where("id is not null and n > 0")
    first = written(named.groupBy("mark").agg(F.min(F.struct("id", "hash", "n")).alias("rep")).select("mark", "rep.*"), "first")
    reps = first.select("mark", F.col("id").alias("rep"))
    member = written(named.select("id", "mark").join(reps, "mark").select("id", "rep"), "members")

    slices = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lead = _lead(rows.where("id is not null"), counts, width, num, den, slices)
    met = written(_edges(_shared_values(lead), num, den), "met")
    # A key with several sets is known by the least of their representatives; the others join it.
    by_id = member.groupBy("id").agg(F.min("rep").alias("rep"), F.max("rep").alias("most"))
    some = by_id.select("id", "rep")
    near = (met.join(some, "id").select(F.col("rep").alias("a"), "other")
            .join(some.select(F.col("id").alias("other"), F.col("rep").alias("b")), "other").select("a", "b"))
    several = written(by_id.where("rep < most").select("id", F.col("rep").alias("a")), "several")
    near = near.unionByName(several.join(member.select("id", F.col("rep").alias("b")), "id").where("a < b").select("a", "b"))
    groups = components(near, "candidates")

    in_group = groups.select(F.col("node").alias("id"), F.col("root").alias("grp")).join(first.drop("mark"), "id")
    links = _links(in_group, _once(rows, sets), width, num, den)
    same = member.where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(written(links.unionByName(same).where("a != b").distinct(), "links"), "found")
    out = sets.select("id", "n").join(found, sets.id == found.node, "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("root", "id").alias("component_id"))
