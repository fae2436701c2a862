"""Transcript parsing: a hidden Markov model over lines recovers who speaks.

Method
  * A transcript is lines in order. A line is seen as its speaker marker (a word at its start
    that a colon, bracket or angle ends), its length class, and whether it asks; a blank line
    is only that.
  * The hidden states are begin, inside and gap (blank) of a turn, for each role. Emissions
    and transitions are counted, with one added, over labelled lines.
  * Viterbi works on blocks of lines: per block the best score from every state before it to
    every state at its end, then the states at the blocks' ends in order, then the path
    within each block. So a transcript of any length is spread over tasks, and the path is
    that of the whole transcript.
    The role changes at a begin only; a blank line belongs to the turn before it.
  * Turns are the runs from one begin to the next; markers are taken off, and each turn is
    rendered in one canonical form.

Defined cases: rows with a null conversation form one transcript, given back with a null key.
A null turn comes first; a null text is one blank line; a null role is rendered without a
marker and never trained on. Repeated rows are repeated lines. Markers not met in training
count as one. Without labelled lines all transitions and emissions are alike. Other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.llm.common import held_out, written

ROLES = ("system", "user", "assistant")
PARTS = ("begin", "inside", "gap")
STATES = tuple(f"{r}/{p}" for r in ROLES for p in PARTS)
MARKERS = 64  # different ones that the model tells apart
LENGTHS = 16
FOLDS = 5
LINE_BITS = 32  # of a line's number within its turn
BLOCK_TURNS = 64
MARKER = r"^[^\p{L}\p{N}]{0,4}(\p{L}{1,12})[^\p{L}\p{N}\s]{0,2}[:>\]][^\p{L}\p{N}\s]{0,2}\s?"
# The speaker names of some styles, by role.
STYLES = (("System: ", "User: ", "Assistant: "), ("[system] ", "[user] ", "[assistant] "),
          ("Setup> ", "Human> ", "Bot> "), ("**Note:** ", "**Q:** ", "**A:** "))
_NO_KEY = -(1 << 63)


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, line_no, line, role, first): conversations written out as transcripts.

    Each is in one of STYLES; a quarter of the turns have no marker but a blank line before.
    ``role`` and ``first`` are the truth, for training and tests.
    """
    key = F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_KEY))
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1)) + 1
    draw = F.pmod(F.xxhash64(key, turn), F.lit(4))
    style = F.pmod(F.xxhash64(key), F.lit(len(STYLES)))
    role = F.lower(F.trim(F.col("role").cast("string")))
    name = F.coalesce(*(F.when((style == s) & (role == r), F.lit(STYLES[s][k]))
                        for s in range(len(STYLES)) for k, r in enumerate(ROLES)), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = (draw == 0) | (name == "")
    lines = F.split(F.when(bare, F.concat(F.lit("\n"), text)).otherwise(F.concat(name, text)), "\n")
    rows = conversations.select(key.alias("conv_id"), turn.alias("turn"), role.alias("role"), bare.alias("bare"),
                                F.posexplode(lines).alias("k", "line"))
    return rows.select("conv_id", (F.shiftleft("turn", LINE_BITS) + F.col("k")).alias("line_no"), "line", "role",
                       (F.col("k") == F.col("bare").cast("int")).alias("first"))


def _seen(rows: DataFrame) -> DataFrame:
    blank = F.trim("line") == ""
    marker = F.lower(F.regexp_extract("line", MARKER, 1))
    length = F.least(F.floor(F.log2(F.char_length("line") + 1.0)), F.lit(LENGTHS - 1)).cast("int")
    return rows.withColumns({"blank": blank, "marker": F.when(blank, "").otherwise(marker), "length": length,
                             "asks": F.col("line").contains("?"), "block": F.shiftright("line_no", LINE_BITS) / BLOCK_TURNS}) \
        .withColumn("block", F.floor("block").cast("long"))


@dataclass
class Model:
    markers: dict[str, int]
    emit_marker: np.ndarray
    emit_length: np.ndarray
    emit_asks: np.ndarray
    start: np.ndarray
    step: np.ndarray

    def emissions(self, blank, marker, length, asks) -> np.ndarray:
        """Log scores (lines, states)."""
        known = np.array([self.markers.get(m, len(self.markers)) for m in marker], dtype=int)
        out = self.emit_marker[:, known].T + self.emit_length[:, length].T + self.emit_asks[:, asks.astype(int)].T
        gap = np.array([s.endswith("/gap") for s in STATES])
        out[:, gap] = -1e9
        out[blank] = np.where(gap, 0.0, -1e9)
        return out


def _state() -> Column:
    part = F.when(F.col("blank"), "gap").when(F.col("first"), "begin").otherwise("inside")
    return F.concat(F.col("role"), F.lit("/"), part)


def fit(lines: DataFrame) -> Model:
    """Counts over labelled lines (conv_id, line_no, line, role, first)."""
    order = W.partitionBy("conv_id", "block").orderBy("line_no", "line")
    rows = _seen(lines).where(F.col("role").isin(*ROLES))
    leads = F.col("blank") & F.lead("first").over(order)
    rows = rows.withColumn("role", F.when(leads, F.coalesce(F.lag("role").over(order), "role")).otherwise(F.col("role")))
    rows = written(rows.withColumn("state", _state()), "states")
    marks = (rows.where("marker != ''").groupBy("marker").count().orderBy(F.desc("count"), "marker").limit(MARKERS).collect())
    markers = {"": 0} | {r["marker"]: k + 1 for k, r in enumerate(marks)}
    place = {s: k for k, s in enumerate(STATES)}
    size = len(STATES)
    by_marker, by_length, by_asks = np.ones((size, len(markers) + 1)), np.ones((size, LENGTHS)), np.ones((size, 2))
    named = F.when(F.col("marker").isin(*markers), F.col("marker"))  # null: some other
    for r in rows.groupBy("state", named.alias("marker"), "length", "asks").count().collect():
        s = place[r["state"]]
        by_marker[s, markers.get(r["marker"], len(markers)) if r["marker"] is not None else len(markers)] += r["count"]
        by_length[s, r["length"]] += r["count"]
        by_asks[s, int(r["asks"])] += r["count"]
    step, start = np.ones((size, size)), np.ones(size)
    before = F.lag("state").over(order)
    pairs = rows.withColumn("before", before).groupBy("before", "state", (F.col("line_no") <= (1 << LINE_BITS) + 1).alias("top")).count()
    for r in pairs.collect():
        if r["before"] is not None:
            step[place[r["before"]], place[r["state"]]] += r["count"]
        elif r["top"]:
            start[place[r["state"]]] += r["count"]

    role, part = np.divmod(np.arange(size), len(PARTS))
    step[(role[:, None] != role[None, :]) & (part[None, :] != 0)] = 1e-9

    def log(x):
        return np.log(x / x.sum(axis=-1, keepdims=True))

    return Model(markers, log(by_marker), log(by_length), log(by_asks), log(start), log(step))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of one (conv_id, block) after the other."""
    now, held = None, {}
    for batch in batches:
        columns = batch.to_pydict()
        names = list(columns)
        for i, key in enumerate(zip(columns["conv_id"], columns["block"], strict=True)):
            if key != now:
                if now is not None:
                    yield now, held
                now, held = key, {n: [] for n in names}
            for n in names:
                held[n].append(columns[n][i])
    if now is not None:
        yield now, held


def _scores(model: Model, held: dict[str, list]) -> np.ndarray:
    return model.emissions(np.array(held["blank"]), held["marker"], np.array(held["length"]), np.array(held["asks"]))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "line_no", "line")


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, block, line_no, line, role, begins) of every line, by the best path."""
    rows = written(_seen(lines.select("conv_id", "line_no", "line")), "lines")
    shared = lines.sparkSession.sparkContext.broadcast(model)
    size = len(STATES)

    def summarize(batches):
        m = shared.value
        for (conv, block), held in _blocks(batches):
            emit = _scores(m, held)
            best = m.step + emit[0]
            for e in emit[1:]:
                best = (best[:, :, None] + m.step).max(axis=1) + e
            top = m.start + emit[0]  # where the transcript starts here
            for e in emit[1:]:
                top = (top[:, None] + m.step).max(axis=0) + e
            yield pa.RecordBatch.from_pydict({
                "conv_id": [conv], "block": [block], "table": [np.vstack([best, top]).tobytes()]})

    tables = written(_dealt(rows.select("conv_id", "block", "line_no", "line", "blank", "marker", "length", "asks"))
                     .mapInArrow(summarize, "conv_id long, block long, table binary"), "block-scores")

    def ends(batches):
        def path(conv, blocks, tables):
            score, came = tables[0][size], []
            for t in tables[1:]:
                every = score[:, None] + t[:size]
                came.append(every.argmax(axis=0))
                score = every.max(axis=0)
            state = [int(score.argmax())]
            for c in reversed(came):
                state.append(int(c[state[-1]]))
            state.reverse()
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv] * len(blocks), pa.int64()), "block": pa.array(blocks, pa.int64()),
                "enter": pa.array([-1, *state[:-1]], pa.int32()), "leave": pa.array(state, pa.int32())})

        now, blocks, held = None, [], []
        for batch in batches:
            for conv, block, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if conv != now:
                    if blocks:
                        yield path(now, blocks, held)
                    now, blocks, held = conv, [], []
                blocks.append(block)
                held.append(np.frombuffer(raw).reshape(size + 1, size))
        if blocks:
            yield path(now, blocks, held)

    bounds = tables.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
        ends, "conv_id long, block long, enter int, leave int")

    def trace(batches):
        m = shared.value
        for (conv, block), held in _blocks(batches):
            emit = _scores(m, held)
            enter, leave = held["enter"][0], held["leave"][0]
            best, came = (m.start if enter < 0 else m.step[enter]) + emit[0], []
            for e in emit[1:]:
                every = best[:, None] + m.step
                came.append(every.argmax(axis=0))
                best = every.max(axis=0) + e
            state = [leave]
            for c in reversed(came):
                state.append(int(c[state[-1]]))
            state.reverse()
            roles = [ROLES[s // len(PARTS)] for s in state]
            begins = [s % len(PARTS) == 0 for s in state]
            n = len(state)
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv] * n, pa.int64()), "block": pa.array([block] * n, pa.int64()),
                "line_no": pa.array(held["line_no"], pa.int64()), "line": pa.array(held["line"], pa.string()),
                "role": pa.array(roles), "begins": pa.array(begins)})

    told = rows.join(bounds, ["conv_id", "block"])
    return _dealt(told.select("conv_id", "block", "line_no", "line", "blank", "marker", "length", "asks", "enter", "leave")).mapInArrow(
        trace, "conv_id long, block long, line_no long, line string, role string, begins boolean")


def turns(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn, role, text, rendered): the recovered turns in canonical form.

    Blank lines at a turn's ends are not part of it; a turn of blank lines alone has an empty text.
    """
    told = written(decode(lines, model), "told")
    count = told.groupBy("conv_id", "block").agg(F.sum(F.col("begins").cast("long")).alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    count = count.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    here = W.partitionBy("conv_id", "block").orderBy("line_no", "line").rowsBetween(W.unboundedPreceding, 0)
    turn = F.greatest(F.col("before") + F.sum(F.col("begins").cast("long")).over(here) - 1, F.lit(0))
    bare = F.when(F.col("begins"), F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    placed = told.join(count, ["conv_id", "block"]).withColumn("turn", turn).withColumn("line", bare)
    parts = placed.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("begins"), 1).otherwise(0)).alias("role"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
    text = F.regexp_replace(F.array_join("lines.line", "\n"), r"^\s*\n|\n\s*$", "")
    return parts.select(F.when(F.col("conv_id") != _NO_KEY, F.col("conv_id")).alias("conv_id"), "turn", "role", text.alias("text")) \
        .withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")))


def recovered(conversations: DataFrame) -> DataFrame:
    """Write conversations out as transcripts, learn from those not held out, parse all."""
    lines = written(transcripts(conversations), "transcripts")
    model = fit(lines.where(held_out("conv_id", FOLDS) != 0))
    return turns(lines, model)
