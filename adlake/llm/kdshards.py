"""K-d tree sharding: weighted medians along the widest metadata dimension.

Method
  * Every dimension is a whole number of DIM_BITS bits in the order of its values: numbers by
    place between the table's least and greatest, texts by their first bytes likewise.
  * A node with more than one shard to make is cut along the dimension in which its rows
    reach farthest, where the weights below and above are as its halves' shards. Rows of one
    value are told apart by a hash, so a value that holds a third of all rows is cut too.
  * The cut is found by sums over BINS bins of a node's keys, then over bins of the bin that
    holds it, until that weighs next to nothing. The driver sees the sums of the bins only.
  * Splitting goes on until every leaf is one shard, of the target weight.

All of it is DataFrame operations. The rows' keys and weights are written once to the shared
folder; the texts are read once.

Defined cases: null values of a dimension come first. Rows are placed one by one, so repeated
rows and keys may lie in different shards. A null text weighs its row overhead alone. Columns
other than those named are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import written

DIM_BITS, TIE_BITS = 20, 43
BINS = 2048
FINE = 400  # a bin lighter than this part of a shard is not searched further
PARTS = 256  # of a shard, that number their slots side by side
ROW_BYTES = 16


@dataclass
class Node:
    """Rows that ``shards`` shards share, from ``first`` on; a cut one has two parts."""

    first: int
    shards: int
    dim: int = 0
    cut: int = 0
    parts: tuple[Node, Node] | None = None


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    text = F.col(name).cast("string")
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _key(dim: str) -> Column:
    """A dimension's value and then the row's hash, as one number."""
    return F.shiftleft(F.col(dim), TIE_BITS) + F.shiftrightunsigned("tie", 63 - TIE_BITS + 1)


def _by_node(spark: SparkSession, names: list[str], values: list[tuple[int, ...]]) -> DataFrame:
    """A row of whole numbers per node; there are never more nodes than shards."""
    rows = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in values)
    return F.broadcast(spark.sql(f"select * from values {rows} as t({', '.join(names)})"))


def _down(rows: DataFrame, nodes: list[Node], dims: list[str]) -> DataFrame:
    """Rows of the cut nodes moved on to their parts."""
    cuts = _by_node(rows.sparkSession, ["node", "dim", "cut", "above"],
                    [(n.first, n.dim, n.cut, n.parts[1].first) for n in nodes])
    key = F.element_at(F.array(*map(_key, dims)), (F.col("dim") + 1).cast("int"))
    node = F.when(F.col("dim").isNull() | (key < F.col("cut")), F.col("node")).otherwise(F.col("above"))
    return rows.join(cuts, "node", "left").withColumn("node", node).drop("dim", "cut", "above")


def _cut(rows: DataFrame, nodes: list[Node], dims: list[str], total: int, shards: int) -> None:
    """Choose the dimension and the cut of every node, all nodes at once."""
    spans = {r["node"]: r for r in rows.groupBy("node").agg(
        F.sum("weight").alias("weight"), *(f(d).alias(f"{d}_{f.__name__}") for d in dims for f in (F.min, F.max))).collect()}
    low, high, want, open_nodes = {}, {}, {}, []
    for n in nodes:
        n.parts = (Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2))
        if n.first not in spans:  # no rows: any cut will do
            continue
        s = spans[n.first]
        n.dim = max(range(len(dims)), key=lambda j: s[f"{dims[j]}_max"] - s[f"{dims[j]}_min"])
        low[n.first] = s[f"{dims[n.dim]}_min"] << TIE_BITS
        high[n.first] = (s[f"{dims[n.dim]}_max"] + 1) << TIE_BITS
        want[n.first] = s["weight"] * n.parts[0].shards / n.shards
        open_nodes.append(n)
    while open_nodes:
        step = {n.first: max(1, -(-(high[n.first] - low[n.first]) // BINS)) for n in open_nodes}
        looked = _by_node(rows.sparkSession, ["node", "dim", "low", "step"],
                          [(n.first, n.dim, low[n.first], step[n.first]) for n in open_nodes])
        place = F.element_at(F.array(*map(_key, dims)), (F.col("dim") + 1).cast("int")) - F.col("low")
        inside = (rows.join(looked, "node").withColumn("place", place)
                  .withColumn("bin", F.call_function("div", F.col("place"), F.col("step"))))
        inside = inside.where((F.col("place") >= 0) & (F.col("bin") < BINS))
        sums: dict[int, np.ndarray] = {n.first: np.zeros(BINS, dtype=np.int64) for n in open_nodes}
        for r in inside.groupBy("node", "bin").agg(F.sum("weight").alias("weight")).collect():
            sums[r["node"]][r["bin"]] = r["weight"]
        rest = []
        for n in open_nodes:
            upto = np.cumsum(sums[n.first])
            at = min(int(np.searchsorted(upto, want[n.first])), BINS - 1)
            below = int(upto[at - 1]) if at else 0
            weight = int(upto[at]) - below
            low[n.first] += at * step[n.first]
            want[n.first] -= below
            if step[n.first] > 1 and weight * shards * FINE > total:
                high[n.first] = low[n.first] + step[n.first]
                rest.append(n)
            else:
                n.cut = low[n.first] + (step[n.first] if 2 * want[n.first] > weight else 0)
        open_nodes = rest


def kd_shards(df: DataFrame, *, dims: list[str], weight: Column, shards: int, keep: list[Column]) -> DataFrame:
    """The columns ``keep``, and shard and slot (gapless from 0 in each shard) of every row."""
    numbers = {f"k{j}": _number(df, d) for j, d in enumerate(dims)}
    bounds = df.select(*(f(c).alias(f"{k}_{f.__name__}") for k, c in numbers.items() for f in (F.min, F.max))).first()

    def scaled(k: str) -> Column:
        low, high = bounds[f"{k}_min"], bounds[f"{k}_max"]
        if low is None or high <= low:
            return F.lit(0).cast("long")
        part = (numbers[k] - low) / (high - low) * ((1 << DIM_BITS) - 2)
        return F.coalesce(part.cast("long") + 1, F.lit(0))

    kept = [f"c{i}" for i in range(len(keep))]
    tie = F.xxhash64(*keep, F.monotonically_increasing_id())
    rows = written(df.select(*(c.alias(n) for c, n in zip(keep, kept, strict=True)), weight.cast("long").alias("weight"),
                             *(scaled(k).alias(k) for k in numbers), tie.alias("tie"), F.lit(0).cast("long").alias("node")), "kd-rows")
    total = rows.agg(F.sum("weight")).first()[0] or 0
    names = list(numbers)
    placed, level = rows, [Node(0, shards)] if shards > 1 else []
    while level:
        _cut(placed, level, names, total, shards)
        placed = _down(placed, level, names)
        level = [p for n in level for p in n.parts if p.shards > 1]
    placed = placed.withColumn("shard", F.col("node").cast("int")).withColumn("part", F.pmod("tie", F.lit(PARTS)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("shard", "part").orderBy("tie")) - 1
    out = placed.withColumn("place", place).join(counts, ["shard", "part"])
    names = [c for c in df.select(*keep).columns]
    return out.select(*(F.col(k).alias(n) for k, n in zip(kept, names, strict=True)), "shard",
                      (F.col("before") + F.col("place")).alias("slot"))


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); shards have nearly equal bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    dims = [d for d in ("source", "lang", "n_chars") if d in docs.columns]
    return kd_shards(docs, dims=dims or ["doc_id"], weight=size, shards=shards, keep=[
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32")])
