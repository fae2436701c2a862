"""What several operators need: tables, written steps, summed arrays, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, computed once into the shared folder and read from there."""
    path = run_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made within lose their shuffle files as soon as an action on them ends, instead of
    when the driver next collects its garbage; they are for one action each."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


BATCH_BYTES = 4 << 20  # of rows that an executor hands to a Python worker together
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_BATCH = "67108864b"


def in_batches(df: DataFrame) -> DataFrame:
    """The frame, whose rows ``mapInArrow`` gets in batches of about BATCH_BYTES.

    Spark's batches of 64 MB are held in the executor, on the way, and in the worker at once.
    The bound is a setting of the session; one that a session has chosen itself stays. A
    larger row is a batch of its own.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, _SPARKS_BATCH) == _SPARKS_BATCH:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df


BROADCAST_IDS = 1 << 20  # rows of one whole number, some 16 MB


def by_ids(df: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of df on a written table of ids (one column, id).

    Few ids go to every task, so that df is not shuffled; more than BROADCAST_IDS are left
    to Spark's own choice of join.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, df[key] == ids["id"], how)


def few_tasks(df: DataFrame) -> DataFrame:
    """As many tasks as cores, twice over: for steps whose output per task has a fixed size."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def held_out(key: str, modulus: int):
    """crc32 of a key as text, modulo a number."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus))


SUM_BYTES = 1 << 17  # of one summed piece


PIECE = "place long, length long, piece binary"


def pieces(total: np.ndarray) -> Iterator[dict[str, list]]:
    """An array in pieces of SUM_BYTES, without those that are zero."""
    step = SUM_BYTES // total.dtype.itemsize
    for i in range(0, len(total), step):
        if (piece := total[i:i + step]).any():
            yield {"place": [i], "length": [len(total)], "piece": [piece.tobytes()]}


def sum_pieces(df: DataFrame, dtype: str = "int64") -> np.ndarray:
    """The element-wise sum of the arrays whose pieces (PIECE) df holds.

    Pieces are summed on the executors by their place; the driver receives the sum alone.
    """
    def per_place(batches):
        totals, length = {}, 0
        for batch in batches:
            for place, length, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                piece = np.frombuffer(raw, dtype=dtype)
                totals[place] = totals[place] + piece if place in totals else piece
        for place, total in totals.items():
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([place], pa.int64()), "length": pa.array([length], pa.int64()),
                "piece": pa.array([total.tobytes()], pa.binary())})

    rows = in_batches(df.select("place", "length", "piece").repartition("place")).mapInArrow(per_place, PIECE).collect()
    if not rows:
        return np.empty(0, dtype)
    out = np.zeros(rows[0]["length"], dtype)
    for r in rows:
        piece = np.frombuffer(r["piece"], dtype=dtype)
        out[r["place"]:r["place"] + len(piece)] = piece
    return out


def summed(df: DataFrame, add: Callable[[Iterator[pa.RecordBatch]], np.ndarray], dtype: str = "int64") -> np.ndarray:
    """The element-wise sum of one array per task, of the same fixed length in all tasks."""
    def per_task(batches):
        for piece in pieces(add(batches)):
            yield pa.RecordBatch.from_pydict(piece)

    return sum_pieces(in_batches(few_tasks(df)).mapInArrow(per_task, PIECE), dtype)


EDGES = 1 << 19  # that a task looks at together


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As many edges at most, which join the same nodes: each node of the edges (a, b) to the
    smallest that these reach from it."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _as_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def found():
        a, b = (np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(a, b)], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= EDGES:
            yield found()
            held, n = [], 0
    if n:
        yield found()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Each task makes stars of the edges that it holds; then large star and small star in turn
    until all are. Every round is written to the shared folder, so the lineage stays short and
    a lost executor costs one round.
    """
    down = edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    now = written(in_batches(down.where("a > b").distinct()).mapInArrow(_as_stars, "a long, b long"), f"{label}-0")
    turn = 0
    while not _all_stars(now):
        turn += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b").where("a > b").distinct()
        now = written(small, f"{label}-{turn}")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none below one that has an edge up."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down")))
    of_node = ends.groupBy("node").agg(F.sum("down").alias("downs"), F.min("down").alias("least"))
    return of_node.where("downs > least").isEmpty()
