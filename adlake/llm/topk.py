"""Exact top-k search by inner product, with bounds from segment means and deviations.

Method
  * Vectors are whole numbers: floor(SCALE * x) of every component.
  * A vector is cut into segments of 64, then 16, then 4 components. The product of two
    segments is at most L * (mean * mean + deviation * deviation), as their correlation is at
    most 1; the sum over the segments bounds the score from above, which is the distance from
    below. All three levels are themselves inner products of twice as many numbers as there
    are segments. A pair goes on to the next level, and from the last one to its exact score,
    only while its bound reaches the query's k-th best score so far.
  * Vectors are packed into blocks, blocks dealt into slices, and the queries of the blocks
    into groups. A task holds one group of queries and reads the blocks of one slice one by
    one. Slices are searched in waves that grow by WAVE: after each wave a query's k best
    results so far give the score that the next wave's bounds must reach. So a wave hands on
    about k * WAVE rows a query, however many slices it has.
  * Scores are exact: doubles hold the sums up to 2**53; blocks that could exceed that are
    multiplied as Python's whole numbers.

Defined cases: a vector that is null, or holds a null or a number that is not finite (also
after scaling), takes no part. Missing components of a shorter vector count as 0. Every row is
a candidate of its own, also where keys repeat; only the query's own row is left out. A null
key is never a query, comes last among ties and is given back as null. Scores beyond a long
are its least or greatest. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from adlake.llm.common import in_batches, written

SCALE = 64
K = 20
EVERY = 20  # queries are the rows whose key is divisible by this
LEVELS = (64, 16, 4)  # components of a segment, coarse to fine
BLOCK_ROWS = 4096
GROUP_QUERIES = 2048
SLICE_BLOCKS = 4
WAVE = 8
CHUNK = 512  # queries scored against a block at a time
SPARSE = 0.1  # share of surviving pairs below which they are followed one by one
PIECE_PAIRS = 1 << 15
TASKS = 20_000  # of a wave, at most; a task then takes several slices in turn
_LAST = (1 << 63) - 1  # in place of a null key
_LEAST = -(1 << 63) + 1
_EXACT = float(1 << 53)
_DTYPES = ("int16", "int32", "float64")
_QUERIES, _SCORES, _CANDIDATES = 0, 1, 2

_BLOCK = "kind int, block long, n long, dims int, dtype string, ids binary, places binary, vectors binary"
_FOUND = "block long, place long, score long, vec_id long, of_block long, of_place long"


# --- blocks --------------------------------------------------------------------------


def _packed(vectors: np.ndarray) -> tuple[str, bytes]:
    """The shortest type that holds all components."""
    size = np.abs(vectors).max(initial=0)
    dtype = next(t for t in _DTYPES if t == "float64" or size <= np.iinfo(t).max)
    return dtype, vectors.astype(dtype).tobytes()


def blocks(embeddings: DataFrame) -> DataFrame:
    """Vectors in blocks of BLOCK_ROWS, and those of each block that are queries, written."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x * SCALE) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("embedding").isNotNull() & finite)

    def record(kind, block, ids, places, vectors):
        dtype, raw = _packed(vectors)
        return {"kind": kind, "block": block, "n": len(ids), "dims": vectors.shape[1], "dtype": dtype, "ids": ids.tobytes(),
                "places": places.tobytes(), "vectors": raw}

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(row, BLOCK_ROWS)
                lists = part.column("embedding")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                dims = int(sizes.max(initial=0))
                vectors = np.zeros((len(sizes), dims))
                vectors[np.arange(dims)[None, :] < sizes[:, None]] = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE)
                keys = part.column("vec_id")
                ids = keys.fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
                asks = np.flatnonzero((ids % EVERY == 0) & keys.is_valid().to_numpy(zero_copy_only=False))
                made = [record(_CANDIDATES, number, ids, np.arange(len(ids)), vectors)]
                if len(asks):
                    made.append(record(_QUERIES, number, ids[asks], asks, vectors[asks]))
                number += 1
                yield pa.RecordBatch.from_pylist(made, schema=schema)

    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("dims", pa.int32()), ("dtype", pa.string()),
                        ("ids", pa.binary()), ("places", pa.binary()), ("vectors", pa.binary())])
    return written(in_batches(rows).mapInArrow(per_task, _BLOCK), "vector-blocks")


def _matrix(record: dict) -> np.ndarray:
    return np.frombuffer(record["vectors"], record["dtype"]).reshape(record["n"], record["dims"]).astype(np.float64)


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    """More columns, of zeros."""
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def statistics(vectors: np.ndarray, length: int) -> np.ndarray:
    """Segment means and deviations, times the root of the segment's length; the inner product
    of two such rows is at least that of the vectors."""
    n, dims = vectors.shape
    parts = _wide(vectors, -(-dims // length) * length).reshape(n, -(-dims // length), length)
    return np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1) * np.sqrt(length)


def _in_step(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of vectors of different widths, means beside means."""
    half = max(a.shape[1], b.shape[1]) // 2

    def spread(x):
        own = x.shape[1] // 2
        return np.concatenate([_wide(x[:, :own], half), _wide(x[:, own:], half)], axis=1)

    return (a, b) if a.shape[1] == b.shape[1] else (spread(a), spread(b))


# --- one group of queries against blocks ---------------------------------------------


class Search:
    """The k best candidates of each query of a group, over the blocks it is shown."""

    def __init__(self, k: int = K):
        self.k = k
        self.records, self.least = [], {}

    def add_queries(self, record: dict) -> None:
        self.records.append(record)

    def add_scores(self, block: int, known: list[dict]) -> None:
        """The k-th best scores known of a block's queries."""
        self.least[block] = {x["place"]: x["score"] for x in known}

    def start(self) -> None:
        width = max((r["dims"] for r in self.records), default=0)
        self.vectors = np.concatenate([_wide(_matrix(r), width) for r in self.records])
        self.own = np.concatenate([np.full(r["n"], r["block"]) for r in self.records])
        self.place = np.concatenate([np.frombuffer(r["places"], np.int64) for r in self.records])
        self.floor = np.array([self.least.get(b, {}).get(p, _LEAST) for b, p in zip(self.own.tolist(), self.place.tolist(), strict=True)])
        self.levels = [statistics(self.vectors, length) for length in LEVELS]
        self.norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.best = np.empty((5, 0), np.int64)  # query, score, key, block, place
        self.exact = 0  # pairs that were multiplied in full

    def show(self, record: dict) -> None:
        """All pairs of the group's queries and one block."""
        vectors = _matrix(record)
        ids = np.frombuffer(record["ids"], np.int64)
        levels = [statistics(vectors, length) for length in LEVELS]
        norms = np.sqrt((vectors ** 2).sum(axis=1))
        finds = []
        for first in range(0, len(self.place), CHUNK):
            part = slice(first, min(first + CHUNK, len(self.place)))
            query, candidate, score = self._pairs(part, record["block"], vectors, levels, norms)
            finds.append(np.stack([query, score, ids[candidate], np.full(len(query), record["block"]), candidate]))
        found = np.concatenate([self.best, *finds], axis=1)
        if found.shape[1] == self.best.shape[1]:
            return
        order = np.lexsort((found[4], found[3], found[2], -found[1], found[0]))
        found = found[:, order]
        begin = np.searchsorted(found[0], found[0])
        self.best = found[:, np.arange(found.shape[1]) - begin < self.k]
        counts = np.bincount(self.best[0], minlength=len(self.place))
        full = counts >= self.k
        self.floor[full] = np.maximum(self.floor[full], self.best[1][np.cumsum(counts)[full] - 1])

    def _pairs(self, part: slice, block: int, vectors, levels, norms):
        """(query, candidate, score) of the pairs that may be among the k best."""
        floor = self.floor[part]
        alive = np.ones((len(floor), len(vectors)), bool)
        alive[np.flatnonzero(self.own[part] == block), self.place[part][self.own[part] == block]] = False
        if (floor > _LEAST).any():
            reach = floor[:, None].astype(np.float64) - 1e-9 * np.outer(self.norms[part], norms) - 0.5
            for own, other in zip(self.levels, levels, strict=True):
                a, b = _in_step(own[part], other)
                if alive.mean() > SPARSE:
                    alive &= a @ b.T >= reach
                else:
                    q, c = np.nonzero(alive)
                    for i in range(0, len(q), PIECE_PAIRS):
                        at = q[i:i + PIECE_PAIRS], c[i:i + PIECE_PAIRS]
                        alive[at] = np.einsum("ij,ij->i", a[at[0]], b[at[1]]) >= reach[at]
        query, candidate = np.nonzero(alive)
        if not len(query):
            return query, candidate, np.empty(0, np.int64)
        width = max(vectors.shape[1], self.vectors.shape[1])
        a, b = _wide(self.vectors[part], width), _wide(vectors, width)
        score = self._scores(a, b, query, candidate, len(query) > SPARSE * alive.size)
        self.exact += len(query)
        keep = score >= floor[query]
        query, candidate, score = query[keep], candidate[keep], score[keep]
        counts = np.bincount(query, minlength=len(floor))
        if counts.max(initial=0) > self.k:  # of each query, those that reach its own k-th
            order = np.lexsort((-score, query))
            kth = np.full(len(floor), _LEAST)
            many = np.flatnonzero(counts > self.k)
            kth[many] = score[order][(np.cumsum(counts) - counts)[many] + self.k - 1]
            keep = score >= kth[query]
            query, candidate, score = query[keep], candidate[keep], score[keep]
        return query + part.start, candidate, score

    @staticmethod
    def _scores(a, b, query, candidate, dense: bool) -> np.ndarray:
        if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1) >= _EXACT:
            whole_a, whole_b = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
            return np.array([max(_LEAST, min(_LAST, sum(map(int.__mul__, whole_a[q], whole_b[c]))))
                             for q, c in zip(query.tolist(), candidate.tolist(), strict=True)], np.int64)
        if dense:
            return (a @ b.T)[query, candidate].astype(np.int64)
        out = np.empty(len(query), np.int64)
        for i in range(0, len(query), PIECE_PAIRS):
            at = slice(i, i + PIECE_PAIRS)
            out[at] = np.einsum("ij,ij->i", a[query[at]], b[candidate[at]])
        return out


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by group, slice and kind to the finds of each group in each slice."""
    def finds(search):
        query, score, key, block, place = search.best
        return pa.RecordBatch.from_pydict({"block": search.own[query], "place": search.place[query], "score": score, "vec_id": key,
                                           "of_block": block, "of_place": place})

    key, search, started = None, None, False
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if (r["grp"], r["slice"]) != key:
                if started:
                    yield finds(search)
                key, search, started = (r["grp"], r["slice"]), Search(), False
            if r["kind"] == _QUERIES:
                search.add_queries(r)
            elif r["kind"] == _SCORES:
                search.add_scores(r["block"], r["known"])
            elif search.records:
                if not started:
                    search.start()
                    started = True
                search.show(r)
    if started:
        yield finds(search)


# --- waves ---------------------------------------------------------------------------


def _best(found: DataFrame) -> DataFrame:
    order = W.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id", "of_block", "of_place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)


def top_k(embeddings: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): the K best rows of every query."""
    packed = blocks(embeddings)
    spark = packed.sparkSession
    sizes = {r["kind"]: r for r in packed.groupBy("kind").agg(F.sum("n").alias("rows"), F.count("*").alias("blocks")).collect()}
    queries = packed.where(F.col("kind") == _QUERIES)
    best = spark.createDataFrame([], _FOUND)
    if _QUERIES in sizes:
        groups = -(-sizes[_QUERIES]["rows"] // GROUP_QUERIES)
        slices = -(-sizes[_CANDIDATES]["blocks"] // SLICE_BLOCKS)
        low, high = 0, 1
        while low < slices:
            best = written(_best(best.unionByName(_wave(packed, best, groups, slices, low, min(high, slices)))).drop("rank"), "best")
            low, high = high, high * WAVE
    names = _query_ids(queries)
    ranked = _best(best).join(names, ["block", "place"])
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif("vec_id", F.lit(_LAST)).alias("vec_id"), "score")


def _query_ids(queries: DataFrame) -> DataFrame:
    def per_batch(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pydict({"block": np.full(r["n"], r["block"]), "place": np.frombuffer(r["places"], np.int64),
                                                  "query_id": np.frombuffer(r["ids"], np.int64)})

    return in_batches(queries.select("block", "n", "ids", "places")).mapInArrow(per_batch, "block long, place long, query_id long")


def _wave(packed: DataFrame, best: DataFrame, groups: int, slices: int, low: int, high: int) -> DataFrame:
    """Finds of all groups in the slices from ``low`` to ``high``."""
    group = F.pmod(F.xxhash64("block"), F.lit(groups)).alias("grp")
    own = F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice")
    in_wave = F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high - 1).cast("long"))).alias("slice")
    none = F.lit(None).cast("array<struct<place: long, score: long>>").alias("known")
    queries = packed.where(F.col("kind") == _QUERIES).select("*", group, none).select("*", in_wave)
    candidates = packed.where(F.col("kind") == _CANDIDATES).select("*", own, none).where(F.col("slice").between(low, high - 1)) \
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"))
    last = best.groupBy("block", "place").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == K)
    known = last.groupBy("block").agg(F.collect_list(F.struct("place", "score")).alias("known")).select(
        F.lit(_SCORES).alias("kind"), "block", "known", group).select("*", in_wave)
    records = candidates.unionByName(queries).unionByName(known, allowMissingColumns=True)
    tasks = min(2 * groups * (high - low), TASKS)
    dealt = records.repartition(tasks, "grp", "slice").sortWithinPartitions("grp", "slice", "kind", "block")
    return in_batches(dealt).mapInArrow(_searched, _FOUND)
