"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Method
  * Tokens are runs of letters, digits and bytes above 127, and runs of other marks, in the
    case as written; each falls into one of 2**BUCKET_BITS buckets by its hash.
  * Every bucket has a fixed sparse random vector of -1, 0 and 1. A word's vector is the sum
    of those of its neighbours (REACH on either side) over all documents, less the mean, of
    length one. The sums are added up on the executors; their size is fixed.
  * A document is the mean and the deviation of its tokens' vectors, the mean likeness of a
    token's vector to the next one's, and the logarithm of the token count; nothing else is
    an input.
  * The network (tanh layer, logistic output) learns from labelled rows that are not held
    out, at most TRAIN_ROWS of them, chosen by a hash of their key. A part it has not seen
    sets the temperature of its probabilities.

Defined cases: a null text is empty; an empty text has zero means and gets the network's
score for that. Labels that are null, or of a null key, are left out; of several labels of
one key the mean counts, from 0.5 up as 1. Without labels of both kinds the score is
(ones + 1) / (labels + 2) for all rows. A row with a null key is held out. Repeated rows are
scored alike. Other columns are passed on or not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import held_out, in_batches, summed
from adlake.llm.words import _SPACE, _VALUE, chunks, hash_runs

BUCKET_BITS, DIMS, REACH = 15, 32, 2
INPUTS = 2 * DIMS + 2
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
FOLDS = 5
BLOCK_TOKENS = 1 << 18  # handled at a time, within a long text too
ACCEPT = 0.3
_KIND = np.where(_SPACE, 0, 2).astype(np.int8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens, and where each text's begin."""
    n = len(data)
    kind = np.zeros(n + 2, dtype=np.int8)
    kind[1:n + 1] = _KIND[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[at] = True
    inside = kind[1:n + 1] > 0
    starts = np.flatnonzero(inside & (cut[:n] | (kind[1:n + 1] != kind[:n])))
    ends = np.flatnonzero(inside & (cut[1:] | (kind[1:n + 1] != kind[2:]))) + 1
    hashes = hash_runs(data, starts, ends, _VALUE)
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(starts, at)


def index_vectors() -> np.ndarray:
    """The fixed random vectors: one entry in eight is 1 or -1."""
    draw = np.random.default_rng(20240229).integers(0, 16, size=(1 << BUCKET_BITS, DIMS))
    return ((draw == 0).astype(np.int16) - (draw == 1).astype(np.int16))


def context_sums(docs: DataFrame) -> np.ndarray:
    """Per bucket: the sum of its neighbours' vectors, and its number of tokens."""
    def add(batches) -> np.ndarray:
        fixed = index_vectors()
        total = np.zeros((1 << BUCKET_BITS, DIMS + 1), dtype=np.int64)
        for _, data, at in chunks(batches):
            bucket, ptr = tokens(data, at)
            n = len(bucket)
            if not n:
                continue
            of_text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
            for a in range(0, n, BLOCK_TOKENS):
                b = min(a + BLOCK_TOKENS, n)
                low, high = max(a - REACH, 0), min(b + REACH, n)  # a block and its surroundings
                part, text = bucket[low:high], of_text[low:high]
                near = np.zeros((high - low, DIMS + 1), dtype=np.int16)
                near[:, DIMS] = 1
                own = fixed[part]
                for k in range(1, REACH + 1):
                    if len(part) > k:
                        same = (text[k:] == text[:-k])[:, None]
                        near[k:, :DIMS] += own[:-k] * same
                        near[:-k, :DIMS] += own[k:] * same
                part, near = part[a - low:b - low], near[a - low:b - low]
                order = np.argsort(part, kind="stable")
                first = np.flatnonzero(np.diff(part[order], prepend=-1))
                total[part[order[first]]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int64)
        return total.ravel()

    found = summed(docs.select("text"), add, "int64")
    return found.reshape(-1, DIMS + 1) if len(found) else np.zeros((1 << BUCKET_BITS, DIMS + 1), dtype=np.int64)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors per bucket; zero where no token fell."""
    often = sums[:, DIMS].astype(float)
    mean = sums[:, :DIMS] / np.maximum(often, 1)[:, None]
    centre = (mean * often[:, None]).sum(axis=0) / max(often.sum(), 1)
    apart = np.where(often[:, None] > 0, mean - centre, 0)
    return (apart / np.maximum(np.sqrt((apart ** 2).sum(axis=1)), 1e-9)[:, None]).astype(np.float32)


def features(vectors: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row per text: means, deviations, likeness of neighbours, logarithm of the count."""
    bucket, ptr = tokens(data, at)
    count = np.diff(ptr)
    out = np.zeros((len(count), INPUTS), dtype=np.float64)
    some = np.flatnonzero(count)
    for a in range(0, len(bucket), BLOCK_TOKENS):
        b = min(a + BLOCK_TOKENS, len(bucket))
        held = vectors[bucket[a:b + 1]]  # and the token after the block, as a neighbour
        own = held[:b - a]
        texts = some[(ptr[some] < b) & (ptr[some + 1] > a)]
        first, last = np.maximum(ptr[texts], a) - a, np.minimum(ptr[texts + 1] - 1, b) - a
        out[texts, :DIMS] += np.add.reduceat(own, first, axis=0, dtype=np.float64)
        out[texts, DIMS:2 * DIMS] += np.add.reduceat(own * own, first, axis=0, dtype=np.float64)
        like = np.zeros(len(held))
        np.cumsum((held[:-1] * held[1:]).sum(axis=1), out=like[1:])
        out[texts, 2 * DIMS + 1] += like[last] - like[first]
    n = count[some][:, None]
    mean, square = out[some, :DIMS] / n, out[some, DIMS:2 * DIMS] / n
    out[some, :DIMS] = mean
    out[some, DIMS:2 * DIMS] = np.sqrt(np.maximum(square - mean ** 2, 0))
    out[some, 2 * DIMS] = np.log1p(n[:, 0])
    out[some, 2 * DIMS + 1] /= np.maximum(n[:, 0] - 1, 1)
    return out


class Network:
    """Two layers; probabilities of label 1, softened by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.prior = (y.sum() + 1) / (len(y) + 2)
        self.fitted = 0 < y.sum() < len(y)
        if not self.fitted:
            return
        rng = np.random.default_rng(7)
        order = rng.permutation(len(y))
        cut = max(1, len(y) // 5)
        check, learn = order[:cut], order[cut:]
        self.shift, self.scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
        z = self._scaled(x)
        w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        first, second, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
                h = np.tanh(z[part] @ w[0] + w[1])
                error = (_sigmoid(h @ w[2] + w[3]) - y[part]) / max(1, len(part))
                back = np.outer(error, w[2]) * (1 - h * h)
                slopes = [z[part].T @ back + DECAY * w[0], back.sum(axis=0), h.T @ error + DECAY * w[2], error.sum(keepdims=True)]
                step += 1
                for k, slope in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                    w[k] = w[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        self.w = w
        raw = self._raw(x[check])

        def loss(t: float) -> float:
            p = np.clip(_sigmoid(raw / t), 1e-9, 1 - 1e-9)
            return float(-(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)).mean())

        self.temperature = min(np.geomspace(0.25, 8, 101), key=loss)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -8, 8)

    def _raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._raw(x) / self.temperature) if self.fitted else np.full(len(x), self.prior)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class QualityModel:
    """Word vectors of a table and the network fitted on its labelled rows."""

    def __init__(self, docs: DataFrame, labels: DataFrame, *, label: str = "quality", train_rows: int = TRAIN_ROWS):
        vectors = word_vectors(context_sums(docs))
        context = docs.sparkSession.sparkContext
        self.vectors = context.broadcast(vectors)
        shared = self.vectors
        marked = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("double").alias("y"))
                  .where("id is not null and y is not null").where(held_out("id", FOLDS) != 0)
                  .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
        chosen = marked.orderBy(F.xxhash64("id"), "id").limit(train_rows)
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, at in chunks(batches):
                x = features(shared.value, data, at).astype(np.float32)
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"), "y": part.column("y"), "x": pa.array([r.tobytes() for r in x], pa.binary())})

        found = in_batches(rows).mapInArrow(describe, "id long, y int, x binary").collect()
        found.sort(key=lambda r: (r["id"], r["x"]))
        x = np.array([np.frombuffer(r["x"], np.float32) for r in found], dtype=float).reshape(-1, INPUTS)
        self.network = context.broadcast(Network(x, np.array([r["y"] for r in found], dtype=float)))

    def scored(self, docs: DataFrame) -> DataFrame:
        """(doc_id, held_out, score) of every row."""
        vectors, network = self.vectors, self.network

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, at in chunks(batches):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                    "score": pa.array(network.value.score(features(vectors.value, data, at)))})

        out = F.coalesce(held_out("doc_id", FOLDS) == 0, F.lit(True)).alias("held_out")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", out, "text")
        return in_batches(rows).mapInArrow(score, "doc_id long, held_out boolean, score double")

    def accepted(self, docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
        """The rows of docs that score ``accept`` at least, with all their columns."""
        vectors, network, place = self.vectors, self.network, docs.columns.index("text")

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first = 0
                texts = pa.RecordBatch.from_pydict({"text": batch.column(place)})
                for part, data, at in chunks(iter([texts])):
                    good = network.value.score(features(vectors.value, data, at)) >= accept
                    yield batch.slice(first, part.num_rows).filter(pa.array(good))
                    first += part.num_rows

        return in_batches(docs).mapInArrow(keep, docs.schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    return QualityModel(docs, labels).scored(docs).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
