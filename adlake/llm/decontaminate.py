"""Benchmark decontamination: SimHash windows, multi-index Hamming lookup, exact check.

Method
  * Words are lower-cased (sharp s as ss) and bare of ASCII punctuation; an item is its run
    of words, and a window is a run of as many words of a document, or all of a document that
    has fewer. Both are weighted sets: five-word shingles with their counts.
  * A window that holds no shingle of an item of its length has no likeness to any, so only
    windows around such shingles get a 64-bit SimHash, from running sums over the document.
  * Items are indexed in BLOCKS blocks of their fingerprint, each under every value within
    RADIUS // BLOCKS flips. By the pigeonhole principle every window within RADIUS flips of
    an item meets it in one block at least. RADIUS is wide: likeness 0.8 leaves about ten
    flips of 64.
  * What is found is checked exactly: sum of the smaller counts over sum of the larger.

Of the windows that match an item, the best (earliest on ties) stands for each run of
overlapping ones.

Defined cases: null or wordless texts and items match nothing. An item of fewer than five
words is one shingle and matches only a text of just these words. Repeated rows and items match
each on their own. Other columns are not read. The items go to every task and are bounded: beyond MAX_ITEM_BYTES the call fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import in_batches
from adlake.llm.words import Words, chunks, shingles, split_words, text_buffers

WIDTH = 5
THRESHOLD = (4, 5)
BITS, BLOCKS, RADIUS = 64, 8, 23
MAX_ITEM_BYTES = 64 << 20
MATCHES = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"
_U = np.uint64
_PLAIN = np.ones(256, dtype=bool)
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = False


def folded(texts: pa.Array) -> pa.Array:
    """Texts without difference of case, in any alphabet."""
    return pc.replace_substring(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), "\u00df", "ss")


def bare_words(data: np.ndarray, at: np.ndarray) -> Words:
    """Words without ASCII punctuation."""
    keep = _PLAIN[data]
    return split_words(data[keep], np.concatenate(([0], np.cumsum(keep)))[at])


def simhash(values: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs values[begin:stop]; a value counts as often as it occurs."""
    sign = (np.unpackbits(values.astype(">u8").view(np.uint8)).reshape(-1, BITS).astype(np.int32) << 1) - 1
    sums = np.zeros((len(values) + 1, BITS), dtype=np.int32)
    np.cumsum(sign, axis=0, out=sums[1:])
    return np.packbits(sums[stop] > sums[begin], axis=1).view(">u8").astype(np.uint64).ravel()


def flips(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def weighted_likeness(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sums of the smaller and of the larger counts of two multisets."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[i], cb[j]).sum())
    return both, len(a) + len(b) - both


class ItemIndex:
    """Benchmark items by length, by shingle, and by blocks of their fingerprints."""

    def __init__(self, ids: list[int], texts: list[str], width: int = WIDTH):
        words = bare_words(*text_buffers(folded(pa.array(texts, pa.large_string()))))
        values, ptr = shingles(words, width)
        count = np.diff(words.ptr)
        some = np.flatnonzero(count)
        self.width = width
        self.ids = np.array(ids, dtype=np.int64)[some]
        self.length = count[some]
        self.values = [values[ptr[i]:ptr[i + 1]] for i in some]
        flat = np.concatenate(self.values) if self.values else np.empty(0, _U)
        at = np.concatenate(([0], np.cumsum([len(v) for v in self.values]))).astype(np.int64)
        self.prints = simhash(flat, at[:-1], at[1:]) if len(flat) else np.empty(0, _U)
        # shingle -> lengths of the items that hold it
        pairs = np.unique(np.stack([flat, np.repeat(self.length, np.diff(at)).astype(np.uint64)], axis=1), axis=0) \
            if len(flat) else np.empty((0, 2), _U)
        self.shingle, first = np.unique(pairs[:, 0], return_index=True)
        self.shingle_at = np.append(first, len(pairs))
        self.shingle_length = pairs[:, 1].astype(np.int64)
        # block value -> items within so many flips of it
        near = RADIUS // BLOCKS
        byte = np.arange(256, dtype=np.uint8)
        close = np.bitwise_count(byte[:, None] ^ byte[None, :]) <= near
        self.block = [close[:, self._byte(self.prints, b)] for b in range(BLOCKS)]

    @staticmethod
    def _byte(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> _U(8 * block)) & _U(255)).astype(np.intp)

    def near(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, flips) of all items of a length within RADIUS of the windows."""
        items = np.flatnonzero(self.length == length)
        met = np.zeros((len(prints), len(items)), dtype=bool)
        for b in range(BLOCKS):
            met |= self.block[b][self._byte(prints, b)][:, items]
        w, k = np.nonzero(met)
        apart = flips(prints[w], self.prints[items[k]])
        close = apart <= RADIUS
        return w[close], items[k[close]], apart[close]

    def matches(self, values: np.ndarray, n_words: int, num: int, den: int) -> list[tuple[int, int, int, int, float]]:
        """(item id, first word, words, flips, likeness) in a document's run of shingles."""
        if not len(values) or not len(self.shingle):
            return []
        at = np.searchsorted(self.shingle, values).clip(max=len(self.shingle) - 1)
        hit = np.flatnonzero(self.shingle[at] == values)
        if not len(hit):
            return []
        hits: dict[int, list[int]] = {}
        for p, s in zip(hit.tolist(), at[hit].tolist(), strict=True):
            for length in self.shingle_length[self.shingle_at[s]:self.shingle_at[s + 1]].tolist():
                hits.setdefault(length, []).append(p)
        out = []
        for length, places in sorted(hits.items()):
            size = min(length, n_words)  # a shorter text is one window
            span = max(1, size - self.width + 1)  # shingles of a window
            if (length < self.width and n_words != length) or den * span < num * (length - self.width + 1):
                continue
            first = np.unique((np.array(places)[:, None] - np.arange(span)[None, :]).ravel())
            first = first[(first >= 0) & (first + span <= len(values))]
            if not len(first):
                continue
            low = int(first[0])
            part = values[low:int(first[-1]) + span]
            prints = simhash(part, first - low, first - low + span)
            best: dict[int, list[tuple[int, int, float]]] = {}
            for w, item, apart in zip(*(x.tolist() for x in self.near(prints, length)), strict=True):
                begin = int(first[w])
                both, either = weighted_likeness(values[begin:begin + span], self.values[item])
                if both * den >= num * either:
                    best.setdefault(item, []).append((begin, apart, both / either))
            for item, found in best.items():
                kept: list[tuple[int, int, float]] = []
                for one in sorted(found):
                    if kept and one[0] < kept[-1][0] + size:
                        if one[2] > kept[-1][2]:
                            kept[-1] = one
                    else:
                        kept.append(one)
                out += [(int(self.ids[item]), begin, size, apart, like) for begin, apart, like in kept]
        return out


def item_index(benchmark: DataFrame, *, key: str = "item_id", text: str = "text") -> ItemIndex:
    rows = benchmark.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    if size > MAX_ITEM_BYTES:
        raise ValueError(f"{size} bytes of items; {MAX_ITEM_BYTES} fit into a task: split the benchmark")
    found = rows.where("id is not null").orderBy("id", "text").collect()
    return ItemIndex([r["id"] for r in found], [r["text"] for r in found])


def contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Every place (MATCHES) where a document holds a window like a benchmark item."""
    index = docs.sparkSession.sparkContext.broadcast(item_index(benchmark))
    num, den = threshold

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        plain = (pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": folded(b.column("text"))}) for b in batches)
        for rows, data, at in chunks(plain):
            words = bare_words(data, at)
            values, ptr = shingles(words, items.width)
            # Most documents hold no shingle of any item: one lookup for all of them.
            found = np.zeros(len(values) + 1, dtype=np.int64)
            if len(items.shingle) and len(values):
                k = np.searchsorted(items.shingle, values).clip(max=len(items.shingle) - 1)
                np.cumsum(items.shingle[k] == values, out=found[1:])
            out = []
            for i in np.flatnonzero(found[ptr[1:]] > found[ptr[:-1]]):
                doc = rows.column("doc_id")[int(i)].as_py()
                n = int(words.ptr[i + 1] - words.ptr[i])
                out += [(doc, *m) for m in items.matches(values[ptr[i]:ptr[i + 1]], n, num, den)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()), strict=True)],
                    names=["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(search, MATCHES)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item. Rows without a key are judged by their text."""
    index = docs.sparkSession.sparkContext.broadcast(item_index(benchmark))
    num, den = THRESHOLD
    names, schema = docs.columns, docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, place = index.value, names.index("text")
        for batch in batches:
            first = 0
            plain = pa.RecordBatch.from_pydict({"text": folded(batch.column(place))})
            for rows, data, at in chunks(iter([plain])):
                words = bare_words(data, at)
                values, ptr = shingles(words, items.width)
                good = [not items.matches(values[ptr[i]:ptr[i + 1]], int(words.ptr[i + 1] - words.ptr[i]), num, den)
                        for i in range(rows.num_rows)]
                yield batch.slice(first, rows.num_rows).filter(pa.array(good, pa.bool_()))
                first += rows.num_rows

    return in_batches(docs).mapInArrow(keep, schema)
