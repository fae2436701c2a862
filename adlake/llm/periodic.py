"""Periodic runs of words: stretches that repeat with a period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
of at least MIN_REPEATS * q and MIN_WORDS words that no neighbouring word extends.

Method
  * Longest common extensions of two places come from a difference cover: only places whose
    number modulo COVER_MOD lies in COVER have their suffixes sorted (by blocks of COVER_MOD
    words, then by doubling). Any two places are fewer than COVER_MOD words before two sorted
    ones, so that many words are compared, and the rest is a range minimum, by a sparse
    table, over the common lengths of neighbouring sorted suffixes. Backward extensions are
    the same on the words in reverse.
  * For every period q a grid is laid whose step is the shortest stretch of matching pairs
    that a run has; each run meets its grid. All grids of a text together are harmonic in
    its length. A place of the grid is extended both ways; what is long enough is a run.
  * Several texts are handled together, as one array; no suffix is compared across texts. A
    text joins the sort only if some place of its grids matches for COVER_MOD words.

Defined cases: a null text has no words. Null keys and repeated rows stay rows of their own
(``planted`` leaves a text with a null key as it is). Words are compared exactly, case
counts. An empty table gives an empty result; other columns than doc_id and text are not
read, whatever their names. A text is handled whole; memory grows with the longest one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import in_batches
from adlake.llm.words import chunks

MIN_REPEATS = 4
MIN_WORDS = 6
COVER_MOD = 7
COVER = (0, 1, 3)  # every difference modulo COVER_MOD is that of two of these
PAIRS = 1 << 18  # places of grids looked at together

# _SHIFT[(j - i) % COVER_MOD]: the residue to which i moves so that j moves into COVER too
_SHIFT = np.array([next(x for x in COVER if (x + d) % COVER_MOD in COVER) for d in range(COVER_MOD)])


class Extensions:
    """Longest common extensions to the right, of places in ``ids`` within one text.

    Text t is ids[ptr[t]:ptr[t + 1]]; ids are at least 1.
    """

    def __init__(self, ids: np.ndarray, ptr: np.ndarray):
        sizes = np.diff(ptr)
        self.ids, self.end = ids, np.repeat(ptr[1:], sizes)
        self.rel = np.arange(len(ids)) - np.repeat(ptr[:-1], sizes)
        sampled = np.isin(self.rel % COVER_MOD, COVER)
        self.at = np.flatnonzero(sampled)
        self.slot = np.full(len(ids), -1, np.int32)
        self.slot[self.at] = np.arange(len(self.at), dtype=np.int32)
        self._sort(np.repeat(np.arange(len(sizes)), sizes)[self.at])

    def _word(self, places: np.ndarray, offset: int) -> np.ndarray:
        """The word some places on; 0 beyond the text."""
        to = places + offset
        inside = to < self.end[places]
        return np.where(inside, self.ids[np.where(inside, to, 0)], 0)

    def _blocks(self, text: np.ndarray) -> list[np.ndarray]:
        """COVER_MOD words of each sorted place, several to a number, least significant first."""
        bits = int(self.ids.max(initial=1)).bit_length()
        per = max(1, 62 // bits)
        keys = []
        for first in range(0, COVER_MOD, per):
            key = np.zeros(len(self.at), np.int64)
            for offset in range(first, min(first + per, COVER_MOD)):
                key = (key << bits) | self._word(self.at, offset)
            keys.append(key)
        return [*reversed(keys), text]

    def _sort(self, text: np.ndarray) -> None:
        """Ranks of the sampled suffixes by their first COVER_MOD * 2**k words for every k; a
        rank is the place of the first one alike."""
        m = len(self.at)
        keys = self._blocks(text)
        order = np.lexsort(keys)
        differs = np.ones(m, bool)
        if m:
            differs[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        rank = np.empty(m, np.int32)
        rank[order] = np.maximum.accumulate(np.where(differs, np.arange(m), 0))
        levels, step = [rank], COVER_MOD
        while True:
            alone = np.bincount(rank, minlength=m)[rank] == 1
            tied = np.flatnonzero(~alone)
            if not len(tied):
                break
            to = self.at[tied] + step
            inside = to < self.end[self.at[tied]]
            after = np.where(inside, rank[self.slot[np.where(inside, to, 0)]], -1)
            by = np.lexsort((after, rank[tied]))
            group, after, tied = rank[tied][by], after[by], tied[by]
            fresh = np.ones(len(tied), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
            first = np.ones(len(tied), bool)
            first[1:] = group[1:] != group[:-1]
            number = np.arange(len(tied))
            begin = np.maximum.accumulate(np.where(first, number, 0))
            rank = rank.copy()
            rank[tied] = group + np.maximum.accumulate(np.where(fresh, number, 0)) - begin
            levels.append(rank)
            step *= 2
        self.rank = rank
        self._table(levels)

    def _table(self, levels: list[np.ndarray]) -> None:
        """Common lengths of neighbouring sorted suffixes, and their minima over 2**k neighbours."""
        m = len(self.at)
        suffix = np.empty(m, np.int64)
        suffix[self.rank] = self.at
        a, b = suffix[:-1].copy(), suffix[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int32)
        last = [self.end[a] - 1, self.end[b] - 1]
        for k in range(len(levels) - 1, -1, -1):
            inside = (a <= last[0]) & (b <= last[1])
            left, right = (levels[k][self.slot[np.where(inside, x, suffix[0] if m else 0)]] for x in (a, b))
            step = np.where(inside & (left == right), COVER_MOD << k, 0)
            a, b, common = a + step, b + step, common + step.astype(np.int32)
        going = self.end[suffix[:-1]] == self.end[suffix[1:]]  # within one text
        for _ in range(COVER_MOD - 1):
            going &= (a <= last[0]) & (b <= last[1])
            going[going] = self.ids[a[going]] == self.ids[b[going]]
            a, b, common = a + going, b + going, common + going
        self.minima = [common.astype(np.int32)]
        while (width := 1 << len(self.minima)) <= len(common):
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:len(common) - width + 1], below[width // 2:][:len(common) - width + 1]))

    def _of_sorted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common lengths of two different sampled suffixes: a range minimum."""
        low = np.minimum(a, b)
        width = np.maximum(a, b) - low
        level = np.frexp(width.astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            table = self.minima[k]
            out[here] = np.minimum(table[low[here]], table[low[here] + width[here] - (1 << k)])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j, in one text)."""
        to_sample = (_SHIFT[(j - i) % COVER_MOD] - self.rel[i]) % COVER_MOD
        out = np.zeros(len(i), np.int64)
        going = np.ones(len(i), bool)
        for offset in range(COVER_MOD - 1):
            now = np.flatnonzero(going & (to_sample > offset))
            to = j[now] + offset
            inside = to < self.end[j[now]]
            same = inside & (self.ids[i[now] + offset] == self.ids[np.where(inside, to, 0)])
            out[now] += same
            going[now] = same
        now = np.flatnonzero(going)
        now = now[j[now] + to_sample[now] < self.end[j[now]]]
        a, b = (self.rank[self.slot[x[now] + to_sample[now]]].astype(np.int64) for x in (i, j))
        out[now] += self._of_sorted(a, b)
        return out


def _grids(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in it, period): the places of all grids, about PAIRS at a time."""
    periods = np.where(sizes >= MIN_WORDS, sizes // MIN_REPEATS, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(MIN_WORDS, MIN_REPEATS * q) - q
    places = (sizes[text] - q) // step
    total = np.cumsum(places)
    row = 0
    while row < len(text):
        stop = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + PAIRS, "right")))
        n = places[row:stop]
        which = np.repeat(np.arange(row, stop), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + 1
        yield text[which], k * step[which] - 1, q[which]
        row = stop


def _few(ids: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """Words alike from i and j on, one way, at most COVER_MOD and what room there is."""
    out = np.zeros(len(i), np.int64)
    now = np.arange(len(i))
    for offset in range(COVER_MOD):
        now = now[room[now] > offset]
        now = now[ids[i[now] + way * offset] == ids[j[now] + way * offset]]
        out[now] += 1
    return out


def runs(ids: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    Text t is ids[ptr[t]:ptr[t + 1]]; equal ids, of at least 1, are equal words.
    """
    sizes = np.diff(ptr)
    found, open_ = [], []
    for text, place, q in _grids(sizes):
        i = ptr[text] + place
        hit = ids[i] == ids[i + q]
        text, place, q, i = text[hit], place[hit], q[hit], i[hit]
        ahead = _few(ids, i, i + q, sizes[text] - place - q, 1)
        back = _few(ids, i - 1, i + q - 1, place, -1)
        far = (ahead == COVER_MOD) | (back == COVER_MOD)
        rows = np.stack([text, i, q, ahead, back])
        found.append(rows[:, ~far])
        open_.append(rows[:, far])
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    far = np.concatenate(open_, axis=1)
    if far.shape[1]:
        found.append(_extended(ids, ptr, far))
    text, i, q, ahead, back = np.concatenate(found, axis=1)
    start, length = i - back, q + ahead + back
    keep = length >= np.maximum(MIN_WORDS, MIN_REPEATS * q)
    text, start, length, q = text[keep], start[keep], length[keep], q[keep]
    order = np.lexsort((q, length, start))
    text, start, length, q = (x[order] for x in (text, start, length, q))
    least = np.ones(len(q), bool)  # multiples of a stretch's smallest period go
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, q = (x[least] for x in (text, start, length, q))
    order = np.lexsort((q, start))
    return text[order], (start - ptr[text])[order], length[order], q[order]


def _extended(ids: np.ndarray, ptr: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows (text, place, period, ahead, back) with whole extensions."""
    text, i, q, ahead, back = rows
    used = np.unique(text)
    sizes = np.diff(ptr)[used]
    local = np.concatenate(([0], np.cumsum(sizes)))
    moved = np.repeat(ptr[used] - local[:-1], sizes)
    some = ids[np.arange(local[-1]) + moved]
    at = i - (ptr[used] - local[:-1])[np.searchsorted(used, text)]
    long = ahead == COVER_MOD
    if long.any():
        ahead = ahead.copy()
        ahead[long] = Extensions(some, local)(at[long], at[long] + q[long])
    long = back == COVER_MOD
    if long.any():
        n = len(some)
        back = back.copy()
        # the words before a place, read backwards; the earlier one is then the later
        back[long] = Extensions(some[::-1], n - local[::-1])(n - at[long] - q[long], n - at[long])
    return np.stack([text, i, q, ahead, back])


def planted(key, words: list[bytes]) -> list[bytes]:
    """The words, from a place on repeated with a period, in every tenth text by its key's crc32."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[:n - a]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic(documents: DataFrame, plant: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start and period, and its words
    joined by single spaces without those that some run repeats (all after its first period).

    ``plant`` puts periodic ends into some texts first (``planted``).
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in chunks(batches):
            keys = batch.column("doc_id").to_pylist()
            texts = [data[a:b].tobytes().split() for a, b in zip(at[:-1], at[1:], strict=True)]
            if plant:
                texts = [planted(k, t) for k, t in zip(keys, texts, strict=True)]
            ptr = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            seen: dict[bytes, int] = {}
            ids = np.fromiter(map(seen.setdefault, chain.from_iterable(texts), count(1)), np.int64, int(ptr[-1]))
            text, start, length, period = runs(ids, ptr)
            change = np.zeros(len(ids) + 1, np.int64)
            np.add.at(change, ptr[text] + start + period, 1)
            np.add.at(change, ptr[text] + start + length, -1)
            keep = np.cumsum(change)[:-1] == 0
            whole = np.ones(len(texts), bool)
            whole[text] = False
            collapsed = [b" ".join(t if whole[k] else compress(t, keep[ptr[k]:ptr[k + 1]]))
                         for k, t in enumerate(texts)]
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_batches(rows).mapInArrow(per_batch, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic``: number of runs, the longest (ties: first, then shortest period),
    and SHA-256 of the list of runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                        F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").alias("lines"))
    return rows.select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("(1000 * top.length) div -top.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
