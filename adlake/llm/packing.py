"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens. In each round every queue is granted its share of one
window, whole tokens only; the fraction it lacks stays as its deficit and is granted as soon
as it amounts to a token. The rounds' grants, one after another, are cut into windows of
``window`` tokens, so every window but the last is full and holds each source in its overall
proportion to within about a token.

The grant up to round r is a monotone function of r alone (share times r, rounded down), so
a task knows the deficits of any round without those before it: the deficits carry over
windows and partitions alike, and no queue passes through one task. What is shared is one
total per queue.

Defined cases: a null text is empty, and an empty text is its end token alone. A null source
is a queue of its own. Rows are packed one by one, so repeated rows and keys stay. Beyond
MAX_QUEUES sources, those with the fewest tokens share one queue; all rows are packed all
the same. Other columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.llm.common import in_batches, written
from adlake.llm.words import give_back

WINDOW = 4096
END = 2
MAX_QUEUES = 1024
KEPT_STEMS = 500_000  # encodings of letters that a worker remembers, twice as many at most; only for speed
KEPT_WORDS = 125_000  # and of other words
LONG_WORD = 64  # not remembered
BATCH_TOKENS = 1 << 20  # of rows that are cut at once
ROUNDS = 4096  # looked at together
PIECES = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder(dict):
    """Token ids of words, as bytes, learned as they are asked for.

    The tokenizer drops spaces and line ends, and parts letters from marks, so words are
    encoded on their own, and letters of Latin-1 apart from the marks that follow them. The
    ids of letters are in ``stems``; the dictionary itself holds those of all other words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.marks: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = _byte_letters() if _parts_letters(self.tokenizer) else None

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, letters: str) -> bytes:
        """Ids of lower-cased letters. They are remembered apart from the words that hold them:
        the same letters stand with many marks and in either case. When the memory is full it
        becomes the older half, from which what is still used is taken over."""
        ids = self.stems.get(letters)
        if ids is None:
            ids = self.older.pop(letters, None)
            if ids is None:
                plain = letters if letters.isascii() else _in_bytes(letters, self.letters)
                ids = array(self.code, [t.id for t in self.model.tokenize(plain)]).tobytes()
            if len(letters) <= LONG_WORD:
                if len(self.stems) >= KEPT_STEMS:
                    self.older, self.stems = self.stems, {}
                self.stems[letters] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self._ids(word)
        if len(word) <= LONG_WORD:
            if len(self) > KEPT_WORDS:
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids

    def word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS)
        marks = word[len(letters):]
        if not self.letters or len(marks) > MOST_MARKS or not _LETTERS.fullmatch(letters):
            return self[word]
        ids = self._stem(letters.lower())
        if not marks:
            return ids
        if marks not in self.marks:
            self.marks[marks] = self._ids(marks)
        return ids + self.marks[marks]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: none). Every distinct word of ``texts`` is looked up once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        # No word holds a space, so they leave Arrow as one string.
        spaced = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct.cast(pa.string())), " ")[0].as_py()
        names = spaced.split(" ")
        ids = [self.word(w) if i is None else i for w, i in zip(names, map(self.stems.get, names), strict=True)]
        ids = pa.array(ids, pa.large_binary()).take(coded.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, dtype=np.int64)[words.offsets.to_numpy()].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [raw[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
MARKS = ".,!?;:&%$#*|"
MOST_MARKS = 8  # that are remembered together


def _byte_letters() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    name = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return "".join(name[b] for b in range(256))


def _in_bytes(letters: str, alphabet: str) -> str:
    return codecs.charmap_decode(letters.encode(), "strict", alphabet)[0]


def _parts_letters(tokenizer) -> bool:
    """Whether letters may be encoded apart: shown on words that hold every letter."""
    table = _byte_letters()
    probe = ["the", "caf\u00e9", "\u00dcber", *("a" + chr(c) + "b" for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))]
    for word in probe:
        for marks in ("", ",", ".!?", "###"):
            whole = tokenizer.encode(word + marks, add_special_tokens=False).ids
            apart = [t.id for t in tokenizer.model.tokenize(_in_bytes(word.lower(), table))]
            if whole != apart + (tokenizer.encode(marks, add_special_tokens=False).ids if marks else []):
                return False
    return True


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker; what it has learned serves its next tasks too, until pieces are cut."""
    return Encoder(path)


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each row's ids, and its place among the rows of its source in its partition."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, taken = encoder(tokenizer), {}
        end, width = array(words.code, [END]).tobytes(), array(words.code).itemsize
        for batch in batches:
            sources = batch.column("source").to_pylist()
            at, sizes, coded = [], [], []
            for source, ids in zip(sources, words.encode_all(batch.column("text")), strict=True):
                ids += end
                at.append(taken.get(source, 0))
                sizes.append(len(ids) // width)
                coded.append(ids)
                taken[source] = at[-1] + sizes[-1]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "source": batch.column("source"), "part": batch.column("part"),
                "at": pa.array(at, pa.int64()), "n": pa.array(sizes, pa.int64()), "ids": pa.array(coded, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("text"), F.spark_partition_id().cast("long").alias("part"))
    return in_batches(rows).mapInArrow(encode, "doc_id long, source string, part long, at long, n long, ids binary")


class Grants:
    """Tokens granted to each queue up to a round; monotone, 0 at 0 and all at the last."""

    def __init__(self, totals: list[int], window: int):
        self.totals = np.array(totals, dtype=np.int64)
        self.rounds = max(1, -(-int(self.totals.sum()) // window))
        self.whole = self.totals // self.rounds
        self.share = (self.totals % self.rounds) / self.rounds

    def upto(self, rounds: np.ndarray, queue) -> np.ndarray:
        some = np.floor(rounds * self.share[queue]).astype(np.int64) + rounds * self.whole[queue]
        return np.where(rounds >= self.rounds, self.totals[queue], some)

    def round_of(self, token: np.ndarray, queue: int) -> np.ndarray:
        """The round that grants each token of a queue."""
        r = (token * (self.rounds / self.totals[queue])).astype(np.int64).clip(0, self.rounds - 1)
        while (late := self.upto(r, queue) > token).any():
            r = r - late
        while (early := self.upto(r + 1, queue) <= token).any():
            r = r + early
        return r

    def places(self, queue: int, first: np.ndarray, n: np.ndarray):
        """Runs of the tokens first..first+n of each row of a queue: the row, the run's start
        in the queue, its length, and its place among all tokens."""
        if self.whole[queue]:  # some tokens in every round
            low, high = self.round_of(first, queue), self.round_of(first + n - 1, queue)
            row = np.repeat(np.arange(len(n)), high - low + 1)
            rounds = np.arange(len(row)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[row]
        else:  # one token at most
            row = np.repeat(np.arange(len(n)), n)
            rounds = self.round_of(np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row], queue)
        begin = np.maximum(self.upto(rounds, queue), first[row])
        stop = np.minimum(self.upto(rounds + 1, queue), (first + n)[row])
        place = np.empty(len(rounds), dtype=np.int64)
        every = np.arange(len(self.totals))
        for i in range(0, len(rounds), ROUNDS):
            r = rounds[i:i + ROUNDS, None]
            before = self.upto(r, every)
            granted = self.upto(r + 1, every[:queue]) - before[:, :queue]
            place[i:i + ROUNDS] = before.sum(axis=1) + granted.sum(axis=1) - before[:, queue]
        return row, begin, stop - begin, place + begin


def cut(row: np.ndarray, begin: np.ndarray, length: np.ndarray, place: np.ndarray, window: int):
    """Runs cut at the ends of windows, and joined where they follow each other in one."""
    n = (place + length - 1) // window - place // window + 1
    run = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    low = np.maximum(place[run], (place[run] // window + k) * window)
    high = np.minimum((place + length)[run], (place[run] // window + k + 1) * window)
    begin, row = begin[run] + low - place[run], row[run]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (low[1:] != high[:-1]) | (low[1:] % window == 0) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], begin[at], np.add.reduceat(high - low, at), low[at]


def pack(docs: DataFrame, *, tokenizer: str | None = None, window: int = WINDOW, max_queues: int = MAX_QUEUES) -> DataFrame:
    """Pieces of all rows of docs (doc_id, source, text) in windows; see PIECES.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers; ``start`` counts the
    row's ids before the piece; ``doc_tokens`` counts them all, with the end token.
    """
    spark = docs.sparkSession
    rows = written(tokenized(docs, tokenizer or default_tokenizer()), "tokens")
    held = written(rows.groupBy("source", "part").agg(F.sum("n").alias("tokens")), "held")
    large = (held.groupBy("source").agg(F.sum("tokens").alias("tokens"))
             .orderBy(F.desc("tokens"), "source").limit(max_queues - 1).collect())
    named = spark.createDataFrame([(r["source"], q + 1) for q, r in enumerate(large)], "named string, queue int")
    placed = held.join(F.broadcast(named), held.source.eqNullSafe(named.named), "left").drop("named")
    placed = placed.withColumn("queue", F.coalesce("queue", F.lit(0)))
    before = W.partitionBy("queue").orderBy("part", "source").rowsBetween(W.unboundedPreceding, -1)
    placed = written(placed.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))), "queues")
    totals = [0] * (len(large) + 1)
    for r in placed.groupBy("queue").agg(F.sum("tokens").alias("tokens")).collect():
        totals[r["queue"]] = r["tokens"]
    grants = Grants(totals, window)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # all rows are encoded, and what the worker has learned would stay with it
        give_back()
        for whole in batches:
            sizes = np.cumsum(whole.column("n").to_numpy())
            at = 0
            while at < whole.num_rows:
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_TOKENS)))
                yield of_rows(whole.slice(at, stop - at))
                at = stop

    def of_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        queue, first, n = (batch.column(c).to_numpy() for c in ("queue", "first", "n"))
        found = []
        for q in np.unique(queue).tolist():
            rows = np.flatnonzero(queue == q)
            row, begin, length, place = cut(*grants.places(q, first[rows], n[rows]), window)
            found.append((rows[row], begin, length, place))
        row, begin, length, place = (np.concatenate(c) for c in zip(*found, strict=True))
        start = begin - first[row]
        ids, at = [], np.argsort(row, kind="stable")
        last, held = -1, b""
        for r, a, m in zip(row[at].tolist(), start[at].tolist(), length[at].tolist(), strict=True):
            if r != last:
                raw = batch.column("ids")[r].as_py()
                held = raw if len(raw) == 4 * n[r] else np.frombuffer(raw, dtype="<u2").astype("<u4").tobytes()
                last = r
            ids.append(held[4 * a:4 * (a + m)])
        row, start, length, place = row[at], start[at], length[at], place[at]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), batch.column("source").take(pa.array(row)), pa.array(start),
             pa.array(length), pa.array(n[row]), pa.array(place // window), pa.array(place % window), pa.array(ids, pa.binary())],
            names=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    here = placed.select(F.col("source").alias("of"), F.col("part").alias("in_part"), "queue", "before")
    at = rows.join(here, rows.source.eqNullSafe(here.of) & (rows.part == here.in_part))
    at = at.select("doc_id", "source", "queue", (F.col("before") + F.col("at")).alias("first"), "n", "ids")
    return in_batches(at).mapInArrow(pieces, PIECES)
