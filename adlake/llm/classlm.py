"""Brown class-based n-gram model: exchange clustering, class transitions, word emissions.

Method
  * Tokens are the lower-cased words of a text and one end. Counts of all words come from all
    training rows and stay distributed.
  * Every training word has a class of its own choice; words not met in training fall to one
    of AFFIXES units by their last bytes, and take that unit's class.
  * Bigrams are counted over all training rows, once, with the HEAD most frequent words by name
    and the others by their affix. They travel as arrays: a task sorts the bigrams of some texts
    and sends one row to each slice, whose rows another task merges. Each unit's neighbours lie
    in one row, which has a bound.
  * A start: the UNITS most frequent words and the affixes are exchanged on the driver, and
    every word takes its unit's class.
  * Exchange clustering in rounds over the head and the affixes: a task looks up the classes
    around its units, and each unit moves to its best class given the table of class bigrams.
    Nothing is shuffled but that table. Rounds end when one gains less than MIN_GAIN a token,
    in natural logarithms.
  * Then one last round over all other words, each by its own neighbours; one beyond the head
    counts there with its affix's class, which all of them have until then.
  * A round is weighed by the likelihood of all bigrams under the classes that it gives. One
    that loses is taken back and half as many words move.
  * log10 p(w | v) = log10 p(class w | class v) + log10 p(w | class w). Transitions are
    smoothed by the classes' own frequency, emissions by adding one, with one unknown word
    per class; so the sum over the words after any word is one.

The counts and classes of the words of a text meet the text by a shuffle on word hashes. The HEAD most
frequent words are looked up in the task instead, which takes the hot keys out of it.

Defined cases: a null text is empty, and an empty text is its end alone. Rows with a null key
are never trained on. Repeated rows are counted and scored one by one. Without training rows
every token is unknown and scores 0. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import PIECE, held_out, in_batches, passing_shuffles, pieces, sum_pieces, summed, written
from adlake.session import discard, run_dir
from adlake.llm.words import Words, chunks, mix, split_words

FOLDS, OUT = 7, 2
UNITS, AFFIXES, AFFIX_BYTES = 768, 256, 3
CLASSES, SWEEPS = 48, 8
HEAD = 1 << 16  # words looked up without a shuffle
FLUSH_TOKENS = 1 << 21  # counted together before they leave a task
BIGRAM_TOKENS = 1 << 19  # whose bigrams are
SMOOTH = 0.5
OUT_ROWS = 1 << 16  # that leave a task together
MIN_GAIN = 1e-3  # of a round, in natural logarithms a token
MOVE_WORDS = 256  # whose moves are weighed together, in some 5 MB for each step
OWN = 2 * CLASSES  # place of a word after itself; before it stand the classes after and before a word
FAR_SLOTS = OWN + 1  # where the classes of neighbours beyond the head begin
PAIR, NEAR, FAR = range(3)  # kinds of counted bigrams
RARE = "word long, c long, class int, slots binary, times binary"
END_HASH = np.uint64(0xE2D0E2D0E2D0E2D1)
_U = np.uint64


def with_ends(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts with an end after each, affix units, and where texts begin."""
    count = np.diff(words.ptr)
    at = words.ptr + np.arange(len(words.ptr))
    hashes = np.full(at[-1], END_HASH)
    affix = np.zeros(at[-1], dtype=np.int64)
    place = np.arange(len(words.hashes)) + np.repeat(np.arange(len(count)), count)
    hashes[place] = words.hashes
    affix[place] = _affix(words)
    return hashes, affix, at


def _affix(words: Words) -> np.ndarray:
    """A unit for each word by its last bytes, letters in lower case."""
    if not len(words.ends):
        return np.empty(0, np.int64)
    lower = words.data | np.where((words.data >= 65) & (words.data <= 90), 32, 0).astype(np.uint8)
    code = np.zeros(len(words.ends), dtype=np.uint64)
    for k in range(1, AFFIX_BYTES + 1):
        at = words.ends - k
        code = (code << _U(8)) | np.where(at >= words.starts, lower[np.maximum(at, 0)], 0).astype(np.uint64)
    return (mix(code + _U(1)) % _U(AFFIXES)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, affix, c): every different word of the training rows of docs, by hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            word = np.concatenate([h for h, _ in held])
            affix = np.concatenate([a for _, a in held])
            found, first, c = np.unique(word, return_index=True, return_counts=True)
            return pa.RecordBatch.from_pydict({
                "word": pa.array(found.view(np.int64)), "affix": pa.array(affix[first].astype(np.int32)), "c": pa.array(c)})

        n = 0
        for _, data, at in chunks(batches):
            hashes, affix, _ = with_ends(split_words(data, at))
            held.append((hashes, affix))
            n += len(hashes)
            if n >= FLUSH_TOKENS:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    found = in_batches(docs.select("text")).mapInArrow(count, "word long, affix int, c long")
    return found.groupBy("word").agg(F.first("affix").alias("affix"), F.sum("c").alias("c"))


BLOBS = "kind int, slice int, keys binary, sizes binary, others binary, times binary"
_COUNTS = {np.dtype(t).itemsize: np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.int64)}


def slices_of(tokens: int) -> int:
    """Slices of the bigrams, each merged by one task: of 2**18 tokens, beyond 1024 of 2**21 at most."""
    return max(1, min(tokens >> 18, 1024), tokens >> 21)


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each hash; the larger the hash, the later the slice."""
    return ((hashes >> _U(32)) * _U(slices) >> _U(32)).astype(np.int64)


def _packed(n: np.ndarray) -> bytes:
    """Counts in the smallest type that holds them."""
    most = n.max(initial=0)
    return n.astype(next(t for t in _COUNTS.values() if most <= np.iinfo(t).max)).tobytes()


def _unpacked(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, _COUNTS[len(raw) // size] if size else np.uint8)


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of BLOBS; what a kind has no use for is null."""
    kind, part, *raw = zip(*rows, strict=True)
    raw = [pa.array(c, pa.binary()) for c in raw]
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), *raw],
                                      names=["kind", "slice", "keys", "sizes", "others", "times"])


def _added(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and the sum of the counts of each."""
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(n[order], first, dtype=np.int64)


def _grouped(df: DataFrame, build: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``build`` makes of all rows (keys, sizes, others, times) of each kind and slice together."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for kind, part, *raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (kind, part) != now:
                    if held:
                        yield from build(*now, held)
                    now, held = (kind, part), []
                held.append(raw)
        if held:
            yield from build(*now, held)

    dealt = df.repartition("kind", "slice").sortWithinPartitions("kind", "slice")
    return in_batches(dealt).mapInArrow(group, schema)


def _joined(raw: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype)


def word_bigrams(docs: DataFrame, head: np.ndarray, slices: int) -> DataFrame:
    """Bigrams of the training rows in BLOBS, one row for each slice of three kinds.

    PAIR: a key is unit * units + next unit. NEAR: a key is a word beyond the head, with the
    number of its others in sizes; each other is the word's affix * (2 * units + 1) + a
    neighbour: the next unit, units + the unit before, or 2 * units if the word itself comes
    next. FAR: key and other are two words beyond the head, one after the other.
    """
    units = len(head) + AFFIXES
    pairs, span = units * units, AFFIXES * (2 * units + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def filled(cut):
            return ((k, a, b) for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a)

        def flush():
            word = np.concatenate([[END_HASH], *(h for h, _ in held)])
            affix = np.concatenate([np.zeros(1, np.int32), *(a for _, a in held)])
            held.clear()
            at = place_in(head, word)
            unit = np.where(at >= 0, at, len(head) + affix).astype(np.int64)
            code = unit[:-1] * units + unit[1:]
            code += _slice_of(mix(code.view(np.uint64)), slices) * pairs
            code, n = np.unique(code, return_counts=True)
            cut = np.searchsorted(code, np.arange(slices + 1) * pairs)
            code %= pairs
            yield _blobs([(PAIR, k, code[a:b].tobytes(), None, None, _packed(n[a:b])) for k, a, b in filled(cut)])
            del code, n
            rare = np.flatnonzero(at < 0)  # the first and the last token are ends
            if not len(rare):
                return
            found, which = np.unique(word[rare], return_inverse=True)
            itself = word[rare + 1] == word[rare]
            near = np.concatenate((unit[rare + 1], units + unit[rare - 1], np.full(itself.sum(), 2 * units)))
            near += np.concatenate((affix[rare], affix[rare], affix[rare[itself]])).astype(np.int64) * (2 * units + 1)
            near += np.concatenate((which, which, which[itself])) * span
            del which
            code, n = np.unique(near, return_counts=True)
            del near
            first = np.searchsorted(code, np.arange(len(found) + 1) * span)
            size, other = np.diff(first).astype(np.uint32), (code % span).astype(np.uint32)
            cut = np.searchsorted(_slice_of(found, slices), np.arange(slices + 1))
            yield _blobs([(NEAR, k, found[a:b].tobytes(), size[a:b].tobytes(), other[first[a]:first[b]].tobytes(),
                           _packed(n[first[a]:first[b]])) for k, a, b in filled(cut)])
            far = rare[at[rare + 1] < 0]
            if not len(far):
                return
            far = far[np.argsort(word[far])]
            cut = np.searchsorted(_slice_of(word[far], slices), np.arange(slices + 1))
            yield _blobs([(FAR, k, word[far[a:b]].tobytes(), None, word[far[a:b] + 1].tobytes(), _packed(np.ones(b - a, np.int64)))
                          for k, a, b in filled(cut)])

        n = 0
        for _, data, at in chunks(batches):
            hashes, affix, _ = with_ends(split_words(data, at))
            held.append((hashes, affix.astype(np.int32)))
            n += len(held[-1][0])
            if n >= BIGRAM_TOKENS:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    def merge(kind, part, held):
        keys, sizes, others, times = zip(*held, strict=True)
        if kind == PAIR:
            code, n = _added(_joined(keys, np.int64), np.concatenate([_unpacked(t, len(k) // 8) for k, t in zip(keys, times, strict=True)]))
            yield _blobs([(kind, part, code.tobytes(), None, None, _packed(n))])
        elif kind == NEAR:
            n = np.concatenate([_unpacked(t, len(o) // 4) for o, t in zip(others, times, strict=True)])
            found, which = np.unique(_joined(keys, np.uint64), return_inverse=True)
            code, n = _added(np.repeat(which, _joined(sizes, np.uint32)) * span + _joined(others, np.uint32), n)
            size = np.diff(np.searchsorted(code, np.arange(len(found) + 1) * span)).astype(np.uint32)
            yield _blobs([(kind, part, found.tobytes(), size.tobytes(), (code % span).astype(np.uint32).tobytes(), _packed(n))])
        else:
            key, other = _joined(keys, np.uint64), _joined(others, np.uint64)
            order = np.lexsort((other, key))
            key, other = key[order], other[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])))
            yield _blobs([(kind, part, key[first].tobytes(), None, other[first].tobytes(), _packed(np.diff(np.append(first, len(key)))))])

    return _grouped(in_batches(docs.select("text")).mapInArrow(count, BLOBS), merge, BLOBS)


def _bytes(values: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """values[ptr[i]:ptr[i + 1]] as binary rows."""
    return pa.array([values[a:b].tobytes() for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)], pa.binary())


def _values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of binary rows, and the row of each."""
    raw = column.to_pylist()
    size = np.array([len(x) for x in raw], dtype=np.int64) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(raw), dtype=dtype), np.repeat(np.arange(len(raw)), size)


AROUND = "unit int, after binary, after_times binary, before binary, before_times binary"


def unit_rows(bigrams: DataFrame, units: int, slices: int) -> DataFrame:
    """AROUND: the units that come after and before each unit, with their counts."""
    slices = min(slices, units)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, times in zip(batch["keys"].to_pylist(), batch["times"].to_pylist(), strict=True):
                v, w = np.divmod(np.frombuffer(keys, np.int64), units)
                part = np.concatenate((v, w)) % slices
                order = np.argsort(part.astype(np.uint16) if slices <= 1 << 16 else part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(slices + 1))
                key = np.concatenate((v, w)).astype(np.uint32)[order]
                other = np.concatenate((w, v + units)).astype(np.uint32)[order]
                n = np.tile(_unpacked(times, len(v)), 2)[order]
                yield _blobs([(PAIR, k, key[a:b].tobytes(), None, other[a:b].tobytes(), _packed(n[a:b]))
                              for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a])

    def gather(kind, part, held):
        keys, _, others, times = zip(*held, strict=True)
        n = np.concatenate([_unpacked(t, len(o) // 4) for o, t in zip(others, times, strict=True)])
        code = _joined(keys, np.uint32) * np.int64(2 * units) + _joined(others, np.uint32)
        order = np.argsort(code)
        code, n = code[order], n[order]
        unit = np.unique(code // (2 * units))
        other = (code % units).astype(np.int32)
        cut = np.searchsorted(code, np.concatenate((unit[:, None] * 2, unit[:, None] * 2 + 1, unit[:, None] * 2 + 2), axis=1) * units).tolist()
        sides = [(other[a:b].tobytes(), _packed(n[a:b]), other[b:c].tobytes(), _packed(n[b:c])) for a, b, c in cut]
        yield pa.RecordBatch.from_arrays([pa.array(unit.astype(np.int32)), *(pa.array(c, pa.binary()) for c in zip(*sides, strict=True))],
                                         names=["unit", "after", "after_times", "before", "before_times"])

    dealt = in_batches(bigrams.where(F.col("kind") == PAIR).select("keys", "times")).mapInArrow(deal, BLOBS)
    return _grouped(dealt, gather, AROUND)


def _neighbours(b: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All units on a side of the units of a batch of AROUND: which they are, the row, the counts."""
    other, at = _values(b[side], np.int32)
    size = np.bincount(at, minlength=b.num_rows).tolist()
    n = [_unpacked(raw, k) for raw, k in zip(b[f"{side}_times"].to_pylist(), size, strict=True)]
    return other, at, np.concatenate(n)


def rare_words(bigrams: DataFrame, classes: np.ndarray) -> DataFrame:
    """(word, c, class, slots, times): the words beyond the head in their affix's class.

    Slot k is class k after the word, CLASSES + k class k before it, OWN the word after itself;
    neighbours beyond the head have the slots FAR_SLOTS + k instead. ``classes`` has the units'.
    """
    units = len(classes)

    def build(key, ptr, other, n):
        affix, near = np.divmod(other, 2 * units + 1)
        k = near % units
        slot = classes[k] + np.where(near >= units, CLASSES, 0) + np.where(k >= units - AFFIXES, FAR_SLOTS, 0)
        slot[near == 2 * units] = OWN
        before = (near >= units) & (near < 2 * units)  # once for every token
        return {"word": pa.array(key), "c": pa.array(np.add.reduceat(n * before, ptr[:-1])),
                "class": pa.array(classes[units - AFFIXES + affix[ptr[:-1]]].astype(np.int32)),
                "slots": _bytes(slot.astype(np.uint8), ptr), "times": _bytes(n, ptr)}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, sizes, others, times in zip(*(batch[c].to_pylist() for c in ("keys", "sizes", "others", "times")), strict=True):
                key, other = np.frombuffer(keys, np.int64), np.frombuffer(others, np.uint32).astype(np.int64)
                n = _unpacked(times, len(other)).astype(np.int64)
                ptr = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.uint32), dtype=np.int64)))
                for i in range(0, len(key), OUT_ROWS):
                    cut = ptr[i:i + OUT_ROWS + 1]
                    yield pa.RecordBatch.from_pydict(build(key[i:i + OUT_ROWS], cut - cut[0], other[cut[0]:cut[-1]], n[cut[0]:cut[-1]]))

    return in_batches(bigrams.where(F.col("kind") == NEAR).select("keys", "sizes", "others", "times")).mapInArrow(each, RARE)


def far_words(bigrams: DataFrame) -> DataFrame:
    """(key, other, n): how often two words beyond the head follow each other."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, others, times in zip(*(batch[c].to_pylist() for c in ("keys", "others", "times")), strict=True):
                key, other = np.frombuffer(keys, np.int64), np.frombuffer(others, np.int64)
                n = _unpacked(times, len(key)).astype(np.int64)
                for i in range(0, len(key), OUT_ROWS):
                    at = slice(i, i + OUT_ROWS)
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key[at]), "other": pa.array(other[at]), "n": pa.array(n[at])})

    return in_batches(bigrams.where(F.col("kind") == FAR).select("keys", "others", "times")).mapInArrow(each, "key long, other long, n long")


def place_in(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where hashes are in the sorted words, or -1."""
    if not len(words):
        return np.full(len(hashes), -1, dtype=np.int32)
    at = np.searchsorted(words, hashes).clip(max=len(words) - 1)
    return np.where(words[at] == hashes, at, -1).astype(np.int32)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_classes(pair: np.ndarray, old: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The class that gains most for each word, if it alone moves; class 0 is not chosen.

    ``pair`` has the class bigrams; ``right`` and ``left`` (words, classes) how often each
    class follows and precedes a word, ``own`` how often the word follows itself.
    """
    k = np.arange(len(old))
    right, left = right.copy(), left.copy()
    right[k, old] -= own
    left[k, old] -= own

    def along(table, mine, other):
        """Per word and class: what the counts of ``mine`` gain in table[class, place]."""
        word, place = np.nonzero(mine)
        add, at, e = mine[word, place], old[word], np.arange(len(word))
        without, known = table.T[place], xlogx(table).T[place]
        without[e, at] -= add
        known[e, at] = xlogx(without[e, at])
        inner = np.flatnonzero(place == at)
        without[inner] -= other[word[inner]]
        without[inner, at[inner]] -= own[word[inner]]
        known[inner] = xlogx(without[inner])
        gain = xlogx(without + add[:, None]) - known
        out = np.zeros(mine.shape)
        if len(word):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            out[word[first]] = np.add.reduceat(gain, first, axis=0)
        return out

    gain = along(pair, right, left) + along(pair.T, left, right)
    corner = np.tile(np.diagonal(pair), (len(old), 1))
    corner[k, old] -= right[k, old] + left[k, old] + own
    gain += (xlogx(corner + right + left + own[:, None]) + xlogx(corner)
             - xlogx(corner + right) - xlogx(corner + left))
    for mine, sums in ((right, pair.sum(axis=1)), (left, pair.sum(axis=0))):
        size = (mine.sum(axis=1) + own)[:, None]
        sums = np.tile(sums, (len(old), 1))
        sums[k, old] -= size[:, 0]
        gain -= xlogx(sums + size) - xlogx(sums)
    gain[:, 0] = -np.inf
    new = gain.argmax(axis=1)
    return np.where(gain[k, new] > gain[k, old] + 1e-6, new, old)


def chosen(pair: np.ndarray, old: np.ndarray, around: np.ndarray) -> np.ndarray:
    """best_classes of any number of words, some at a time; words that look alike are weighed once.

    ``around`` has a word's neighbours by slot, up to OWN.
    """
    right, left, own = around[:, :CLASSES], around[:, CLASSES:OWN], around[:, OWN]
    alike = np.arange(len(old)) + CLASSES ** 3
    once = np.flatnonzero((right.sum(axis=1) == 1) & (left.sum(axis=1) == 1) & (own == 0))
    alike[once] = (old[once] * CLASSES + right[once].argmax(axis=1)) * CLASSES + left[once].argmax(axis=1)
    _, first, back = np.unique(alike, return_index=True, return_inverse=True)
    new = [best_classes(pair, old[k], right[k], left[k], own[k])
           for k in (first[i:i + MOVE_WORDS] for i in range(0, len(first), MOVE_WORDS))]
    return np.concatenate(new)[back] if new else old


def _stays(key: np.ndarray, turn: int, part: int) -> np.ndarray:
    """All but one of ``part`` shares of the keys."""
    return (mix(key.astype(np.uint64)) + _U(turn)) % _U(part) != 0


def likelihood(pair: np.ndarray) -> float:
    """The part of the log-likelihood that depends on the classes."""
    return float(xlogx(pair).sum() - xlogx(pair.sum(axis=1)).sum() - xlogx(pair.sum(axis=0)).sum())


def _per_task(df: DataFrame, table: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of a table of class bigrams over all batches."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                total += table(b).astype(np.int64)
        for piece in pieces(total):
            yield pa.RecordBatch.from_pydict(piece)

    found = sum_pieces(in_batches(df).mapInArrow(add, PIECE))
    return (found if len(found) else np.zeros(CLASSES * CLASSES)).reshape(CLASSES, CLASSES).astype(float)


def _squares(row: np.ndarray, column: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.bincount(row * CLASSES + column, weights=n, minlength=CLASSES * CLASSES)


def unit_pairs(rows: DataFrame, classes: np.ndarray, below: int) -> np.ndarray:
    """The class bigrams of the units up to ``below``."""
    units = len(classes)

    def table(b: pa.RecordBatch) -> np.ndarray:
        other, at, n = _neighbours(b, "after")
        unit = b["unit"].to_numpy()[at]
        if below < units:
            k = np.flatnonzero((unit < below) & (other < below))
            unit, other, n = unit[k], other[k], n[k]
        return _squares(classes[unit], classes[other], n)

    return _per_task(rows.select("unit", "after", "after_times"), table)


def moved_units(rows: DataFrame, classes: np.ndarray, pair: np.ndarray, end: int, turn: int, part: int) -> np.ndarray:
    """The units' classes after one of ``part`` shares of them has moved; the end stays."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            unit = b["unit"].to_numpy()
            around = np.zeros((len(unit), OWN + 1))
            for side, first in (("after", 0), ("before", CLASSES)):
                other, at, n = _neighbours(b, side)
                around[:, first:first + CLASSES] = np.bincount(
                    at * CLASSES + classes[other], weights=n, minlength=len(unit) * CLASSES).reshape(-1, CLASSES)
                if side == "after":
                    itself = other == unit[at]
                    around[at[itself], OWN] = n[itself]
            goes = np.flatnonzero(~_stays(unit, turn, part) & (unit != end))
            new = chosen(pair, classes[unit[goes]], around[goes])
            yield pa.RecordBatch.from_pydict({"unit": b["unit"].take(pa.array(goes)), "class": pa.array(new.astype(np.int32))})

    got = in_batches(rows).mapInArrow(move, "unit int, class int").toArrow()
    out = classes.copy()
    out[got["unit"].to_numpy()] = got["class"].to_numpy()
    return out


def rare_pairs(rare: DataFrame) -> np.ndarray:
    """The class bigrams of a word beyond the head and one of the head."""
    def table(b: pa.RecordBatch) -> np.ndarray:
        slot, at = _values(b["slots"], np.uint8)
        n, own, slot = _values(b["times"], np.int64)[0], b["class"].to_numpy().astype(np.int64)[at], slot.astype(np.int64)
        after, before = np.flatnonzero(slot < CLASSES), np.flatnonzero((slot >= CLASSES) & (slot < OWN))
        return _squares(own[after], slot[after], n[after]) + _squares(slot[before] - CLASSES, own[before], n[before])

    return _per_task(rare, table)


def far_pairs(far: DataFrame, rare: DataFrame) -> np.ndarray:
    """The class bigrams of two words beyond the head, from (key, other, n)."""
    v = rare.select(F.col("word").alias("key"), F.col("class").alias("v"))
    w = rare.select(F.col("word").alias("other"), F.col("class").alias("w"))
    pair = np.zeros((CLASSES, CLASSES))
    for r in far.join(w, "other").join(v, "key").groupBy("v", "w").agg(F.sum("n").alias("n")).collect():
        pair[r["v"], r["w"]] = r["n"]
    return pair


def moved_rare(rare: DataFrame, pair: np.ndarray, turn: int, part: int) -> DataFrame:
    """The words beyond the head after one of ``part`` shares of them has moved."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b["class"].to_numpy().astype(np.int64)
            slot, at = _values(b["slots"], np.uint8)
            n = _values(b["times"], np.int64)[0]
            slot = np.where(slot >= FAR_SLOTS, slot - FAR_SLOTS, slot).astype(np.int64)
            around = np.bincount(at * (OWN + 1) + slot, weights=n, minlength=len(old) * (OWN + 1)).reshape(-1, OWN + 1)
            goes = np.flatnonzero(~_stays(b["word"].to_numpy().view(np.uint64), turn, part))
            new = old.copy()
            new[goes] = chosen(pair, old[goes], around[goes])
            yield b.set_column(2, "class", pa.array(new.astype(np.int32)))

    return in_batches(rare).mapInArrow(move, RARE)


def settled(state, pair: np.ndarray, weigh: Callable, move: Callable, drop: Callable, rounds: float) -> tuple:
    """Exchange in rounds: the last state, its class bigrams, and the likelihoods a token before and
    after every round that was kept, ``rounds`` at most. ``pair`` belongs to ``state``; ``drop`` gets
    the states that are done with."""
    gains, turn, part = [likelihood(pair) / max(pair.sum(), 1)], 0, 1
    while pair.any() and part <= CLASSES and len(gains) <= rounds:
        turn += 1
        trial = move(state, pair, turn, part)
        then = weigh(trial)
        best = likelihood(then) / then.sum()
        if best <= gains[-1]:
            drop(trial)
            part *= 2
            continue
        drop(state)
        state, pair = trial, then
        gains.append(best)
        if gains[-1] - gains[-2] < MIN_GAIN:
            break
    return state, pair, gains


@dataclass
class Model:
    """What scoring needs of the classes; its size is fixed."""

    head: np.ndarray  # sorted hashes of the most frequent words
    head_count: np.ndarray
    head_class: np.ndarray
    affix_class: np.ndarray  # of words not met in training
    step: np.ndarray  # log10 of class transitions
    spread: np.ndarray  # log10 of each class's tokens and words with the unknown one
    end_class: int
    tokens: int
    words: int


def exchange(bigrams: np.ndarray, often: np.ndarray, end: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of units from their bigram counts; the end keeps class 0 for itself.

    A unit is moved to the class that gains most of the sum of n log n over class bigrams
    less that over classes, which is the likelihood's part that depends on the classes. It
    stops after ``sweeps``, as its classes are where the rounds over all words begin.
    """
    size = len(often)
    order = [u for u in np.argsort(-often, kind="stable").tolist() if u != end]
    group = np.zeros(size, dtype=np.int64)
    for k, u in enumerate(order):
        group[u] = 1 + k % (classes - 1)

    member = np.zeros((size, classes))
    member[np.arange(size), group] = 1
    pair = member.T @ bigrams @ member
    right, left = bigrams @ member, bigrams.T @ member  # per unit: to each class, from each class
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not often[u]:
                continue
            old, r, l, own = group[u], right[u].copy(), left[u].copy(), bigrams[u, u]
            r[old] -= own
            l[old] -= own
            # the table without the unit
            pair[old] -= r
            pair[:, old] -= l
            pair[old, old] -= own
            rows, columns = pair.sum(axis=1), pair.sum(axis=0)
            base = xlogx(pair)
            gain_row = (xlogx(pair + r) - base).sum(axis=1)
            gain_column = (xlogx(pair.T + l) - base.T).sum(axis=1)
            corner = np.diagonal(pair)
            both = xlogx(corner + r + l + own) - xlogx(corner)
            gain = gain_row + gain_column + both - (xlogx(corner + r) - xlogx(corner)) - (xlogx(corner + l) - xlogx(corner))
            gain -= xlogx(rows + r.sum() + own) - xlogx(rows) + xlogx(columns + l.sum() + own) - xlogx(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-6:
                new = int(old)
            pair[new] += r
            pair[:, new] += l
            pair[new, new] += own
            if new != old:
                group[u] = new
                moved += 1
                right[:, old] -= bigrams[:, u]
                right[:, new] += bigrams[:, u]
                left[:, old] -= bigrams[u]
                left[:, new] += bigrams[u]
        if not moved:
            break
    return group


class ClassModel:
    """The model fitted on the training rows of a table."""

    def __init__(self, docs: DataFrame):
        with passing_shuffles(docs.sparkSession):
            self._fit(docs)

    def _fit(self, docs: DataFrame) -> None:
        spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        train = rows.where(F.coalesce(held_out("doc_id", FOLDS) != OUT, F.lit(False)))
        self.counts = written(word_counts(train), "words")
        # The most frequent words, HEAD at most: those above a step of the logarithm of the count.
        height = F.floor(F.log2("c") * 16).cast("int")
        steps = self.counts.groupBy(height.alias("h")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
        slices = slices_of(sum(r["c"] for r in steps))
        steps = sorted(((r["h"], r["n"]) for r in steps), reverse=True)
        total, least = 0, None
        for h, n in steps:
            if total + n > HEAD:
                break
            total, least = total + n, h
        in_head = F.col("word") == F.lit(int(END_HASH.view(np.int64)))
        if least is not None:
            in_head |= height >= F.lit(least)
        head = sorted(self.counts.where(in_head).collect(), key=lambda r: (-r["c"], r["word"]))
        word = np.array([r["word"] for r in head], dtype=np.int64).view(np.uint64)
        often = np.array([r["c"] for r in head], dtype=np.int64)
        affix = np.array([r["affix"] for r in head], dtype=np.int64)
        # The end is a unit of its own, however rare.
        rank = np.arange(len(word))
        first = np.flatnonzero(word == END_HASH)
        named = np.concatenate((first, rank[word != END_HASH]))[:UNITS]
        unit = UNITS + affix
        unit[named] = np.arange(len(named))
        by_hash = np.argsort(word)
        word, often, unit = word[by_hash], often[by_hash], unit[by_hash]
        end = int(place_in(word, np.array([END_HASH]))[0])

        path = run_dir(spark, "llm-bigrams")
        word_bigrams(train, word, slices).write.partitionBy("kind").parquet(path)
        bigrams = spark.read.schema(BLOBS).parquet(path)
        units = len(word) + AFFIXES
        unit_path = run_dir(spark, "llm-units")
        unit_rows(bigrams, units, slices).write.parquet(unit_path)
        around = spark.read.schema(AROUND).parquet(unit_path)
        start = np.concatenate((unit, UNITS + np.arange(AFFIXES)))
        size = UNITS + AFFIXES

        def add(batches) -> np.ndarray:
            total = np.zeros(size * size, dtype=np.int64)
            for b in batches:
                if b.num_rows:
                    other, at, n = _neighbours(b, "after")
                    np.add.at(total, start[b["unit"].to_numpy()[at]] * size + start[other], n.astype(np.int64))
            return total

        found = summed(around.select("unit", "after", "after_times"), add, "int64")
        table = found.reshape(size, size).astype(float) if len(found) else np.zeros((size, size))
        group = exchange(table, table.sum(axis=0), 0)

        classes = group[start]
        classes, pair, self.gains = settled(
            classes, unit_pairs(around, classes, units), lambda c: unit_pairs(around, c, units),
            lambda c, pair, turn, part: moved_units(around, c, pair, end, turn, part), lambda c: None, np.inf)

        # The words beyond the head; in their affixes' classes they are what the rounds so far have weighed.
        def kept(df: DataFrame) -> tuple[DataFrame, str]:
            to = run_dir(spark, "llm-rare")
            df.write.parquet(to)
            return spark.read.schema(RARE).parquet(to), to

        def drop(state: tuple[DataFrame, str | None]) -> None:
            if state[1]:
                discard(spark, state[1])

        rare = rare_words(bigrams, classes)
        any_near, any_far = (not bigrams.where(F.col("kind") == k).isEmpty() for k in (NEAR, FAR))
        if any_near:
            far = far_words(bigrams)
            of_head = unit_pairs(around, classes, len(word))
            (rare, to), pair, gains = settled(
                (rare, None), pair, lambda r: of_head + rare_pairs(r[0]) + (far_pairs(far, r[0]) if any_far else 0),
                lambda r, pair, turn, part: kept(moved_rare(r[0], pair, turn, part)), drop, 1)
            self.gains += gains[1:]
            if to is None:  # no round gained anything
                rare = kept(rare)[0]
        else:
            rare = kept(rare)[0]
        discard(spark, path)
        discard(spark, unit_path)
        share = (pair.sum(axis=0) + 1) / (pair.sum() + CLASSES)
        step = np.log10((pair + SMOOTH * CLASSES * share) / (pair.sum(axis=1, keepdims=True) + SMOOTH * CLASSES))

        # Tokens and different words of each class.
        self.tail = rare.select("word", "c", "class")
        mine = classes[:len(word)]
        sums = np.bincount(mine, weights=often, minlength=CLASSES)
        kinds = np.bincount(mine, minlength=CLASSES)
        for r in self.tail.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
            sums[r["class"]] += r["c"]
            kinds[r["class"]] += r["v"]
        self.words = spark.createDataFrame(pa.table({
            "word": word.view(np.int64), "c": often, "class": mine.astype(np.int32)}), "word long, c long, class int").unionByName(self.tail)
        self.model = Model(word, often, mine, classes[len(word):], step, np.log10(1 + sums + kinds), int(group[0]),
                           int(sums.sum()), int(kinds.sum()))
        self.shared = spark.sparkContext.broadcast(self.model)

    def scored(self, docs: DataFrame) -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
        shared, model = self.shared, self.model
        out = F.coalesce(held_out("doc_id", FOLDS) == OUT, F.lit(True))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        rows = rows.select("doc_id", out.alias("held_out"), F.monotonically_increasing_id().alias("row"), "text")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for part, data, at in chunks(batches):
                hashes, affix, ptr = with_ends(split_words(data, at))
                k = place_in(m.head, hashes)
                c, group = np.zeros(len(hashes), dtype=np.int64), m.affix_class[affix]
                rest = k < 0
                group[ptr[1:] - 1] = m.end_class
                c[k >= 0], group[k >= 0] = m.head_count[k[k >= 0]], m.head_class[k[k >= 0]]
                text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
                rest = c == 0
                # Different words beyond the head, with how often each text has them.
                pairs = np.flatnonzero(rest)
                order = pairs[np.lexsort((hashes[pairs], text[pairs]))]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                own = text[order[first]]
                ends = np.searchsorted(own, np.arange(len(ptr)))
                n = len(ptr) - 1
                # Classes in a row; a word beyond the head by its place among the text's, as -1, -2 ...
                code = group.copy()
                code[order] = ends[text[order]] - np.cumsum(new)
                before = np.concatenate(([m.end_class], code[:-1]))
                before[ptr[:-1]] = m.end_class
                sure = (before >= 0) & (code >= 0)
                fit = np.zeros(len(code))
                fit[sure] = m.step[before[sure], code[sure]] - m.spread[code[sure]]
                unsure = np.flatnonzero(~sure)
                cut = pa.array(np.searchsorted(text[unsure], np.arange(len(ptr))).astype(np.int32))
                cuts = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part["doc_id"], "held_out": part["held_out"], "row": part["row"],
                    "n_tokens": pa.array(np.diff(ptr)),
                    "known": pa.array(np.bincount(text, weights=~rest, minlength=n).astype(np.int64)),
                    "seen": pa.array(np.bincount(text, weights=np.log10(c + 1.0), minlength=n)),
                    "fit": pa.array(np.bincount(text, weights=fit, minlength=n)),
                    "words": pa.ListArray.from_arrays(cuts, pa.array(hashes[order[first]].view(np.int64))),
                    "times": pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    "others": pa.ListArray.from_arrays(cuts, pa.array(group[order[first]].astype(np.int32))),
                    "before": pa.ListArray.from_arrays(cut, pa.array(before[unsure].astype(np.int32))),
                    "after": pa.ListArray.from_arrays(cut, pa.array(code[unsure].astype(np.int32)))})

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in batches:
                group = b["others"].flatten().to_numpy().copy()
                first = np.concatenate(([0], np.cumsum(b["others"].value_lengths().to_numpy())))
                row = np.repeat(np.arange(b.num_rows), b["places"].value_lengths().fill_null(0).to_numpy())
                group[first[row] + b["places"].flatten().to_numpy()] = b["classes"].flatten().to_numpy()
                row = np.repeat(np.arange(b.num_rows), b["after"].value_lengths().to_numpy())
                before, code = (b[k].flatten().to_numpy().astype(np.int64) for k in ("before", "after"))
                for x in (before, code):
                    far = x < 0
                    x[far] = group[first[row[far]] - 1 - x[far]]
                fit = np.bincount(row, weights=m.step[before, code] - m.spread[code], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(b[k] for k in told), pa.array(fit + b["fit"].to_numpy())], names=[*told, "fit"])

        kind = "doc_id long, held_out boolean, row long, n_tokens long, known long, seen double, fit double"
        lists = "words array<long>, times array<int>, others array<int>, before array<int>, after array<int>"
        local = written(in_batches(rows).mapInArrow(score, f"{kind}, {lists}"), "scores")
        asked = local.select("row", F.posexplode(F.arrays_zip("words", "times")).alias("place", "w")).select(
            "row", "place", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
        answered = (asked.join(self.tail, "word").groupBy("row")
                    .agg(F.sum("times").alias("known2"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("seen2"),
                         F.collect_list(F.struct("place", "class")).alias("found")))
        answered = answered.select("row", "known2", "seen2", F.col("found.place").alias("places"), F.col("found.class").alias("classes"))
        told = ["doc_id", "held_out", "n_tokens", "known", "seen", "known2", "seen2"]
        done = (in_batches(local.drop("words", "times").join(answered, "row", "left").na.fill(0, ["known2", "seen2"]))
                .mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, known long, seen double, known2 long, seen2 double, fit double"))
        seen = F.col("seen") + F.col("seen2")
        if model.tokens:
            base = seen - F.col("n_tokens") * F.log10(F.lit(float(model.tokens + model.words + 1)))
            score_ = seen + F.col("fit")
        else:
            base = score_ = F.lit(0.0)
        return done.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.col("known2")).alias("n_known"),
                           F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score_.alias("score"))


def scored(docs: DataFrame) -> DataFrame:
    """Fit on the training rows of docs and score all rows, with the perplexity per token."""
    out = ClassModel(docs).scored(docs)
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
