"""Operators that answer row by row: archive, classifier, language model, packing, shards, personal data, transcripts."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adlake.llm import archive, classlm, kdshards, packing, pii, quality, transcripts, words


def test_archive_round_trip(spark, tmp_path):
    long = "payload " * 30
    rows = [(3, "http://a/1", long), (1, "http://a/2", long), (2, None, long), (4, "http://a/\r\n x", "short"), (5, "u", "short"),
            (6, "u", None), (7, None, "ü" * 60), (8, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    held = archive.write_archive(pages, str(tmp_path / "a"))
    got = {r["page_id"]: r for r in archive.read_archive(spark, held).collect()}
    for page, _, html in rows:
        r, body = got[page], (html or "").encode()
        assert bytes(r["payload"]) == body and r["payload_digest"] == hashlib.sha256(body).hexdigest() and r["payload_bytes"] == len(body)
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        block = rest[:int(fields[b"Content-Length"])]
        assert rest[len(block):] == b"\r\n\r\n" and block.endswith(body if r["record_type"] == "response" else b"\r\n\r\n")
    assert {p: r["refers_to"] for p, r in got.items() if r["record_type"] == "revisit"} == {2: 1, 3: 1}
    assert spark.read.parquet(held.payloads).count() == 4


def test_archive_refuses_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    held = archive.write_archive(pages, str(tmp_path / "a"))
    spark.createDataFrame([(hashlib.sha256(b"x").hexdigest(), bytearray(b"y"))], "payload_digest string, payload binary") \
        .write.mode("overwrite").parquet(held.payloads)
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_archive(spark, held).collect()


def test_quality(spark, documents, odd, empty):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("lo", "ra", "mi", "ke", "su") for b in ("na", "to", "ri", "pe")]
    good = [(i, " ".join(rng.choices(words, k=60)) + ".") for i in range(300)]
    bad = [(i, " ".join(w + rng.choice(("###", "$$$")) for w in rng.choices(words, k=60))) for i in range(300, 420)]
    docs = documents(good + bad)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(420)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] < 300) for r in held) >= 0.97 * len(held)
    model = quality.QualityModel(docs, labels)
    assert model.accepted(odd).columns == odd.columns and model.scored(odd).count() == 10 and model.accepted(empty).count() == 0
    none = quality.quality(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality(empty, labels).count() == 0


def brute_base(rows):
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    count = Counter(w for (i, _), ts in zip(rows, tokens, strict=True) if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in ts)
    n, v = sum(count.values()), len(count)
    return {i: (len(ts), sum(count[w] > 0 for w in ts), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ts))
            for (i, _), ts in zip(rows, tokens, strict=True)}


@pytest.mark.parametrize("head", [1 << 16, 20])
def test_class_model(documents, monkeypatch, head):
    monkeypatch.setattr(classlm, "HEAD", head)
    rng = random.Random(2)
    rows = []
    for i in range(150):  # nouns follow articles, verbs follow nouns
        rows.append((i, " ".join(f"{rng.choice(('The', 'a'))} n{rng.randrange(80)} v{rng.randrange(60)}" for _ in range(rng.randrange(30)))))
    got = classlm.scored(documents(rows)).collect()
    want = brute_base(rows)
    for r in got:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("head", [1 << 16, 20])
def test_every_training_word_is_clustered_by_its_contexts(spark, documents, monkeypatch, head):
    monkeypatch.setattr(classlm, "HEAD", head)
    rng = random.Random(7)
    rows = [(i, " ".join(f"{rng.choice(('the', 'a'))} n{rng.randrange(600)}x {rng.choice(('will', 'can'))} v{rng.randrange(600)}x"
                         for _ in range(rng.randrange(1, 120)))) for i in range(150)]
    model = classlm.ClassModel(documents(rows))
    train = [[None, *t.split(), None] for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    names = sorted({w for t in train for w in t if w})
    hashes = words.split_words(np.frombuffer(" ".join(names).encode(), np.uint8), np.array([0, len(" ".join(names))])).hashes
    got = {r["word"]: r["class"] for r in model.words.collect()}
    group = {w: got[int(h)] for w, h in zip(names, hashes.view(np.int64), strict=True)} | {None: 0}
    assert len(got) == len(group) and model.gains == sorted(model.gains)
    # Nouns and verbs have the same ends, so only their contexts tell them apart.
    nouns, verbs = ({group[w] for w in names if w[0] == k and w[-1] == "x"} for k in "nv")
    assert not nouns & verbs
    pair = np.zeros((classlm.CLASSES, classlm.CLASSES))
    for t in train:
        for v, w in zip(t, t[1:], strict=False):
            pair[group[v], group[w]] += 1
    assert model.gains[-1] == pytest.approx(classlm.likelihood(pair) / pair.sum())
    share = (pair.sum(axis=0) + 1) / (pair.sum() + classlm.CLASSES)
    near = classlm.SMOOTH * classlm.CLASSES
    step = np.log10((pair + near * share) / (pair.sum(axis=1, keepdims=True) + near))
    assert np.allclose(model.model.step, step)
    # Scores, word by word.
    count = Counter(w for t in train for w in t[1:])
    spread = np.ones(classlm.CLASSES)
    for w, c in count.items():
        spread[group[w]] += c + 1
    scores = {r["doc_id"]: r["score"] for r in model.scored(documents(rows)).collect()}
    for i, t in rows:
        line = [None, *t.split(), None]
        if all(w in group for w in line):
            assert scores[i] == pytest.approx(sum(step[group[v], group[w]] + math.log10((count[w] + 1) / spread[group[w]])
                                                  for v, w in zip(line, line[1:], strict=False)))


@pytest.mark.parametrize("slices", [1, 5])
def test_bigrams_travel_in_few_rows(documents, monkeypatch, slices):
    """One row for each kind and slice, whatever the number of bigrams; together they hold every bigram."""
    monkeypatch.setattr(classlm, "BIGRAM_TOKENS", 500)  # of many rounds, and of several tasks
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("the", "of", f"w{rng.randrange(300)}", "twice twice")) for _ in range(rng.randrange(40)))) for i in range(200)]
    hashes = {w: int(words.split_words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hashes[0])
              for w in {w for _, t in rows for w in t.split()}}
    head = np.array(sorted([int(classlm.END_HASH), *(hashes[w] for w in ("the", "of", "w1", "w2"))]), dtype=np.uint64)
    units = len(head) + classlm.AFFIXES
    found = classlm.word_bigrams(documents(rows).repartition(3), head, slices)
    held = found.collect()
    assert len({(r["kind"], r["slice"]) for r in held}) == len(held) <= 3 * slices
    texts = [[int(classlm.END_HASH), *(hashes[w] for w in t.split()), int(classlm.END_HASH)] for _, t in rows]
    place, named = {int(h): k for k, h in enumerate(head)}, {}
    for (_, t), line in zip(rows, texts, strict=True):
        split = words.split_words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
        named |= {h: place.get(h, len(head) + int(a)) for h, a in zip(line[1:-1], classlm._affix(split), strict=True)}
    named[int(classlm.END_HASH)] = place[int(classlm.END_HASH)]
    both = [(v, w) for line in texts for v, w in zip(line, line[1:], strict=False)]
    pairs = Counter(named[v] * units + named[w] for v, w in both)
    far = Counter((v, w) for v, w in both if v not in place and w not in place)
    near = Counter()
    for v, w in both:
        if v not in place:
            near[v, named[w]] += 1
            if v == w:
                near[v, 2 * units] += 1
        if w not in place:
            near[w, units + named[v]] += 1
    got = {classlm.PAIR: Counter(), classlm.NEAR: Counter(), classlm.FAR: Counter()}
    for r in held:
        n = classlm._unpacked(bytes(r["times"]), len(r["keys" if r["kind"] == classlm.PAIR else "others"]) // (4 if r["kind"] == classlm.NEAR else 8))
        keys = np.frombuffer(r["keys"], np.uint64)
        if r["kind"] == classlm.PAIR:
            codes = keys.tolist()
        elif r["kind"] == classlm.NEAR:
            other = np.frombuffer(r["others"], np.uint32) % (2 * units + 1)
            codes = list(zip(np.repeat(keys, np.frombuffer(r["sizes"], np.uint32)).tolist(), other.tolist(), strict=True))
        else:
            codes = list(zip(keys.tolist(), np.frombuffer(r["others"], np.uint64).tolist(), strict=True))
        assert len(set(codes)) == len(codes)
        got[r["kind"]].update(dict(zip(codes, n.tolist(), strict=True)))
    assert got == {classlm.PAIR: pairs, classlm.NEAR: near, classlm.FAR: far}
    around = {r["unit"]: r for r in classlm.unit_rows(found, units, slices).collect()}
    for side, first, second in (("after", 0, 1), ("before", 1, 0)):
        at = {}
        for code, n in pairs.items():
            at.setdefault(divmod(code, units)[first], {})[divmod(code, units)[second]] = n
        assert at == {u: dict(zip((other := np.frombuffer(r[side], np.int32)).tolist(), classlm._unpacked(bytes(r[f"{side}_times"]), len(other)).tolist(),
                                  strict=True)) for u, r in around.items()}


def test_counts_of_any_size_are_kept():
    for most in (1, 255, 256, 65535, 65536, 2**32 - 1, 2**32, 2**62):
        n = np.array([1, most, 7], dtype=np.int64)
        assert classlm._unpacked(classlm._packed(n), 3).tolist() == n.tolist()
    assert [classlm.slices_of(n) for n in (0, 1 << 18, 1 << 20, 1 << 30, 1 << 33)] == [1, 1, 4, 1024, 4096]


def test_moves_gain_what_they_promise():
    rng = np.random.default_rng(3)
    big = rng.poisson(0.6, (30, 30)).astype(float)
    group = np.where(np.arange(30) == 0, 0, 1 + np.arange(30) % 5)

    def table(g):
        member = np.eye(classlm.CLASSES)[g]
        return member.T @ big @ member

    member = np.eye(classlm.CLASSES)[group]
    new = classlm.best_classes(table(group), group, big @ member, big.T @ member, np.diagonal(big).copy())
    for u in range(1, 30):
        tried = {c: classlm.likelihood(table(np.where(np.arange(30) == u, c, group))) for c in range(1, classlm.CLASSES)}
        assert tried[new[u]] == pytest.approx(max(tried.values()))


def test_class_model_is_a_distribution(documents):
    rows = [(i, "a b a c b a the of" * (i % 4)) for i in range(40)]
    m = classlm.ClassModel(documents(rows)).model
    assert np.allclose((10 ** m.step).sum(axis=1), 1)


def test_class_model_odd_rows(odd, empty):
    assert classlm.scored(odd).count() == 10 and classlm.scored(empty).count() == 0


def test_packing(spark, documents):
    rng = random.Random(3)
    docs = documents([(i, " ".join(rng.choices(("Ärger", "it's", "don't", "x,y", "12", "naïve!!", " z", "ét"), k=rng.randrange(60)))) for i in range(120)]) \
        .unionByName(documents([(500, "lone")], source="tiny")).unionByName(documents([(501, None)], source=None))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(docs, window=256).collect()
    want = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    held = {i: [None] * len(ids) for i, ids in want.items()}
    for r in got:
        held[r["doc_id"]][r["start"]:r["start"] + r["length"]] = np.frombuffer(r["ids"], "<u4").tolist()
    assert held == want and sum(r["length"] for r in got) == sum(map(len, want.values()))
    at = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * 256 + r["offset"] == at and r["offset"] + r["length"] <= 256
        at += r["length"]


def test_grants_are_a_deficit_round_robin():
    g = packing.Grants([1000, 10, 3, 0, 5000], 64)
    rounds = np.arange(g.rounds + 1)[:, None]
    upto = g.upto(rounds, np.arange(5))
    assert (np.diff(upto, axis=0) >= 0).all() and (upto[-1] == g.totals).all() and (upto[0] == 0).all()
    assert (abs(upto - rounds * g.totals / g.rounds) <= 1).all()  # no deficit above a token


def test_packing_forgets_its_words_when_pieces_are_cut(documents, monkeypatch):
    """Some hundred MB a worker, which the steps after it need."""
    steps = []

    class Seen:
        def __init__(self, df):
            self.df = df

        def mapInArrow(self, step, schema):
            steps.append(step)
            return self.df.mapInArrow(step, schema)

    monkeypatch.setattr(packing, "in_batches", Seen)
    assert packing.pack(documents([(1, "some words"), (2, None)])).count() > 0
    packing.encoder(packing.default_tokenizer()).encode("some words")
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    assert list(steps[-1](iter([]))) == [] and packing.encoder.cache_info().currsize == 0
    assert list(steps[0](iter([]))) == [] and len(given) == 2


def test_words_are_looked_up_once_a_batch(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rng = random.Random(8)
    texts = [None, "", " ", "\n\n", "Straße.,", "İI ſ", "a!!!!!!!! a!!!!!!!!!", "É<|startoftext|>x", "x" * 100 + "!", "中文 it's 12", "a\tb\x85c",
             *("".join(rng.choices("aAéÉ.,!'\u0301\u0307 \n\t1<|>İıßſ中", k=40)) for _ in range(300))]
    for kept in (packing.KEPT_STEMS, 3):  # a full memory as well
        monkeypatch.setattr(packing, "KEPT_STEMS", kept)
        words = packing.Encoder(packing.default_tokenizer())
        asked, plain = [], words.word
        monkeypatch.setattr(words, "word", lambda w, asked=asked, plain=plain: (asked.append(w), plain(w))[1], raising=False)
        for part in (pa.array(texts), pa.array(["none", *texts * 20])[1:], pa.array([], pa.string()), pa.array([None], pa.string())):
            del asked[:]
            got = words.encode_all(part)
            want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]
            assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == want
            assert len(asked) == len(set(asked))


def test_packing_odd_rows(odd, empty):
    got = packing.pack(odd).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, None} and packing.pack(empty).count() == 0


def test_shards(documents, odd, empty):
    rng = random.Random(4)
    docs = documents([(i, "x" * rng.randrange(400)) for i in range(700)], "hot").unionByName(
        documents([(i, "same text") for i in range(700, 1000)], None))
    got = kdshards.document_shards(docs, 40).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert sorted(sizes) == list(range(40)) and max(sizes.values()) - min(sizes.values()) <= 3 * 416
    for shard in range(40):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in got)
    assert kdshards.document_shards(odd, 40).count() == 10 and kdshards.document_shards(empty, 40).count() == 0


def test_patterns():
    t = "a.b@c.example.org, 1.2.3.4 999.1.1.1 4111 1111 1111 1111 4111111111111112 +1 (407) 555-7710 x@y 1.2.3.4.5"
    assert [(k, t[a:b]) for k, a, b in pii.pattern_spans(t)] == [
        ("email", "a.b@c.example.org"), ("ip", "1.2.3.4"), ("ip", "1.2.3.4"), ("phone", "+1 (407) 555-7710")]


def test_the_field_learns_its_table():
    field = pii.trained()
    for line in pii.LABELLED:
        text, spans = pii._marked(line)
        assert sorted(pii.field_spans(field, [text])[0]) == sorted(spans), line


def test_the_field_adds_what_the_patterns_lose():
    text = "ä +1 (569) 555-6633 4795326016703902 end"
    base, every = pii.all_spans(pii.trained(), [text])[0]
    assert base == []  # one match reaches over both numbers and fails its check
    assert [(k, text[a:b]) for k, a, b in every] == [("card", "4795326016703902"), ("phone", "+1 (569) 555-6633")]


def test_personal_data_rows(odd, empty):
    got = {r["doc_id"]: r for r in pii.found(odd).collect()}
    assert got[8]["spans"] == "email:0:15,ip:16:24" and got[8]["n_email"] == 1 and got[1]["spans"] == ""
    clean = {r["doc_id"]: r for r in pii.redacted(odd).collect()}
    assert clean[8]["text"] == "[EMAIL] [IP] é ß 𝄞" and clean[8]["n_chars"] == len(clean[8]["text"]) and clean[1]["text"] is None
    assert pii.redacted(odd).columns == odd.columns and pii.found(empty).count() == 0


def conversations(spark, n=80):
    rng = random.Random(6)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(2, 8)):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role, "\n".join("word " * rng.randrange(1, 8 if role == "user" else 40) + "." for _ in range(rng.randrange(1, 4)))))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_transcripts(spark):
    table = conversations(spark)
    got = {(r["conv_id"], r["turn"]): r for r in transcripts.recovered(table).collect()}
    rows = table.collect()
    assert sum((r["conv_id"], r["turn"]) in got and got[r["conv_id"], r["turn"]]["role"] == r["role"] for r in rows) >= 0.9 * len(rows)


def test_blocks_do_not_change_the_path(spark, monkeypatch):
    lines = transcripts.transcripts(conversations(spark, 20))
    model = transcripts.fit(lines)
    whole = sorted(map(tuple, transcripts.decode(lines, model).drop("block").collect()))
    monkeypatch.setattr(transcripts, "BLOCK_TURNS", 1)
    assert sorted(map(tuple, transcripts.decode(lines, model).drop("block").collect())) == whole


def test_transcripts_odd_rows(spark):
    rows = [(None, None, None, None), (1, 0, "user", ""), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, 0, "user", "x" * 9999)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r["conv_id"] for r in transcripts.recovered(table).collect()} == {None, 1, 2}
    assert transcripts.recovered(table.limit(0)).count() == 0


def test_patterns_as_searched_plainly():
    rng = random.Random(9)
    for alphabet in ("a1@._- ", "0129. -", "+1 ().-2", "ab@.c_%+-", "é1@ \n.x", "12. "):
        for _ in range(3000):
            text = "".join(rng.choices(alphabet, k=rng.randrange(40)))
            want = [(kind, m.start(), m.end()) for kind, pattern in pii.PATTERNS.items() for m in pattern.finditer(text)
                    if pii._holds(kind, m[0])]
            assert pii.pattern_spans(text) == want, text
            tokens = [m.span() for m in re.finditer(r"\S+", text) if re.search("[0-9@]", m[0])]
            assert [t for run in pii.runs(text) for t in run] == tokens, text


@pytest.mark.parametrize("unit", ["a", "7", "a.b.c.", "1.", "a@", "+1", "-", "\u4e16", "1 "])
def test_long_runs_take_linear_time(unit):
    text = "7 a@b " + unit * (1_000_000 // len(unit)) + " 8"
    began = time.process_time()
    pii.pattern_spans(text)
    pii.runs(text)
    assert time.process_time() - began < 10


def test_the_class_model_leaves_no_shuffle_files(documents, spark):
    """They go with the action that made them; the setting that says so is as it was before."""
    def files() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.rsplit("/", 1)[-1] for f in found.mkString(",").split(",") if "/shuffle_" in f}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting)
    classlm.ClassModel(documents([(k, f"the word{k % 7} of text{k} and the rest") for k in range(200)]))
    assert spark.conf.get(setting) == was
    deadline = time.time() + 10
    while (left := files() - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left


def test_a_step_begins_without_the_memory_of_those_before(monkeypatch):
    """Arrow keeps what it has freed; a worker serves many steps, so what all have kept would add up."""
    given = []
    monkeypatch.setattr(words, "give_back", lambda: given.append(1))
    list(words.chunks(iter([])))
    assert given == [1]
