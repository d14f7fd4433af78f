"""Packing, spelling variants and resampling against plain versions, exact round trips and odd tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainfold.llm import gru_lm, packing, resampling, spelling
from grainfold.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
MODEL = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(MODEL))


@pytest.fixture(scope="module")
def encode():
    with open(tokenizer_path(MODEL), "rb") as file:
        return packing.load_encoder(file.read())


# ---- packing

def unpacked(rows, length):
    """Ids of every document from its pieces, after checks that pieces have no gaps and sequences no padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for number, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or at & (at - 1) == 0 and number >= max(sequences) - 12
    assert sorted(sequences) == list(range(len(sequences)))
    out = {}
    for key, parts in docs.items():
        ids = []
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == len(ids) and len(r.ids) == 4 * r.length
            ids += np.frombuffer(r.ids, "<u4").tolist()
        assert all(r.doc_tokens == len(ids) for r in parts)
        out[key] = ids
    return out


def test_pieces_are_the_texts(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(-1, None), (-2, ""), (-3, "<|endoftext|> x" * 3000), (-4, "ä b\n" * 40_000)], docs.schema))
    rows = packing.pack_documents(docs, tokenizer_path(MODEL), length=512).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert unpacked(rows, 512) == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    again = packing.pack_documents(docs.repartition(5), tokenizer_path(MODEL), length=512).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_query_digests(spark, tokenizer):
    rows = QUERIES["op11_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        held[r.doc_id] += r.length
    assert set(held) == set(texts)


def test_many_copies_and_tiny_ranges(spark, tokenizer, monkeypatch):
    """A third of all rows are copies; ranges of the curve split them and still follow each other."""
    monkeypatch.setattr(packing, "RANGE_TOKENS", 50)
    docs = spark.createDataFrame([(i, "one and the same text" if i % 3 == 0 else f"text {i} of {i * i}") for i in range(600)] + [(7, "one"), (7, "one"), (None, "none")], "doc_id long, text string")
    rows = packing.pack_documents(docs, tokenizer_path(MODEL), length=64).collect()
    sequences = defaultdict(int)
    for r in rows:
        sequences[r.sequence_id] += r.length
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(sequences.values()) == total and [sequences[i] for i in range(total // 64)] == [64] * (total // 64)


def test_encoder_gives_the_library_ids(encode, tokenizer):
    rng = random.Random(2)
    signs = [*"abé \n\t\x1c\x85'1!　᠎日sS ́", "<|endoftext|>", "'s", "<|", "'ll", "\r\n", "\U0001f600"]
    for text in ("".join(rng.choice(signs) for _ in range(rng.randint(0, 20))) for _ in range(4000)):
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for c in points:
        text = f"a{chr(c)}b1{chr(c)}! {chr(c)}  {chr(c)}'s"
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, hex(c)
    for text in ("x" * 30_000, " " * 20_001 + "x", "ab" * 9000):
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_in_pieces(encode, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PIECE", 40)
    rng = random.Random(5)
    signs = [*"ab  \n\t1!é\x1c\x85", "\r\n", "word", "'s"]
    for text in ("".join(rng.choice(signs) for _ in range(400)) for _ in range(200)):
        assert packing.encode_whole(encode, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_models_use_the_library(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    docs = spark.createDataFrame([(1, "Some Words, and more"), (2, None)], "doc_id long, text string")
    found = unpacked(packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), length=4, end_id=5).collect(), 4)
    assert found == {1: [*model.encode("Some Words, and more", add_special_tokens=False).ids, 5], 2: [5]}


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_keys(points, bits)
    assert sorted(keys) == list(range(len(points)))
    assert set(np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1)) == {1}


def test_neighbours_in_sequences_are_alike(spark):
    """Documents of one vocabulary lie together: few sequences mix two of four."""
    rng = random.Random(1)
    words = [[f"{a}{b}" for b in ("ka", "lo", "mi", "nu", "pe", "ra", "so")] for a in ("ba", "gri", "xto", "veu")]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words[i % 4]) for _ in range(40))) for i in range(400)], "doc_id long, text string")
    kinds = defaultdict(set)
    for r in packing.pack_documents(docs, tokenizer_path(MODEL), length=512).collect():
        kinds[r.sequence_id].add(r.doc_id % 4)
    assert sum(len(k) == 1 for k in kinds.values()) >= 0.8 * len(kinds)


# ---- spelling variants

def plain_words(rows, loss=97, least=5, least_n=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % loss == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= least_n}


def plain_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if plain_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= 2 * n else None, n, len(near))
    rows = {}
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, near, words[form] if form else None)
    return rows


def texts_of_variants(rng, n):
    base = ["apple", "banana", "cherry", "éclair", "zigzag", "aaaaa", "aaaaaa", "banane", "bandana", "abcdefghij", "x" * 40]
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            w = rng.choice(base[: rng.randint(1, len(base))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "é", "zz", w[at].upper()]) + w[at + 1 :]
            words.append(w)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("block", [512, 2, 5])
def test_variants_against_all_pairs(spark, monkeypatch, block):
    """Also with tiles that are cut into many pairs of blocks, and batches of a few rows."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    if block < 512:
        monkeypatch.setattr(spelling, "CELLS", 200)
        monkeypatch.setattr(spelling, "HELD", 10)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if block < 512 else old)
    try:
        rows = texts_of_variants(random.Random(block), 150) + [(None, "apple apple appla éclair"), (None, None), (3, ""), (3, "apple")]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        want = plain_forms(plain_words(rows))
        found = spelling.group_spellings(docs).collect()
        assert len(found) == len(want) > 100
        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_chains_and_long_words(spark):
    """Forms of forms, and words of many thousand letters."""
    long = "y" * 20_000
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, long: 3, long + "z": 6, "ccccc": 2}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.word: r for r in spelling.group_spellings(docs, loss=None).collect()}
    assert set(found) == set(counts) - {"ccccc"}
    assert {found[w].root for w in ("aaaaa", "aaaab", "abbbb")} == {"abbbb"} and found["aaaaa"].form == "aaaab"
    assert found[long].form == long + "z" and found[long + "z"].n_near == 1 and found["abbbb"].form is None


# ---- resampling

def plain_features(text, most):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain_draw(rows, target, most, percent=10, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    feats = [plain_features(t, most) for _, t in rows]
    s = Counter(bucket(f) for _, fs in feats for f in fs)
    t = Counter(bucket(f) for x in target for f in plain_features(x, most)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out, fit = [], []
    for (key, _), (words, fs) in zip(rows, feats):
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(fs), weight, score, None])
        if len(words) >= least:
            fit.append(out[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is not None, r[0]))
    for place, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[4] = place
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("most", [1, 3])
def test_draw_against_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(resampling, "PIECE", 50)
    monkeypatch.setattr(resampling, "RANGE_ROWS", 16)
    monkeypatch.setattr(resampling, "HELD", 20)
    rng = random.Random(most)
    words = ["alpha", "Beta", "GAMMA", "déjà", "ÉTÉ", "x1", "-", "日本", "don't", "a_b", " ", "Ω"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(400)] + [(None, "alpha " * 25), (None, None), (5, ""), (-7, "!?"), (900, "alpha\tbeta," * 500)]
    target = ["alpha beta alpha", None, "déjà vu x1", ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = resampling.resample(docs, wanted, most=most).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, found), key=str) == plain_draw(rows, target, most)


def test_draw_towards_nothing(spark):
    docs = spark.createDataFrame([(i, "some words " * 15) for i in range(50)], "doc_id long, text string")
    found = resampling.resample(docs, docs.limit(0)).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5]
    assert resampling.resample(docs.limit(5), docs).where("rank IS NOT NULL").count() == 0


def test_odd_columns(spark):
    """Columns of any name beside those that are read change nothing."""
    docs = spark.createDataFrame([(i, f"plain words number {i} " * 8) for i in range(40)], "doc_id long, text string")
    odd = docs.select("*", *[F.lit("x").alias(c) for c in ("key", "n", "ids", "place", "range", "word", "form", "score", "rank", "weight", "_range", "bucket_ids")])
    for apply in (lambda d: packing.pack_documents(d, tokenizer_path(MODEL)), spelling.group_spellings, lambda d: resampling.resample(d, d)):
        assert sorted(map(str, apply(odd).collect())) == sorted(map(str, apply(docs).collect()))


def test_lm_words_are_looked_up_by_their_leading_bits():
    rng = np.random.default_rng(3)
    word = np.unique(np.concatenate([rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2), np.arange(40, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(3, dtype=np.uint64)]))
    tokens = np.concatenate([word, word + np.uint64(1), rng.integers(0, 1 << 63, 4000, dtype=np.uint64)])
    for known in (word, word[:1], word[-1:], word[:0]):
        words = gru_lm.Vocabulary(known, np.ones(len(known)), np.zeros(len(known), np.int32), 0, 0, np.zeros(0))
        at, here = words.look_up(tokens)
        assert (here == np.isin(tokens, known)).all() and (known[at[here]] == tokens[here]).all()
        # the words' buckets are found once and kept
        assert (words.begins is not None) == bool(len(known))


@pytest.mark.parametrize("scale", [0.1, 20.0])
def test_lm_output_is_the_class_times_the_word(scale):
    rng = np.random.default_rng(4)
    counts = np.sort(rng.integers(1, 10_000, 90))[::-1].astype(np.int64)
    model = gru_lm.Model(counts, 500.0)
    model.Wc, model.Ww = (rng.normal(0, scale, w.shape).astype(np.float32) for w in (model.Wc, model.Ww))
    states, targets = np.tanh(rng.normal(0, 1, (300, gru_lm.STATE))).astype(np.float32), rng.integers(0, 91, 300)

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    want = []
    for s, word in zip(states.astype(float), targets):
        c = model.class_of[word]
        want.append(log_softmax(s @ model.Wc + model.bc)[c])
        if word < 90:
            a, b = model.edges[c], model.edges[c + 1]
            want[-1] += log_softmax(model.Ww[a:b] @ s + model.bw[a:b])[word - a]
    grads = {}
    score, back = model.output(states, targets, grads)
    assert np.allclose(score, want, rtol=1e-3, atol=1e-3) and np.allclose(model.output(states, targets)[0], score)
    # the gradient for the states is the change of the score
    step = np.zeros(gru_lm.STATE, np.float32)
    step[3] = 1e-2
    if scale < 1:
        slope = (model.output(states + step, targets)[0] - model.output(states - step, targets)[0]) / 2e-2
        assert np.allclose(-back[:, 3], slope, atol=5e-3)
