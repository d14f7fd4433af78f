"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for every operator and stage."""

import datetime
import itertools
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grainfold.llm import ann, decontaminate, gru_lm, langid, licences, line_dedup, mixing, ngram_join, packing, pii, resampling, spelling, token_counts
from grainfold.llm.groups import components
from grainfold.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, n_lines string, score string, size string, n_pseudonyms string, _pii string, _held string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall old oak tree at night"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *["x"] * 7) for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, PROSE, "en", "a"),
        (1, PROSE, "en", "a"),
        (2, PROSE.upper(), "en", None),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \n\t\n ", None, "b"),
        (None, "une phrase en français, assez longue pour être apprise\nencore une ligne", "fr", "b"),
        (None, None, "fr", "c"),
        (7, "12345 67890", "fr", "c"),
        (8, "\n".join([PROSE + f" {i}" for i in range(3000)]), "en", "c"),
        (9, "x" * 300_000, "en", "c"),
        (10, "mail me@example.org or +1 (243) 555-5526. Licensed under CC BY-NC 4.0. All rights reserved.", "en", "c"),
    ]
    return documents(spark, rows)


BENCH = "item_id long, text string"


def _apply(name, docs, spark):
    bench = spark.createDataFrame([(1, PROSE), (2, None), (3, "too short"), (None, "another item without a key that has enough words")], BENCH)
    return {
        "tokens": lambda: token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model")),
        "leaks": lambda: decontaminate.find_leaks(docs, bench),
        "clean": lambda: decontaminate.drop_leaks(docs, bench),
        "lines": lambda: line_dedup.dedup_lines(docs),
        "groups": lambda: ngram_join.join_groups(docs),
        "one": lambda: ngram_join.keep_one(docs),
        "pii": lambda: pii.pseudonymise(docs, "k"),
        "lm": lambda: gru_lm.score_texts(docs),
        "mix": lambda: mixing.mix_sources(docs),
        "lang": lambda: langid.predict_language(docs),
        "licences": lambda: licences.recognise_licences(docs),
        "pack": lambda: packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")),
        "spell": lambda: spelling.group_spellings(docs),
        "resample": lambda: resampling.resample(docs, bench),
    }[name]()


NAMES = ["tokens", "leaks", "clean", "lines", "groups", "one", "pii", "lm", "mix", "lang", "licences", "pack", "spell", "resample"]


@pytest.fixture(scope="module")
def done(spark, odd):
    """Columns and rows of an operator's result on the odd table, worked out once."""
    held = {}

    def rows(name):
        if name not in held:
            found = _apply(name, odd, spark)
            held[name] = found.columns, found.collect()
        return held[name]

    return rows


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert _apply(name, documents(spark, []), spark).count() == 0


@pytest.mark.parametrize("name", ["tokens", "lines", "groups", "pii", "lm", "mix", "lang", "licences", "resample"])
def test_one_row_for_each(odd, done, name):
    assert sorted((r.doc_id is None, r.doc_id) for r in done(name)[1]) == sorted((r.doc_id is None, r.doc_id) for r in odd.collect())


def test_odd_results(odd, done):
    def by_id(name):
        return {r.doc_id: r for r in done(name)[1]}

    tokens = by_id("tokens")
    assert (tokens[3].n_tokens, tokens[3].n_bytes, tokens[4].n_tokens) == (0, 0, 0)
    assert tokens[9].over_limit
    groups = by_id("groups")
    assert groups[2].component_id == 1 and groups[3].component_id == 3 and groups[4].n_shingles == 0
    lines = by_id("lines")
    assert lines[3].text is None and lines[3].n_lines == 0
    assert lines[5].text == " \n\t\n " and lines[2].text == "" and lines[8].n_removed == 3000
    assert done("lines")[0].count("n_lines") == 1
    assert set(by_id("leaks")) >= {1, 2, 8}
    assert done("clean")[0] == odd.columns and set(by_id("clean")) == {3, 4, 5, 7, 9, 10, None}
    assert done("one")[0] == odd.columns and sorted(r.doc_id for r in done("one")[1] if r.doc_id and r.doc_id < 8) == [1, 3, 4, 5, 7]
    lang = by_id("lang")
    assert [lang[i].lang_pred for i in (3, 4, 5, 7)] == ["und"] * 4 and lang[1].lang_pred == "en"
    mix = by_id("mix")
    assert mix[3].size == 0 and mix[3].taken == 0 and all(r.taken <= 2 * r.size for r in mix.values())
    lm = by_id("lm")
    assert lm[3].n_tokens == 1 and lm[4].n_tokens == 1
    personal = by_id("pii")
    assert personal[10].n_pseudonyms == 2 and "me@example.org" not in personal[10].text and personal[3].text is None
    found = by_id("licences")
    assert found[10].licences == ["CC-BY-NC-4.0", "proprietary"] and found[3].licences == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, odd, name, stage):
    out = stage(spark, odd, "/root/testdata/sf0.001")
    assert len(out.collect()) <= odd.count()
    assert stage(spark, documents(spark, []), "/root/testdata/sf0.001").count() == 0
    if name != "mix":
        assert out.columns == odd.columns


def test_cache_encodes_misses_only(spark, tmp_path):
    docs = documents(spark, [(1, "a b c", "en", "a"), (2, "a b c", "en", "a"), (3, None, "en", "a")])
    path = str(tmp_path / "cache")
    model = tokenizer_path("piece_bpe_32k.model")
    first = token_counts.count_tokens(docs, model, path).orderBy("doc_id").collect()
    assert spark.read.parquet(path).count() == 2
    more = docs.unionAll(documents(spark, [(4, "new text", "en", "a")]))
    assert token_counts.count_tokens(more, model, path).orderBy("doc_id").collect()[:3] == first
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_tokenizers(spark, name):
    from tokenizers import Tokenizer

    docs = documents(spark, [(1, PROSE, "en", "a"), (2, "Ünï <|endoftext|>", "en", "a")])
    model = Tokenizer.from_file(tokenizer_path(name))
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, tokenizer_path(name)).collect()}
    assert found == {r.doc_id: len(model.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def test_near_copies_against_brute_force(spark):
    """Many variants of one text: groups, lines and star shortcuts give what all pairs give."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 6)):
            words[at] = f"v{rng.integers(0, 40)}"
        rows.append((i, " ".join(words), "en", "a"))
    docs = documents(spark, rows)
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t, _, _ in rows)}
    links = spark.createDataFrame([(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])], "a long, b long")
    want = {r.node: r.label for r in components(links).collect()}
    assert {r.doc_id: r.component_id for r in ngram_join.join_groups(docs).collect()} == {i: want.get(i, i) for i in sets}
    bags = [(i, set(t.split())) for i, t, _, _ in rows]
    gone = {b for (a, x), (b, y) in itertools.combinations(bags, 2) if _jaccard(x, y) >= 0.8}
    old = line_dedup.COMMON, line_dedup.COMMON_TIMES
    for line_dedup.COMMON, line_dedup.COMMON_TIMES in (old, (5, 1)):
        assert {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_removed > 0").collect()} == gone
    line_dedup.COMMON, line_dedup.COMMON_TIMES = old


def test_linked_members_do_not_meet_again(spark, monkeypatch):
    """Variants that links to hubs already join are not paired with each other: none of the pairs left to verify lies inside a group."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        words = [f"w{j}" for j in range(80)]
        for at in rng.integers(0, 80, rng.integers(0, 3)):
            words[at] = f"v{rng.integers(0, 40)}"
        rows.append((i, " ".join(words), "en", "a"))
    made, between = [], ngram_join._Join._between

    def watched(self, open_ones, others, groups):
        pairs = between(self, open_ones, others, groups)
        ids = self.members.select("id", "node").distinct().join(groups, "node", "left").select("id", F.coalesce("label", "node").alias("group"))
        both = pairs.join(ids, "id").join(ids.select(F.col("id").alias("id_2"), F.col("group").alias("group_2")), "id_2")
        made.append(both.where("group = group_2").count())
        return pairs

    monkeypatch.setattr(ngram_join._Join, "_between", watched)
    found = {r.doc_id: r.component_id for r in ngram_join.join_groups(documents(spark, rows)).collect()}
    assert made == [0] and len(found) == 200


def test_unrelated_texts_do_not_meet(spark, monkeypatch):
    """Sets near the lower end of a size class have many empty blocks; those alone bring no two texts together."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{v}" for v in rng.integers(0, 1 << 40, 650)), "en", "a") for i in range(40)]
    met, between = [], ngram_join._Join._between

    def watched(self, open_ones, others, groups):
        met.append(open_ones.count())
        return between(self, open_ones, others, groups)

    monkeypatch.setattr(ngram_join._Join, "_between", watched)
    found = ngram_join.join_groups(documents(spark, rows), 5, Fraction(4, 5)).collect()
    assert met == [0] and all(r.component_id == r.doc_id for r in found)


@pytest.mark.parametrize(("width", "similar"), [(4, Fraction(85, 100)), (5, Fraction(4, 5)), (2, Fraction(2, 5))])
def test_crowded_pages_left_out_lose_no_link(spark, monkeypatch, width, similar):
    """Texts of all sizes that share passages with many others: groups are those of brute force, and most texts leave the shared pages out."""
    rng = np.random.default_rng(6)
    passage = [f"p{i}" for i in range(400)]
    rows = []
    for size in (3, 8, 20, 60, 130, 250, 255, 260, 520, 700):
        for _ in range(6):
            words = passage[: size // 2] + [f"w{v}" for v in rng.integers(0, 1 << 40, size - size // 2)]
            for edits in (0, 1, size // 50, size // 25):
                changed = list(words)
                for at in rng.integers(0, size, edits):
                    changed[at : at + 1] = [f"v{rng.integers(0, 1 << 40)}"] * int(rng.integers(0, 3))
                rows.append((len(rows), " ".join(changed), "en", "a"))
    words = [(i, t.split()) for i, t, _, _ in rows]
    sets = {i: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} for i, w in words if w}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if similar.denominator * len(sets[a] & sets[b]) >= similar.numerator * len(sets[a] | sets[b])]
    want = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {r.doc_id: r.component_id for r in ngram_join.join_groups(documents(spark, rows), width, similar).collect()} == {i: want.get(i, i) for i, *_ in rows}


def test_fine_parities_bound_differences(spark):
    """Parities of two sets, also of unequal lengths, never tell of more differences than there are."""
    rng, run = np.random.default_rng(7), ngram_join.Points(4, Fraction(4, 5))
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 250, 300, 512, 513, 1000, 1100, 3000)]
    fine, begin = run.fine_parities(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    rows = [(len(s), fine[a:b].tolist()) for s, a, b in zip(sets, begin[:-1], begin[1:], strict=True)]
    assert len(rows[5][1]) == 16 and len(rows[4][1]) == 8
    df = spark.createDataFrame([(i, n, f, j, m, g) for i, (n, f) in enumerate(rows) for j, (m, g) in enumerate(rows)], "i int, n long, fine array<long>, j int, n_2 long, fine_2 array<long>")
    for similar in (Fraction(4, 5), Fraction(1, 4)):
        near = {(r.i, r.j) for r in df.where(ngram_join._fine_near(similar)).collect()}
        assert all((i, i) in near for i in range(len(rows)))
    near = {(r.i, r.j) for r in df.where(ngram_join._fine_near(Fraction(4, 5))).collect()}
    assert not near & {(4, 5), (5, 4), (6, 7), (2, 3)}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (5, 5), (None, 3)], "a long, b long")
    found = {r.node: r.label for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_leaks_with_an_edit(spark):
    words = PROSE.split()
    docs = documents(spark, [(1, "begin " + " ".join(words[:-1]) + " dawn!!! and go on with other words", "en", "a"), (2, " ".join(reversed(words)), "en", "a")])
    bench = spark.createDataFrame([(9, PROSE)], BENCH)
    [row] = decontaminate.find_leaks(docs, bench).collect()
    n = len(words) - 4
    assert (row.doc_id, row.item_id, row.start_word) == (1, 9, 1) and row.similarity == (n - 1) / (n + 1)


def test_leaks_against_every_window(spark):
    """Swapped halves, repeats, cuts and neighbours: the best similarity of all windows, at its first place that begins on the item's words or ends the text."""
    rng = np.random.default_rng(8)
    item = [f"w{i}" for i in range(60)]
    noise = lambda n: [f"x{rng.integers(0, 10**6)}" for _ in range(n)]
    twice = ["a", "b", "c", "d", "e", "f"] * 6
    texts = [
        noise(80) + item[30:] + item[:30] + noise(80),
        noise(2) + item + noise(3),
        noise(1) + item[3:] + item[:3] + item + noise(7),
        item[:55],
        noise(20) + item[:28] + noise(1) + item[29:] + noise(20) + item,
        noise(5) + twice + twice[:5] + noise(5),
        item[::-1],
        noise(30) + item[10:50] + noise(30),
    ]
    docs = documents(spark, [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)])
    items = {1: item, 2: twice, 3: item[5:45] + item[:20]}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], BENCH)

    def bag(words):
        out = defaultdict(int)
        for k in range(len(words) - 4):
            out[tuple(words[k : k + 5])] += 1
        return out

    want = {}
    for i, words in enumerate(texts):
        for number, target in items.items():
            b, size = bag(target), len(target)
            good, last = [], max(0, len(words) - size)
            for start in range(last + 1):
                a = bag(words[start : start + size])
                low, high = sum(min(a[s], b[s]) for s in set(a) | set(b)), sum(max(a[s], b[s]) for s in set(a) | set(b))
                if 5 * low >= 4 * high:
                    good.append((-low / high, start < last and tuple(words[start : start + 5]) not in b, start))
            if good:
                want[i, number] = -min(good)[0], min(good)[2]
                assert not min(good)[1]
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == want and (0, 1) in want and len(want) >= 6


def test_fingerprint_blocks_meet(spark):
    """Any two fingerprints within the radius share a block."""
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(200):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, decontaminate.RADIUS, replace=False):
            b ^= 1 << int(bit)
        signed = [x - (1 << 64) if x >= 1 << 63 else x for x in (a, b)]
        pairs.append(tuple(signed))
    rows = spark.createDataFrame(pairs, "a long, b long")
    both = rows.select(F.size(F.array_intersect(decontaminate.blocks(F.col("a")), decontaminate.blocks(F.col("b")))).alias("n"))
    assert both.where("n = 0").count() == 0


def test_pseudonyms_keep_format_and_link(spark):
    text = "card 4111 1111 1111 1111, 4111111111111111, not 4111111111111112; ssn 123-45-6789; IBAN DE89370400440532013000; ip 10.0.0.255 not 10.0.0.256; born 1980-02-29, 29.02.1980; not 2023-02-30"
    docs = documents(spark, [(1, text, "en", "a"), (2, "call 243-555-5526 or +1 (243) 555-5526", "en", "a")])
    a, b = (r.text for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect())
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", a)
    assert cards[0].replace(" ", "") == cards[1] and cards[2] == "4111111111111112" and cards[1] != "4111111111111111"
    digits = [int(c) for c in cards[1]][::-1]
    assert sum(digits[::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0
    iban = re.search(r"DE\d{20}", a)[0]
    assert int(iban[4:] + "1314" + iban[2:4]) % 97 == 1 and iban != "DE89370400440532013000"
    iso, dotted = re.search(r"born (\S+), (\S+);", a).groups()
    assert datetime.date.fromisoformat(iso).strftime("%d.%m.%Y") == dotted and iso != "1980-02-29"
    assert "10.0.0.256" in a and "2023-02-30" in a and "10.0.0.255" not in a and "123-45-6789" not in a
    phone = re.findall(r"\d{3}-\d{3}-\d{4}|\(\d{3}\) \d{3}-\d{4}", b)
    assert re.sub(r"\D", "", phone[0]) == re.sub(r"\D", "", phone[1])
    other = pii.pseudonymise(docs, "another").orderBy("doc_id").collect()[0].text
    assert other != a


def test_pseudonyms_of_values_before_other_tokens(spark):
    """Expiry, CVV, BIC and currency behind a value don't hide it; phones of other countries are found; all is undone."""
    hidden = {
        "card 4111 1111 1111 1111 12/27 ok": "4111 1111 1111 1111",
        "4111111111111111 123": "4111111111111111",
        "4111-1111-1111-1111 12 27": "4111-1111-1111-1111",
        "no 55 4111 1111 1111 1111": "4111 1111 1111 1111",
        "3782 822463 10005 1234": "3782 822463 10005",
        "ES91 2100 0418 4502 0005 1332 BIC CAIXESBB": "2100 0418 4502 0005 1332",
        "ES9121000418450200051332 EUR": "21000418450200051332",
        "DE89 3704 0044 0532 0130 00 EUR": "3704 0044 0532 0130 00",
        "4111 1111 1111 1111 12/05/1980": "12/05/1980",
        "call +33 1 23 45 67 89 now": "1 23 45 67 89",
        "+49 30 1234567.": "30 1234567",
        "+33 1 23 45 67 89 4111 1111 1111 1111": "4111 1111 1111 1111",
        "tel 5551234567": "5551234567",
    }
    two = "ES91 2100 0418 4502 0005 1332 ES91 2100 0418 4502 0005 1332"
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate([*hidden, two, "4111 1111 1111 1112 12 27", "at 1700000000 or 12345"])])
    for secret in "km":
        done = pii.pseudonymise(docs, secret)
        found = {r.doc_id: r for r in done.collect()}
        for i, (text, value) in enumerate(hidden.items()):
            assert value not in found[i].text and found[i].n_pseudonyms >= 1 and re.sub(r"\d", "0", found[i].text) == re.sub(r"\d", "0", text), text
        assert found[len(hidden)].n_pseudonyms == 2 and [found[len(hidden) + k].n_pseudonyms for k in (1, 2)] == [0, 0]
        back = pii.pseudonymise(done, secret, undo=True).collect()
        assert {r.doc_id: r.text for r in back} == {r.doc_id: r.text for r in docs.collect()}


def test_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "x") for i in range(300)]
    rows += [(0, rows[0][1], "x"), (None, rows[1][1], "x"), (900, None, "x"), (1000, [0.0] * 8, "x"), (1100, [float("nan")] * 8, "x"), (1200, [1.0, None] * 4, "x"), (1300, [1.0], "x"), (1400, [float("inf")] * 8, "x")]
    rows += [(2000 + i, rows[100][1], "x") for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {0, 100, 200, 2000}
    assert [v for v, _ in found[100]] == list(range(2000, 2010)) and all(s == 0 for _, s in found[100])
    assert ann.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = ann.nearest(table.where("vec_id in (100, 101)"), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(100, 1, 101)]


def test_every_training_text_is_learned_from(spark, monkeypatch):
    docs = documents(spark, [(i, f"text {i}", "en", "a") for i in range(60)])
    seen = []

    def train(texts, known, weights):
        seen.extend(r.text for r in texts.select("text").collect())
        return weights

    monkeypatch.setattr(gru_lm, "train", train)
    gru_lm.score_texts(docs)
    assert sorted(seen) == sorted(r.text for r in docs.where(~gru_lm.held_out(F.col("doc_id"))).collect())


def test_mix_reaches_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 60)), "en", "s" + str(min(5, int(rng.exponential(2))))) for i in range(4000)]
    docs = documents(spark, rows)
    found = mixing.mix_sources(docs)
    per = found.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k"), F.first("source_size").alias("s")).collect()
    assert all(abs(r.k - r.t) <= 60 and r.t <= 2 * r.s for r in per)
    assert sum(r.t for r in per) == pytest.approx(1.5 * sum(r.s for r in per))
    again = mixing.mix_sources(docs.repartition(7))
    assert found.exceptAll(again).count() == 0


def test_licence_runs(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and files.\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.'
    )
    docs = documents(spark, [(1, mit, "en", "a"), (2, mit.split("\n")[1], "en", "a"), (3, "No license here. " + PROSE, "en", "a")])
    found = licences.recognise_licences(docs).orderBy("doc_id").collect()
    assert [(r.sentence_ids, r.licences, r.unmatched) for r in found] == [
        (["MITperm", "MITnotice", "MITwarranty"], ["MIT"], 0),
        (["MITnotice"], [], 1),
        ([], [], 0),
    ]


APACHE = """#
# Copyright 2020 A. Body
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """/*
 * Tool is free software: you can redistribute it and/or modify
 * it under the terms of the GNU %sGeneral Public License as published by
 * the Free Software Foundation, either version %s of the License, or
 * (at your option) any later version.
 *
 * Tool is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */"""
BSD = """Copyright (c) 2020, Some Body Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
ENDORSE = """
3. Neither the name of Some Body Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_wrapped_licence_headers(spark):
    cases = [
        (APACHE, ["Apache-2.0"]),
        (APACHE.replace("\n# you", " you"), ["Apache-2.0"]),
        (APACHE.replace("\n", "\r\n"), ["Apache-2.0"]),
        (GPL % ("", 3), ["GPL-or-later"]),
        (GPL % ("Lesser ", 2.1), ["LGPL-or-later"]),
        (GPL % ("Affero ", 3), ["AGPL-or-later"]),
        ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation.", ["GPL-2.0"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + ENDORSE, ["BSD-3-Clause"]),
        (MIT, ["MIT"]),
        (ISC, ["ISC"]),
        (MPL, ["MPL-2.0"]),
        ("This is free and unencumbered software released into the public\ndomain.", ["Unlicense"]),
        ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT */\nint x;", ["GPL-2.0-only", "MIT"]),
        ("Code by me\n# SPDX-License-Identifier: Zlib\nimport os", ["Zlib"]),
        ("Some words\nAll rights\nreserved.\nLicensed under the\nMIT License, and more", ["MIT", "proprietary"]),
        ("Licensed under the GNU Lesser General Public License,\nversion 2.1.", ["LGPL-2.1"]),
    ]
    docs = documents(spark, [(i, t, "en", "a") for i, (t, _) in enumerate(cases)])
    found = {r.doc_id: r.licences for r in licences.recognise_licences(docs).collect()}
    assert found == {i: want for i, (_, want) in enumerate(cases)}


def test_grams_of_long_texts_are_whole():
    """Pieces of long texts count each gram once."""
    text = "".join(chr(97 + i * i % 26) for i in range(langid.PIECE_CHARS + 1000))
    grams = langid.Grams(3, 1 << 12)
    pieces = sum(len(b) for _, b in grams.of([text, "ab", ""]))
    assert pieces == (3 * len(text) - 3) + 3


def test_pieces_of_words_are_whole():
    """Words are hashed alike wherever pieces are cut, in batches of any layout."""
    import pyarrow as pa

    from grainfold.llm import common

    texts = ["a bb ccc", None, "", "x" * 1000 + " a", "\n bb\tA "] * 50
    whole, starts = common.WordHasher()(pa.array(texts))
    old, common.PIECE_BYTES = common.PIECE_BYTES, 64
    try:
        cut, cut_starts = common.WordHasher()(pa.array(["skip", *texts])[1:])
    finally:
        common.PIECE_BYTES = old
    assert (whole == cut).all() and (starts == cut_starts).all()
    assert list(np.diff(starts)[:5]) == [3, 0, 0, 2, 2] and whole[0] == whole[6]


def test_pipeline_stages_match_plain_versions(spark):
    """The pipeline's decisions on a small table, against plain Python for the stages that aren't learned."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["language"](spark, docs, sf).count() == docs.where("text rlike '\\\\p{L}'").count()
    near = {r.doc_id for r in stages["near_duplicates"](spark, docs, sf).collect()}
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= Fraction(4, 5):
            x, y = sorted((root(a), root(b)))
            group[y] = x
    assert near == {i for i in sets if root(i) == i}
    final = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "text", "taken", "copies"} <= set(final.columns) and final.where("copies < 1 OR copies > 2").count() == 0


def test_values_of_any_length_end(spark):
    """An address of 100,000 labels, and other values that go on and on, don't stop a task."""
    texts = ["a@" + "b." * 100_000 + "bb", "a@" + "b" * 100_000, "4" * 100_000, "1 " * 500, "+1" + " 23" * 3_000, "DE89 " + "3704 " * 2_000, "1." * 50_000, "a." * 50_000 + "@x.org"]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = pii.pseudonymise(docs, "k").collect()
    assert len(found) == len(texts) and all(len(r.text) == len(texts[r.doc_id]) for r in found)


def test_shared_models_need_no_package(tmp_path):
    """What the language model ships to executors can be read where this package can't be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    known = gru_lm.Vocabulary(*[np.zeros(0)] * len(gru_lm.Vocabulary.__dataclass_fields__))
    (tmp_path / "shared").write_bytes(cloudpickle.dumps((known, np.ones(3))))
    code = "import pickle; known, w = pickle.load(open('shared', 'rb')); print(type(known).__name__, w.sum())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": ""}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["Vocabulary", "3.0"], done.stderr
