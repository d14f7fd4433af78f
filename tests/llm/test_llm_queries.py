"""Every query with a SQL twin against DuckDB, and the contracts of the others on the small tables."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from grainfold.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(names)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_token_counts(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    found = QUERIES["op1_token_counts"](spark, SF).collect()
    assert len(found) == len(texts)
    for row in found:
        n = len(model.encode(texts[row.doc_id]))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), n, n > 4096)


def test_lm_scores(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op6_lm_score"](spark, SF).collect()}
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        row = found[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(ws), sum(w in counts for w in ws), total)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), rel=1e-9)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_nearest(spark, duck):
    ids, vectors = zip(*duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    ids, vectors = np.array(ids), np.array(vectors, np.float64)
    hits, total = 0, 0
    rows = QUERIES["op8_nearest"](spark, SF).toPandas()
    assert set(rows.query_id) == {i for i in ids if i % 100 == 0}
    for q, group in rows.groupby("query_id"):
        at = int(np.flatnonzero(ids == q)[0])
        d = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
        d[at] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]])
        assert list(group.sort_values("rank")["rank"]) == list(range(1, 11))
        order = list(zip(group.sort_values("rank").score, group.sort_values("rank").vec_id))
        assert order == sorted(order)
        where = {v: k for k, v in enumerate(ids)}
        assert np.allclose(group.score, [d[where[v]] for v in group.vec_id], atol=1e-12)
        hits, total = hits + len(best & set(group.vec_id)), total + 10
    assert hits >= 0.9 * total


def test_language(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.95 * len(out)


def test_pii_round_trip(spark, texts):
    from grainfold.llm.pii import pseudonymise

    rows = QUERIES["op5_pii"](spark, SF)
    done = rows.collect()
    assert len(done) == len(texts)
    assert all((r.text != texts[r.doc_id]) == (r.n_pseudonyms > 0) for r in done)
    back = pseudonymise(rows, "not a secret: set PII_SECRET", undo=True).collect()
    assert {r.doc_id: r.text for r in back} == texts
