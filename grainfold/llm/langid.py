"""Language of texts: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import bounded_batches, fresh_name, mix64

#: Characters that one numpy pass holds.
PIECE_CHARS = 1 << 19
UNDETERMINED = "und"


class Grams:
    """Buckets of the 1- to ``n``-grams of lower-cased texts; the texts of a batch are worked together."""

    def __init__(self, n: int, buckets: int):
        self.n, self.buckets = n, buckets

    def of(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of (text number, bucket), one entry per n-gram. Long texts come in several pieces.

        Grams don't reach over the end of a text; white space runs count as written.
        """
        at, held, owners = 0, [], []
        for i, text in enumerate(texts):
            low = text.lower()
            for start in range(0, len(low), PIECE_CHARS):
                piece = low[max(0, start - self.n + 1) : start + PIECE_CHARS]
                held.append((piece, min(start, self.n - 1)))
                owners.append(i)
                at += len(piece)
                if at >= PIECE_CHARS:
                    yield self._buckets(held, owners)
                    at, held, owners = 0, [], []
        if held:
            yield self._buckets(held, owners)

    def _buckets(self, held: list[tuple[str, int]], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p, _ in held])
        chars = np.frombuffer("".join(p for p, _ in held).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.array(owners), sizes)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fresh = np.repeat(np.array([skip for _, skip in held]), sizes)  # what an earlier piece has counted ends before here
        value, out_owner, out = np.zeros(len(chars), np.uint64), [], []
        for k in range(self.n):
            shifted = np.zeros(len(chars), np.uint64)
            shifted[k:] = chars[: len(chars) - k]
            value = value + (shifted + np.uint64(1)) * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & ((1 << 64) - 1))
            whole = (place >= k) & (place >= fresh)
            out.append((mix64(value[whole]) % np.uint64(self.buckets)).astype(np.int32))
            out_owner.append(owner[whole])
        return np.concatenate(out_owner), np.concatenate(out)


def count_grams(docs: DataFrame, lang: Column, text: Column, n: int = 3, buckets: int = 1 << 15) -> DataFrame:
    """``lang``, ``bucket`` and ``n``: how often grams of each bucket occur in texts of each language.

    Bucket -1 holds the number of texts. Rows with a null text or language teach nothing. A task
    adds up its own rows first.
    """
    bounded_batches(docs.sparkSession)
    grams = Grams(n, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            names = sorted(set(langs))
            code = {x: i for i, x in enumerate(names)}
            codes = np.array([code[x] for x in langs])
            total = np.zeros((len(names), buckets + 1), np.int64)
            total[:, buckets] = np.bincount(codes, minlength=len(names))
            for owner, bucket in grams.of(texts):
                total[:, :buckets] += np.bincount(codes[owner] * buckets + bucket, minlength=len(names) * buckets).reshape(len(names), buckets)
            for x, i in code.items():
                sums[x] = sums[x] + total[i] if x in sums else total[i]
        for x, total in sums.items():
            at = np.flatnonzero(total)
            number = np.where(at == buckets, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(number), pa.array(total[at])], ["lang", "bucket", "n"])

    seen = docs.select(lang.cast("string").alias("lang"), text.alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return seen.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(counts: DataFrame, buckets: int, smooth: float = 0.5) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the log-probability matrix (buckets x languages).

    What comes to the driver has at most ``buckets`` + 1 rows per language.
    """
    found = counts.toPandas()
    names = sorted(found["lang"].unique())
    code = {x: i for i, x in enumerate(names)}
    matrix = np.full((buckets, len(names)), smooth)
    prior = np.zeros(len(names))
    at = found["lang"].map(code).to_numpy(int)
    bucket, n = found["bucket"].to_numpy(int), found["n"].to_numpy(float)
    texts = bucket < 0
    prior[at[texts]] = n[texts]
    matrix[bucket[~texts], at[~texts]] += n[~texts]
    return names, np.log(np.maximum(prior, 1) / max(prior.sum(), 1)), np.log(matrix / matrix.sum(axis=0))


def identify(docs: DataFrame, trained: tuple[list[str], np.ndarray, np.ndarray], text: str = "text", n: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (posterior probability of that language).

    Scores of a batch are sums of rows of the broadcast log-probability matrix: each text's
    grams are counted by bucket, then gathered. Null texts and texts without a letter give
    ``und`` with score 0, and so does everything if nothing was learned. Equal posteriors go to the
    language first in code point order.
    """
    bounded_batches(docs.sparkSession)
    names, prior, matrix = trained
    buckets = len(matrix)
    grams = Grams(n, buckets)
    model = docs.sparkSession.sparkContext.broadcast(matrix.astype(np.float64))
    labels = np.array([*names, UNDETERMINED], dtype=object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = model.value
        for batch in batches:
            lettered = np.array(batch.column(batch.num_columns - 2).to_pylist(), bool)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            sums = np.tile(prior, (len(texts), 1))
            for owner, bucket in grams.of([t if ok else "" for t, ok in zip(texts, lettered)]):
                code, times = np.unique(owner.astype(np.int64) * buckets + bucket, return_counts=True)
                row = code // buckets
                first = np.flatnonzero(np.diff(row, prepend=-1))
                if len(first):
                    sums[row[first]] += np.add.reduceat(logs[code % buckets] * times[:, None], first, axis=0)
            if names:
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, share = np.zeros(len(texts), int), np.zeros(len(texts))
            best, share = np.where(lettered & bool(names), best, len(names)), np.where(lettered & bool(names), share, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(labels[best], pa.string()), pa.array(share)], names=[*keep, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keep, has_letter.alias("_lettered"), F.when(has_letter, F.col(text)).otherwise("").alias("_text"))
    return rows.mapInArrow(score, ", ".join([*fields, "lang_pred string", "score double"]))


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the CRC-32 of the key's text has remainder ``fold``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def predict_language(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", n: int = 3, buckets: int = 1 << 15, keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Learn from the rows that aren't held out and predict all: ``keep`` (the key), ``held_out``, ``lang_pred``, ``score``.

    Every whole text of the training rows counts. Null texts, null languages and empty tables:
    see ``count_grams`` and ``identify``. Repeated rows are predicted each. Other columns don't matter.
    """
    held = fresh_name(docs, "_held")
    rows = docs.withColumn(held, held_out(F.col(key)))
    counts = count_grams(rows.where(~F.col(held)), F.col(lang), F.col(text), n, buckets)
    keep = keep or (key,)
    found = identify(rows, train(counts, buckets), text, n, (*keep, held))
    return found.select(*keep, F.col(held).alias("held_out"), "lang_pred", "score")
