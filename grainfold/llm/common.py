"""Helpers of the operators: tables, Arrow batches, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java regular expression.
BLANKS = r"[\x20\x09-\x0D]+"
#: Bytes of text that one Arrow batch and one numpy pass hold.
BATCH_BYTES = 8 << 20
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at a number of bytes, so that very long texts don't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underlines behind it until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def words(text: Column) -> Column:
    """Array of the words of a text; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def split_words(text: Column) -> Column:
    """Words of a text, with empty strings where blanks follow each other or end it. Plain spaces are cut without a pattern."""
    return F.when(text.rlike(r"[\x09-\x0D]"), F.split(text, BLANKS)).otherwise(F.split(text, " "))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once per row, also where ``use`` has it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null gives 0."""
    return F.size(words(text)).cast("long")


_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_MASK = (1 << 64) - 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def _byte_codes(fold_case: bool) -> np.ndarray:
    codes = np.random.Generator(np.random.PCG64(20_011)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits; works in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    for shift, mult in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(mult)
    x ^= x >> np.uint64(33)
    return x


class WordHasher:
    """64-bit hashes of all words of many texts at once, upper-case A-Z taken as a-z."""

    def __init__(self, fold_case: bool = True):
        self.codes = _byte_codes(fold_case)
        self.size = 0

    def _powers(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, PIECE_BYTES)
            step = np.full(self.size, _MULT, np.uint64)
            step[0] = 1
            self.up = np.cumprod(step)
            step[1:] = _INVERSE
            self.down = np.cumprod(step)

    def _piece(self, data: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first positions of the words of one piece; texts begin at ``starts_at``."""
        n = len(data)
        self._powers(n)
        inside = ~_SEPARATOR[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = starts_at[(starts_at >= 0) & (starts_at < n)]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = begins[begins > 0] - 1
        last[cuts] = inside[cuts]
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        total = np.cumsum(self.codes[data] * self.up[:n])
        before = np.where(a > 0, total[np.maximum(a, 1) - 1], np.uint64(0))
        return mix64((total[b] - before) * self.down[a] + (b - a).astype(np.uint64)), a

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and where each text's words begin (one more entry at the end).

        Null texts have no words. Texts are worked in pieces of bounded size, cut at white
        space; a piece grows only when a single word is longer.
        """
        data, offsets = text_bytes(texts)
        hashes, places, at = [], [], 0
        while at < len(data):
            end = min(len(data), at + PIECE_BYTES)
            while end < len(data):
                gap = np.flatnonzero(_SEPARATOR[data[at + 1 : end]])
                if len(gap):
                    end = at + 2 + int(gap[-1])
                    break
                end = min(len(data), end + PIECE_BYTES)
            lo, hi = np.searchsorted(offsets, [at, end])
            h, a = self._piece(data[at:end], offsets[lo:hi] - at)
            hashes.append(h)
            places.append(a + at)
            at = end
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        p = np.concatenate(places) if places else np.zeros(0, np.int64)
        return h, np.searchsorted(p, offsets)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its texts; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    return data[base : int(offsets[-1])], offsets.astype(np.int64) - base


def shingle_hashes(hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words within a text, and where each text's runs begin.

    A text of fewer words, but at least one, has one run: the whole sequence.
    """
    counts = np.diff(starts)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_starts = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), runs)
    at = starts[:-1][owner] + np.arange(int(out_starts[-1])) - out_starts[:-1][owner]
    length = np.minimum(counts, n)[owner]
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        here = length > k
        value[here] = mix64(value[here] * np.uint64(_MULT) + hashes[at[here] + k])
    return value, out_starts


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def settled_broadcast(df: DataFrame, row_bytes: int, most_bytes: int = 16 << 20) -> DataFrame:
    """``df`` (a stored table) marked for broadcast if its rows, counted here, stay below ``most_bytes``.

    Beyond that it is returned as it is, and Spark shuffles the join.
    """
    return F.broadcast(df) if df.count() * row_bytes <= most_bytes else df


def row_identity(df: DataFrame, key: str, text: str) -> DataFrame:
    """Adds ``_id`` and ``_tx``, hashes of key and text: rows that agree in both are one document here."""
    return df.withColumns({"_id": F.xxhash64(F.col(key)), "_tx": F.xxhash64(F.col(text), F.lit(1))})


def packed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``text``, ``_id``, ``_tx`` and all columns of ``docs`` as the struct ``_doc``, so that no names clash."""
    return row_identity(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")), "key", "text")
