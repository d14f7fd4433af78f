"""Importance resampling towards a target: documents are drawn by how much likelier the target makes their words."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.llm.common import arrow_rows, bounded_batches
from grainfold.llm.spelling import CRC_TABLE, crc_sql
from grainfold.operators.ranges import key_bounds, range_count, range_of, range_starts
from grainfold.session import stored

#: What words consist of: digits, lower-case a to z, and all that isn't ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Documents that one range of scores should hold.
RANGE_ROWS = 1 << 18
#: Characters that are split at once, and distinct features whose buckets a task remembers.
PIECE, HELD = 1 << 16, 1 << 18


def text_features(docs: DataFrame, key: str, text: str, most: int, buckets: int) -> DataFrame:
    """(key, n_words, n_features, bucket_ids): the hash buckets of all runs of up to ``most`` words of every whole text.

    A Split pre-tokeniser gives words and their places in the ASCII-lowered text. The words, joined by one space, make the
    line over which pairs of places (first of a word, last of the same or a later one) run as windows; a
    window's bucket is its CRC-32 modulo ``buckets``. ``bucket_ids`` are little-endian unsigned 32-bit numbers.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex, pre_tokenizers

        words_of = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str
        gap = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
        known: dict[str, int] = {}

        def bucket_of(feature: str) -> int:
            found = known.get(feature)
            if found is None:
                if len(known) >= HELD:
                    known.clear()
                found = known[feature] = zlib.crc32(feature.encode()) % buckets
            return found

        def features(text: str) -> tuple[int, np.ndarray]:
            ids: list[int] = []
            n, at, before = 0, 0, []
            while at < len(text):
                cut = gap.search(text, at + PIECE) if len(text) - at > PIECE else None
                end = cut.start() if cut else len(text)
                found = words_of(text[at:end])
                at, n = end, n + len(found)
                ids += [bucket_of(w) for w, _ in found]
                if most > 1:
                    words = before + [w for w, _ in found]
                    line = " ".join(words)
                    last = np.cumsum([len(w) + 1 for w in words]).tolist()
                    first = [0, *last]
                    for size in range(2, most + 1):
                        begin = max(0, len(before) - size + 1)
                        ids += [bucket_of(line[a : b - 1]) for a, b in zip(first[begin:], last[begin + size - 1 :])]
                    before = words[-(most - 1) :]
            return n, np.array(ids, "<u4")

        for batch in arrow_rows(batches):
            found = [features(x.as_py().encode().lower().decode()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([len(i) for _, i in found], pa.int64()), pa.array([i.tobytes() for _, i in found], pa.binary())],
                ["key", "n_words", "n_features", "bucket_ids"],
            )

    return rows.mapInArrow(split, f"key {kind}, n_words long, n_features long, bucket_ids binary")


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all rows of :func:`text_features`; each task adds its rows up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in arrow_rows(batches):
            for one in batch.column(0):
                total += np.bincount(np.frombuffer(one.as_buffer(), "<u4"), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return features.select("bucket_ids").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket, in thousandths: the log ratio of its smoothed shares of target and source, rounded down.

    Both tables are (bucket, n); a gain for each of the ``buckets`` is all that comes to the driver.
    """
    counts = []
    for table in (source, target):
        n = [0] * buckets
        for row in table.collect():
            n[row["bucket"]] = row["n"]
        counts.append(n)
    s, t = counts
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log(float(t[b] + 1) * (all_s + buckets) / (float(s[b] + 1) * (all_t + buckets)))) for b in range(buckets)], np.int64)


def summed_gain(bucket_ids: Column, gains: np.ndarray) -> Column:
    @F.pandas_udf("long")
    def add(ids: pd.Series) -> pd.Series:
        return pd.Series([int(gains[np.frombuffer(x, "<u4")].sum()) for x in ids], dtype="int64")

    return add(bucket_ids)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = 10_000, seed: int = 2024, key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every document's key, ``n_features``, ``weight``, ``score`` and ``rank``; the drawn ones have a rank, from 1 on.

    Features are all runs of up to ``most`` words. ``weight`` adds up the gains of a document's features, ``score`` adds Gumbel
    noise from the SHA-256 of seed and key, so the highest scores are a draw without replacement in proportion to the
    likelihood ratio, and reruns agree. Drawn are ``percent`` in a hundred, rounded down, of the documents with at least
    ``least_words`` words, by score and, in ties, smaller keys (nulls first).

    Texts are split once. Histograms and gains have a fixed size; ranks come from ranges of scores with counted
    bounds, so nothing is sorted in one task, and only ranges that hold drawn documents are sorted at all.

    Null and empty texts have no features and a weight of 0; very long ones are split in pieces between words. Rows with equal
    keys are documents of their own with the same noise; a null key counts as empty text there. Empty tables give no rows, an empty
    target counts as no features; other columns don't matter.
    """
    features = stored(text_features(docs, key, text, most, buckets))
    wanted = text_features(target.select(F.lit(0).alias("_none"), F.col(target_text).alias("_text")), "_none", "_text", most, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets), buckets)

    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000 * F.log(-F.log(share)))
    scored = stored(
        features.select("key", "n_features", "n_words", summed_gain(F.col("bucket_ids"), gains).alias("weight")).select(
            "key", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= least_words).alias("_fit"),
        ).withColumn("_down", F.when(F.col("_fit"), -F.col("score")))
    )
    fit = scored.where("_fit")
    n = fit.count()
    drawn = percent * n // 100
    bounds = key_bounds(fit, "_down", range_count(docs.sparkSession, n, RANGE_ROWS))
    numbered = scored.withColumn("_range", F.when(F.col("_fit"), range_of(F.coalesce("_down", F.lit(0)), bounds)))
    starts = range_starts(numbered.where("_fit"), "_range", F.lit(1), len(bounds) + 1)
    upto = int(np.searchsorted(starts, drawn, side="left"))
    before = F.get(F.lit(starts[: upto + 1].tolist()), F.col("_range"))
    place = before + F.row_number().over(Window.partitionBy("_range").orderBy("_down", "key"))
    inside = F.col("_fit") & (F.col("_range") < upto)
    ranked = numbered.where(inside).withColumn("rank", place)
    rest = numbered.where(~inside | F.col("_range").isNull()).withColumn("rank", F.lit(None).cast("long"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")
    return ranked.unionByName(rest).select(F.col("key").alias(key), "n_features", "weight", "score", rank.alias("rank"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RESAMPLE_SQL = f"""
WITH c AS MATERIALIZED (SELECT {CRC_TABLE} AS crc_table),
found AS MATERIALIZED (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{WORD}')) AS word FROM documents) GROUP BY ALL),
wanted AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all({_LOWER}, '{WORD}')) AS word FROM benchmark) GROUP BY ALL),
hashed AS MATERIALIZED (SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM found UNION SELECT word FROM wanted), c),
s AS (SELECT bucket, sum(n) AS s FROM found JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(n), 0) FROM found)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM wanted)::DOUBLE AS t),
gains AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (total.s + 10000) / ((s.s + 1)::DOUBLE * (total.t + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), total),
sums AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM found JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS MATERIALIZED (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN sums USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
