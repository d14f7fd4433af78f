"""Token counts through a cache of content digests."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import bounded_batches
from grainfold.session import scratch

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def load_tokenizer(name: str, data: bytes, pattern: str | None = None) -> Callable[[list[str]], list[int]]:
    """Function from texts to token counts for a tokenizer file's bytes; the file's ending tells the library.

    No begin, end or other special tokens are added, and their strings in a text are ordinary
    text, except where the sentencepiece library itself has no such choice.
    """
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(data.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(x) for x in model.encode_batch(texts, add_special_tokens=False)]
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    model = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(model.encode_ordinary(x)) for x in texts]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache: str | None = None,
    limit: int = 4096,
    text: str = "text",
    key: str = "doc_id",
    normalise: Callable[[Column], Column] = lambda c: c,
    pattern: str | None = None,
) -> DataFrame:
    """Token count of every whole text: the key, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    ``cache`` is a Parquet folder of counts by content digest and tokenizer digest (default: a
    fresh one in the shared folder). Each distinct content that isn't there yet is encoded once
    and appended; then all rows read their counts from it. ``normalise`` must not change counts.
    Copies of a text meet before the shuffle, so groups of copies of any size are one row per task.

    Null text counts as empty, with 0 bytes and tokens. Rows with null or repeated keys are kept as
    they are; an empty table gives an empty result; other columns don't matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, "rb") as file:
        model = file.read()
    version = hashlib.sha256(model + (pattern or "").encode()).hexdigest()
    name = tokenizer_path
    cache = cache or scratch(spark, "token-counts")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)

    raw = F.coalesce(F.col(text), F.lit(""))
    content = normalise(raw)
    rows = docs.select(F.col(key).alias("_key"), F.octet_length(raw).cast("long").alias("n_bytes"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("_digest"), content.alias("_text"))

    def known() -> DataFrame:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
        return found.groupBy(F.col("digest").alias("_digest")).agg(F.min("n_tokens").alias("n_tokens"))

    shipped = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_tokenizer(name, shipped.value, pattern)
        for batch in batches:
            sizes = count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([version] * len(sizes), pa.string()), pa.array(sizes, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    distinct = rows.groupBy("_digest").agg(F.first("_text").alias("_text"))
    misses = distinct.join(known(), "_digest", "left_anti").select("_digest", "_text")
    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    return rows.drop("_text").join(known(), "_digest").select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
