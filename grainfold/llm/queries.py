"""The named queries of the operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.llm import ann, decontaminate, gru_lm, langid, licences, line_dedup, mixing, ngram_join, packing, pii, resampling, spelling, token_counts
from grainfold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer's file; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query(decontaminate.LEAKS_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(line_dedup.LINES_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query(ngram_join.JOIN_SQL)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), os.environ.get("PII_SECRET", "not a secret: set PII_SECRET"))
    return found.select("doc_id", "text", "n_pseudonyms")


@query()
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score_texts(table(spark, sf_dir, "documents"))


@query(mixing.MIX_SQL.format(documents="documents"))
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query()
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score")


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(table(spark, sf_dir, "documents"))


@query(licences.licences_sql())
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.recognise_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), "unmatched")


@query()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query(spelling.WORDS_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


@query(resampling.RESAMPLE_SQL)
def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
