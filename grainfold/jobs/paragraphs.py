"""Scanned pages to paragraphs, topics and clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Normalizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions import text as t
from grainfold.operators import cluster, sequence, terms
from grainfold.session import settle

LINE = ["block", "row"]


def paragraphs(tokens: DataFrame, dictionary: DataFrame, jump: float = 30, min_length: int = 20) -> DataFrame:
    """Paragraph texts per file: a new one starts where y0 jumps; only dictionary words are kept.

    ``tokens`` comes from ``scan_tokens``; ``dictionary`` has one column ``word``.
    """
    words = tokens.withColumn("word", F.trim(t.clean_token(F.col("word"))))
    cut = sequence.gap_sessions(words, F.col("y0"), jump, ["file"], LINE, "paragraph")
    known = terms.keep_known_words(cut.where(F.length("word") > 0), "word", dictionary)
    return sequence.session_concat(known, "word", ["file", "paragraph"], LINE, min_length)


def topics(texts: DataFrame, key: str, k: int = 50, features: int = 1000, words: int = 20, min_df: int = 5, max_iter: int = 5) -> DataFrame:
    """The heaviest words of LDA topics."""
    stop = terms.french_stop_words()
    rows = texts.select(key, terms.token_array(F.col("text"), t.LETTERS, stop=stop).alias("tokens"))
    model = Pipeline(stages=terms.vectorizer("tokens", min_df=min_df, max_df=0.8, max_features=features, use_idf=False)).fit(rows)
    counts = settle(model.transform(rows).select(key, "features"))
    return cluster.topic_terms(cluster.lda_topics(counts, k, max_iter), model.stages[0].vocabulary, words)


def factors(texts: DataFrame, key: str, k: int = 50, features: int = 1000, words: int = 20, min_df: int = 5, max_iter: int = 50) -> DataFrame:
    """The heaviest words of non-negative factors of TF-IDF."""
    stop = terms.french_stop_words()
    weights = terms.tfidf(texts, key, "text", t.LETTERS, stop=stop, min_df=min_df, max_df=0.8, max_features=features)
    vocabulary = sorted(r[0] for r in weights.select("term").distinct().collect())
    rows = cluster.sparse_rows(weights, key, "term", "tfidf", vocabulary)
    h, _ = cluster.nmf_topics(rows, len(vocabulary), k, max_iter)
    return cluster.factor_terms(h, vocabulary, words, texts.sparkSession)


def text_vectors(texts: DataFrame, key: str, size: int = 100, min_count: int = 5) -> DataFrame:
    """Mean word vector per text, scaled to length 1: (key, features)."""
    rows = texts.select(key, F.split("text", " ").alias("tokens"))
    vectors = terms.word_vectors(rows, "tokens", size, min_count).transform(rows)
    return Normalizer(inputCol="vector", outputCol="features", p=2.0).transform(vectors).select(key, "features")


def cluster_sweep(vectors: DataFrame, ks=range(2, 50, 3), share: float = 0.95) -> DataFrame:
    """Inertia and silhouette per number of clusters, after dimension reduction."""
    reduced, _ = cluster.pca_reduce(vectors, share)
    return cluster.kmeans_sweep(reduced.select(F.col("reduced").alias("features")), ks)
