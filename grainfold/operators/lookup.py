"""Lookups: dimension tables, wide rate rows, code clean-up, peer groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.operators.clean import attach
from grainfold.session import stored


def rate_lookup(df: DataFrame, rates: DataFrame, key: str, name: str = "rate") -> DataFrame:
    """Find each row's rate in a one-row table whose columns are the keys.

    The wide row has as many rates as columns, so its long form is small by
    construction and is broadcast. Rows with an unknown key go; more than one row of rates is an error.
    """
    if len(rates.take(2)) > 1:
        raise ValueError("rates must have one row: choose one by its date first")
    long = rates.unpivot([], rates.columns, key, name).where(F.col(name).isNotNull())
    return df.join(F.broadcast(long), key)


def dim_lookup(df: DataFrame, dim: DataFrame, on: str, code: str, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Left lookup of ``columns`` in a dimension table with one row per ``code``."""
    picked = dim.select(F.col(code).alias(on), *[F.col(c).alias(prefix + c) for c in columns])
    return df.join(picked, on, "left")


def keep_matching(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; a key that occurs often there is reduced to one row first."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def pair_check(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many keys occur on both sides and on one side only."""
    left = a.groupBy(key).agg(F.lit(True).alias("_a"))
    right = b.groupBy(key).agg(F.lit(True).alias("_b"))
    return left.join(right, key, "full").agg(
        F.count_if(F.col("_a") & F.col("_b")).alias("paired"),
        F.count_if(F.col("_b").isNull()).alias("only_left"),
        F.count_if(F.col("_a").isNull()).alias("only_right"),
    )


def canonical_codes(df: DataFrame, name: str, code: str, order: str) -> DataFrame:
    """Names that occur with several codes, and the code seen first for each."""
    return (
        df.groupBy(name)
        .agg(F.min(F.struct(order, code)).alias("_first"), F.min(code).alias("_lo"), F.max(code).alias("_hi"))
        .where(F.col("_lo") != F.col("_hi"))
        .select(name, F.col("_first")[code].alias("canonical"))
    )


def use_canonical_code(df: DataFrame, name: str, code: str, order: str) -> DataFrame:
    """Replace every code by the first code seen for the same name."""
    out = attach(df, canonical_codes(df, name, code, order), [name])
    return out.withColumn(code, F.coalesce("canonical", code)).drop("canonical")


def peer_deviation(df: DataFrame, value: str, keys: Sequence[str], name: str = "deviation") -> DataFrame:
    """Value minus the mean of its peer group; NULL where a key part is NULL."""
    means = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias("_peer"))
    return attach(df, means, keys).withColumn(name, F.col(value) - F.col("_peer")).drop("_peer")


def mean_peer_deviation(df: DataFrame, value: str, peer: Sequence[str], by: Sequence[str], name: str) -> DataFrame:
    """Mean deviation from the peer-group mean per ``by`` group, with the row count.

    Rows are read once: sums and counts per peer group and ``by`` group give both the means and the deviations.
    """
    cells = stored(
        df.dropna(subset=list(peer))
        .groupBy(*dict.fromkeys([*peer, *by]))
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_known"), F.count(F.lit(1)).alias("_rows"))
    )
    means = cells.groupBy(*peer).agg((F.sum("_sum") / F.sum("_known")).alias("_peer"))
    off = F.sum(F.col("_sum") - F.col("_known") * F.col("_peer"))
    return attach(cells, means, peer).groupBy(*by).agg(F.try_divide(off, F.sum("_known")).alias(name), F.sum("_rows").alias("n"))
