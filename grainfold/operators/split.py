"""Reproducible splits, folds, caps and row numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.functions.numeric import md5_bucket
from grainfold.operators.ordered import OrderedGroups


def split_name(key: Column, shares: Mapping[str, int]) -> Column:
    """Part a row belongs to, by the md5 bucket of its key; shares are percentages adding to 100.

    The same key always falls into the same part, on any cluster and in any order.
    """
    if sum(shares.values()) != 100:
        raise ValueError("shares must add to 100")
    bucket, upto, out = md5_bucket(key), 0, None
    for name, share in shares.items():
        upto += share
        out = F.when(bucket < upto, name) if out is None else out.when(bucket < upto, name)
    return out


def hash_split(df: DataFrame, key: str, shares: Mapping[str, int], name: str = "part") -> DataFrame:
    return df.withColumn(name, split_name(F.col(key), shares))


def split_coverage(df: DataFrame, part: str, label: str) -> DataFrame:
    """Rows per part and label, to see that every part has every class."""
    return df.groupBy(part, label).agg(F.count(F.lit(1)).alias("n"))


def modulo_fold(df: DataFrame, number: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold by a whole-number row id, as folds dealt out in turn."""
    return df.withColumn(name, F.pmod(F.col(number), F.lit(folds)).cast("int"))


def hash_fold(df: DataFrame, key: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold by the md5 of the key, for keys that are not consecutive numbers."""
    return df.withColumn(name, md5_bucket(F.col(key), folds).cast("int"))


def cap_per_class(df: DataFrame, label: str, order: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of every class.

    Spark keeps ``limit`` rows per class and task before the shuffle
    (WindowGroupLimit), so a large class never moves whole.
    """
    window = Window.partitionBy(label).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit).drop("_rank")


def class_shortfall(df: DataFrame, label: str, minimum: int) -> DataFrame:
    """Classes with fewer than ``minimum`` rows, and their size."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < minimum)


def surrogate_id(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], prefix: str, name: str = "row_id",
) -> DataFrame:
    """Ids ``<prefix>0, <prefix>1, ...`` in order inside each group; without keys over the whole table."""
    rows = OrderedGroups(df, keys, order).position("_pos").frame()
    return rows.withColumn(name, F.concat(F.lit(prefix), (F.col("_pos") - 1).cast("string"))).drop("_pos")


def preview_slice(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the ordered table."""
    return df.orderBy(*order).offset(offset).limit(limit)


def top_k(df: DataFrame, score: str, tie: str, k: int) -> DataFrame:
    """The ``k`` highest scores, ties by ``tie``; each task keeps only ``k`` rows."""
    return df.orderBy(F.desc(score), tie).limit(k)
