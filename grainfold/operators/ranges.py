"""Range partitions with bounds that stay the same however often a plan is evaluated."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def range_count(spark: SparkSession, size: int, most: int) -> int:
    """Ranges of at most about ``most``, but no fewer than Spark's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // most))


def key_bounds(df: DataFrame, key: str, ranges: int) -> np.ndarray:
    """Upper bounds of about equally full ranges of a long column, 8 bytes each.

    ``df`` should be a stored table, as it is read once more.
    """
    if ranges < 2:
        return np.zeros(0, np.int64)
    shares = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
    found = df.agg(F.expr(f"percentile_approx({key}, array({shares}), {10 * max(ranges, 1000)})")).first()[0]
    return np.unique(np.array(found or [], np.int64))


def range_of(key: Column, bounds: np.ndarray) -> Column:
    """Number of the range that a long falls into; equal values share one."""

    @F.pandas_udf("int")
    def find(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy(), side="left").astype(np.int32))

    return find(key)


def range_starts(df: DataFrame, number: str, size: Column, ranges: int) -> np.ndarray:
    """What all ranges before each one hold together; one entry more, the total, at the end."""
    held = np.zeros(ranges + 1, np.int64)
    for row in df.groupBy(number).agg(F.sum(size).alias("n")).collect():
        held[row[number] + 1] = row["n"]
    return np.cumsum(held)
