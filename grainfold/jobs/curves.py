"""Curve fit with a wavelet, and the density of purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.dates import epoch_seconds, parse_ts
from grainfold.operators import signals


def spectrum(curve: DataFrame, index: str, value: str, max_bin: int) -> tuple[DataFrame, DataFrame]:
    """Fourier bins of the curve and the strongest of them."""
    bins = signals.periodogram(curve, index, value, max_bin=max_bin)
    return bins, signals.dominant_bin(bins)


def wavelet_fit(curve: DataFrame, index: str, value: str) -> DataFrame:
    """R squared and residual of the wavelet template."""
    length = curve.select(F.max(index) + 1).scalar()
    return signals.template_fit(curve, index, value, length)


def purchase_density(purchases: DataFrame, cells: int = 200) -> DataFrame:
    """Density of (seconds since the first purchase + 1, amount) on a grid."""
    rows = purchases.select(epoch_seconds(parse_ts(F.col("time"))).alias("time"), "amount")
    first = rows.select(F.min("time")).scalar()
    return signals.kde_grid(rows.withColumn("time", F.col("time") - first + 1), "time", "amount", cells)
