"""Resampling of a stream by event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resample_stream(
    events: DataFrame, ts: str, value: str, width: str, late: str, keys: Sequence[str] = (), name: str = "mean",
) -> DataFrame:
    """Mean per event-time bin of ``width``; rows more than ``late`` behind the newest are left out.

    The state is one sum and count per open bin and key, whatever the event rate.
    On a batch DataFrame the watermark has no effect and the result is that of
    ``timeseries.resample``.
    """
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    out = rows.groupBy(*keys, F.window(ts, width).alias("_bin")).agg(F.avg(value).alias(name))
    return out.select(*keys, F.col("_bin.start").cast("timestamp_ntz").alias("bin"), name)
