"""Resampling, autocorrelation, autoregression."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.operators.sequence import halo_blocks
from grainfold.session import discard, stored

_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def resample(df: DataFrame, ts: str, value: str, unit: str, keys: Sequence[str] = (), name: str = "mean") -> DataFrame:
    """Mean per calendar ``unit``; bins without rows are absent."""
    return df.groupBy(*keys, F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("bin")).agg(F.avg(value).alias(name))


def fill_bins(binned: DataFrame, unit: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the bins missing between the first and the last of each series, with NULL values."""
    step = F.expr(f"interval 1 {unit}")
    spine = binned.groupBy(*keys).agg(F.min("bin").alias("_a"), F.max("bin").alias("_b"))
    spine = spine.select(*keys, F.explode(F.sequence("_a", "_b", step)).alias("bin"))
    return spine.join(binned, [*keys, "bin"], "left")


def bin_index(binned: DataFrame, unit: str, name: str = "idx") -> DataFrame:
    """Number bins by time, so that no ordering window is needed; the first bin is 0."""
    whole = F.floor(F.unix_micros(F.col("bin").cast("timestamp")) / (_SECONDS[unit] * 1_000_000))
    first = binned.select(F.min(whole)).scalar()
    return binned.withColumn(name, whole - first)


def time_slice(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows from start to end, both included."""
    return df.where(F.col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def acf(series: DataFrame, index: str, value: str, max_lag: int, block: int = 8192) -> DataFrame:
    """Autocorrelation (lag, acf) for lags 0..max_lag of one evenly indexed series.

    The series is cut into blocks that also see the next ``max_lag`` samples, so a
    sample moves at most twice, whatever the number of lags; each block adds its
    lagged products. Missing samples drop out of their pairs.
    """
    block = max(block, max_lag + 1)
    mean = series.select(F.avg(value)).scalar()
    centred = series.where(F.col(value).isNotNull()).select(
        F.col(index).cast("long").alias("_i"), (F.col(value) - mean).cast("double").alias("_x")
    )

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        start = int(pdf["block"].iloc[0]) * block
        x = np.zeros(block + max_lag)
        x[pdf["_i"].to_numpy() - start] = pdf["_x"].to_numpy()
        own = x[:block]
        sums = [float(own @ x[h:h + block]) for h in range(max_lag + 1)]
        return pd.DataFrame({"lag": np.arange(max_lag + 1), "s": sums})

    cut = halo_blocks(centred, "_i", block, 0, max_lag).where("block >= 0")
    sums = cut.groupBy("block").applyInPandas(products, "lag int, s double")
    sums = sums.groupBy("lag").agg(F.sum("s").alias("s"))
    power = centred.select(F.sum(F.col("_x") * F.col("_x"))).scalar()
    return sums.select("lag", F.try_divide(F.col("s"), power).alias("acf"))


def pacf(series: DataFrame, index: str, value: str, max_lag: int) -> DataFrame:
    """Partial autocorrelation (lag, pacf): Durbin-Levinson on the autocorrelations.

    Only the ``max_lag + 1`` autocorrelations come to the driver.
    """
    rows = acf(series, index, value, max_lag).orderBy("lag").collect()
    r = np.array([row["acf"] for row in rows])
    out, phi = [(0, 1.0)], np.zeros(0)
    for k in range(1, max_lag + 1):
        error = 1.0 - phi @ r[1:k]
        last = (r[k] - phi @ r[k - 1:0:-1]) / error if abs(error) > 1e-12 else 0.0
        phi = np.append(phi - last * phi[::-1], last)
        out.append((k, float(last)))
    return series.sparkSession.createDataFrame(out, "lag int, pacf double")


def lag_features(series: DataFrame, index: str, value: str, order: int) -> DataFrame:
    """Samples with their ``order`` predecessors as columns lag_1..lag_order.

    Every sample is sent to the rows it is a lag of and collected by one
    aggregation, without an ordering window over the series.
    """
    known = series.where(F.col(value).isNotNull()).select(F.col(index).alias("_i"), F.col(value).alias("_x"))
    sent = known.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(order)))).select(
        (F.col("_i") + F.col("_h")).alias(index), "_h", "_x"
    )
    columns = [F.max(F.when(F.col("_h") == h, F.col("_x"))).alias(f"lag_{h}" if h else value) for h in range(order + 1)]
    return sent.groupBy(index).agg(*columns).dropna()


def lagged_sums(x: np.ndarray, known: np.ndarray, order: int) -> np.ndarray:
    """Counts, sums and products of all windows of ``order + 1`` known samples that end in ``x[order:]``, as one flat array.

    Along a run of windows the product of lags a + 1 and b + 1 is that of a and b, moved by one sample: the products with lag 0 are
    summed up, all others follow from them and the run's ends. No sample is copied for a lag.
    """
    p = order + 1
    n, sums, products = 0, np.zeros(p), np.zeros((p, p))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], known.astype(np.int8), [0]])))
    for begin, end in zip(edges[::2], edges[1::2]):
        first = begin + order
        if first >= end:
            continue
        n += end - first
        own = x[first:end]
        # what enters and leaves when the windows move back by a sample
        gone, come = x[:end][::-1][:order], x[:first][::-1][:order]
        row = np.array([own @ x[first - b : end - b] for b in range(p)])
        part = np.zeros((p, p))
        part[0], part[:, 0] = row, row
        shift = np.outer(come, come) - np.outer(gone, gone)
        for d in range(order):
            diagonal = part[0, d] + np.concatenate([[0], np.cumsum(np.diagonal(shift, d))])
            at = np.arange(p - d)
            part[at, at + d] = diagonal
            part[at + d, at] = diagonal
        products += part
        sums += own.sum() + np.concatenate([[0], np.cumsum(come - gone)])
    return np.concatenate([[n], sums, products.ravel()])


def add_arrays(rows: DataFrame, number: str, value: str, fan: int = 32) -> np.ndarray | None:
    """Sum of equally long arrays of numbered rows, ``fan`` at a time, until few enough are left for the driver; None without rows."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = table.column(value).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({number: pa.array([int(key[0].as_py())], pa.int64()), value: pa.array([total], pa.list_(pa.float64()))})

    here = stored(rows.select(F.col(number).cast("long").alias(number), value))
    while here.count() > fan:
        there = stored(here.groupBy(F.floor(F.col(number) / fan).alias("_g")).applyInArrow(add, f"`{number}` long, `{value}` array<double>"))
        discard(here)
        here = there
    found = [np.array(r[0]) for r in here.select(value).collect()]
    discard(here)
    return sum(found) if found else None


def ar_equations(series: DataFrame, index: str, value: str, order: int, block: int = 1 << 16) -> tuple[float, int, np.ndarray, np.ndarray]:
    """(mean, n, sums, products) of the ``n`` complete windows of ``order + 1`` samples, less the mean: what least squares needs.

    The series is cut into blocks that also see the ``order`` samples before them; a block gives one row.
    """
    block = max(block, order + 1)
    rows = series.where(F.col(value).isNotNull())
    mean = rows.agg(F.avg(value)).first()[0] or 0.0
    centred = rows.select(F.col(index).cast("long").alias("_i"), (F.col(value) - mean).cast("double").alias("_x"))

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        number = int(key[0].as_py())
        at = table.column("_i").to_numpy() - number * block + order
        x, known = np.zeros(block + order), np.zeros(block + order, bool)
        x[at], known[at] = table.column("_x").to_numpy(), True
        return pa.table({"block": pa.array([number], pa.int64()), "v": pa.array([lagged_sums(x, known, order)], pa.list_(pa.float64()))})

    cut = halo_blocks(centred, "_i", block, order, 0)
    found = add_arrays(cut.withColumn("block", F.col("block").cast("long")).groupBy("block").applyInArrow(sums, "block long, v array<double>"), "block", "v")
    if found is None:
        return mean, 0, np.zeros(order + 1), np.zeros((order + 1, order + 1))
    return mean, int(found[0]), found[1 : order + 2], found[order + 2 :].reshape(order + 1, order + 1)


def ar_fit(series: DataFrame, index: str, value: str, order: int) -> DataFrame:
    """Autoregression by least squares: (term, coefficient), terms ``intercept`` and ``lag_n``.

    Normal equations in one pass over blocks of the series; only windows without a gap count. The system of
    ``order + 1`` equations is solved on the driver; of several solutions, the shortest.
    """
    mean, n, sums, products = ar_equations(series, index, value, order)
    left = np.zeros((order + 1, order + 1))
    left[0, 0], left[0, 1:], left[1:, 0], left[1:, 1:] = n, sums[1:], sums[1:], products[1:, 1:]
    right = np.concatenate([sums[:1], products[0, 1:]])
    c = np.linalg.lstsq(left, right, rcond=None)[0]
    found = [("intercept", float(c[0] + mean * (1 - c[1:].sum())))] + [(f"lag_{h}", float(c[h])) for h in range(1, order + 1)]
    return series.sparkSession.createDataFrame(found, "term string, coefficient double")


def day_frames(hourly: DataFrame, value: str = "mean", steps: int = 24) -> DataFrame:
    """Complete days of an hourly series: centred ``features`` (all but the last hour) and ``target``.

    The input has one row per hour, so a day's array is bounded by ``steps``.
    """
    mean = hourly.select(F.avg(value)).scalar()
    centred = hourly.where(F.col(value).isNotNull()).select("bin", (F.col(value) - mean).alias("x"))
    days = centred.groupBy(F.to_date("bin").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("bin", "x"))).alias("_steps")
    ).where(F.size("_steps") == steps)
    values = F.transform("_steps", lambda s: s["x"])
    return days.select(
        "day", F.slice(values, 1, steps - 1).alias("features"), F.element_at(values, steps).alias("target")
    )
