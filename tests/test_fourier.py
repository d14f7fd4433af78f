"""Transforms in pieces against numpy, and autoregressions of blocks against plain least squares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainfold.operators import fourier, signals, timeseries


@pytest.mark.parametrize("n", [1, 2, 7, 8, 12, 30, 64, 97, 210])
def test_any_length(spark, n):
    """With groups of at most 8 samples: cut lengths, lengths of one group, and primes."""
    x = np.random.default_rng(n).normal(size=n)
    rows = spark.createDataFrame([(n, j, float(v), 0.0) for j, v in enumerate(x)], "_n long, _j long, re double, im double")
    found = fourier.spectrum(rows, rows.select("_n").distinct(), [], longest=8).orderBy("k").collect()
    assert [r.k for r in found] == list(range(n))
    assert np.allclose([r.re + 1j * r.im for r in found], np.fft.fft(x), atol=1e-9)


def test_many_series_of_many_lengths(spark):
    rng = np.random.default_rng(3)
    series = {f"s{n}": rng.normal(size=n) for n in (1, 5, 8, 24, 49, 101)} | {None: rng.normal(size=9)}
    rows = spark.createDataFrame([(s, len(x), j, float(v), 0.5) for s, x in series.items() if s for j, v in enumerate(x)], "s string, _n long, _j long, re double, im double")
    found = fourier.spectrum(rows, rows.select("s", "_n").distinct(), ["s"], longest=8).collect()
    for s, x in series.items():
        if s:
            got = {r.k: r.re + 1j * r.im for r in found if r.s == s}
            assert np.allclose([got[k] for k in range(len(x))], np.fft.fft(x + 0.5j), atol=1e-9)


def test_back_again(spark):
    x = np.random.default_rng(1).normal(size=36)
    rows = spark.createDataFrame([(36, j, float(v), float(-v)) for j, v in enumerate(x)], "_n long, _j long, re double, im double")
    there = fourier.transform(rows, [], longest=8).withColumnRenamed("k", "_j")
    back = fourier.transform(there, [], inverse=True, longest=8).orderBy("k").collect()
    assert np.allclose([r.re + 1j * r.im for r in back], x * (1 - 1j), atol=1e-9)


def test_a_million_samples(spark):
    n = 1 << 20
    rows = spark.range(n).select("id", (F.sin(F.col("id") * (2 * np.pi * 1234 / n)) + 0.25 * F.cos(F.col("id") * (2 * np.pi * 400_000 / n))).alias("x"))
    top = signals.periodogram(rows, "id", "x").where("magnitude > 100").orderBy("k").collect()
    assert [(r.k, round(r.magnitude / n, 6)) for r in top] == [(1234, 0.5), (400_000, 0.125)]


def series_with_gaps(n, seed, gaps):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for t in range(3, n):
        x[t] = 0.5 * x[t - 1] - 0.3 * x[t - 3] + rng.normal()
    known = np.ones(n, bool)
    known[rng.choice(n, gaps, replace=False)] = False
    return x + 7, known


def plain_fit(x, known, order):
    rows = [[1.0, *x[t - order : t][::-1]] + [x[t]] for t in range(order, len(x)) if known[t - order : t + 1].all()]
    table = np.array(rows)
    return np.linalg.lstsq(table[:, :-1], table[:, -1], rcond=None)[0], len(rows)


@pytest.mark.parametrize("order, block, gaps", [(1, 50, 0), (3, 64, 12), (12, 13, 5), (40, 100, 3), (5, 10_000, 0)])
def test_autoregression_of_blocks(spark, order, block, gaps):
    x, known = series_with_gaps(900, order, gaps)
    df = spark.createDataFrame([(i, float(v) if k else None) for i, (v, k) in enumerate(zip(x, known))], "i long, x double")
    mean, n, sums, products = timeseries.ar_equations(df, "i", "x", order, block)
    want, rows = plain_fit(x, known, order)
    centred = np.where(known, x, 0) - mean
    windows = np.array([centred[t - order : t + 1][::-1] for t in range(order, 900) if known[t - order : t + 1].all()])
    assert n == rows and mean == pytest.approx(x[known].mean())
    assert np.allclose(sums, windows.sum(0)) and np.allclose(products, windows.T @ windows)
    fit = {r.term: r.coefficient for r in timeseries.ar_fit(df, "i", "x", order).collect()}
    assert np.allclose([fit["intercept"]] + [fit[f"lag_{h}"] for h in range(1, order + 1)], want, atol=1e-6)


def test_many_blocks_are_added_in_rounds(spark):
    rows = spark.range(1000).select("id", F.array(F.lit(1.0), F.col("id").cast("double")).alias("v"))
    assert timeseries.add_arrays(rows, "id", "v", fan=4).tolist() == [1000.0, 499_500.0]
    assert timeseries.add_arrays(rows.limit(0), "id", "v") is None


def test_no_complete_window(spark):
    df = spark.createDataFrame([(0, 1.0), (2, 2.0), (9, None)], "i long, x double")
    assert [r.coefficient for r in timeseries.ar_fit(df, "i", "x", 1).orderBy("term").collect()] == [1.5, 0.0]
