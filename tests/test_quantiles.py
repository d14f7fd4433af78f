"""Quantiles by radix histograms against Spark's exact percentile, and long jump scans against the steps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainfold.operators import profile, sequence

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def test_every_size_of_number(spark):
    rng = np.random.default_rng(1)
    values = [*rng.normal(size=300), *(10.0 ** rng.integers(-300, 300, 200)), *(-(10.0 ** rng.integers(-300, 300, 100))), 0.0, -0.0, 5e-324, -5e-324, *[7.25] * 400]
    df = spark.createDataFrame([(("a", "b", None)[i % 3], float(v)) for i, v in enumerate(values)] + [("c", None), ("d", 3.0)], "k string, v double")
    got = {r.k: tuple(r)[1:] for r in profile.quantiles(df, ["k"], "v", PROBS).collect()}
    want = {r.k: tuple(r.q) for r in df.groupBy("k").agg(F.percentile("v", PROBS).alias("q")).collect() if r.q}
    assert set(got) == {"a", "b", None, "d"} == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_whole_table_and_no_rows(spark):
    df = spark.range(1001).select((F.col("id") * 0.5).alias("v"), F.lit(1).alias("one"))
    assert tuple(profile.quantiles(df, [], "v", [0.5, 0.333]).first()) == pytest.approx((250.0, 166.5))
    assert profile.quantiles(df.limit(0), ["one"], "v", [0.5]).count() == 0
    assert profile.quantiles(df, ["one"], "v", [0.5]).first().q50 == 250.0


def test_infinite_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),), (float("inf"),), (float("nan"),)], "v double")
    low, mid, high, top = profile.quantiles(df, [], "v", [0.0, 0.25, 0.75, 1.0]).first()
    assert (low, mid, high) == (float("-inf"), 1.0, float("inf")) and math.isnan(top)


def test_many_rows_of_one_group(spark):
    """Hot keys and repeated values are counted, not sorted."""
    df = spark.range(200_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"), F.when(F.col("id") % 5 > 0, 1.5).otherwise(F.col("id") / 7).alias("v"))
    got = {r.k: (r.q50, r.q99) for r in profile.quantiles(df, ["k"], "v", [0.5, 0.99]).collect()}
    want = {r.k: tuple(r.q) for r in df.groupBy("k").agg(F.percentile("v", [0.5, 0.99]).alias("q")).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def steps_of(values):
    at, still, total, n = 0, False, 0, len(values)
    while at < n:
        window = values[at : at + 5]
        if window[0] >= 0:
            total, at, still = total + window[0], at + 1, False
            continue
        good = next((k for k, v in enumerate(window) if v >= 0), None)
        if good is not None:
            at, still = at + good, False
        elif at + 5 >= n:
            break
        else:
            skip = 1 if still else 0
            best = skip + int(np.argmax(window[skip:]))
            total, at, still = total + window[best], at + best, best == 0
    return total


@pytest.mark.parametrize("chunk, fan", [(5, 2), (64, 3), (1000, 64)])
def test_long_scans_in_rounds(spark, chunk, fan):
    rng = np.random.default_rng(chunk)
    series = {k: rng.integers(-9, 3 + k, 900 * k + 3) for k in range(4)}
    df = spark.createDataFrame([(k, i, float(v)) for k, vs in series.items() for i, v in enumerate(vs)], "k int, i int, v double")
    got = {r.k: r.score for r in sequence.bounded_jump_score(df, "v", ["k"], ["i"], chunk=chunk, fan=fan).collect()}
    assert got == {k: float(steps_of(vs.tolist())) for k, vs in series.items()}
