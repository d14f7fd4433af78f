import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainfold.operators import sequence, signals, timeseries


def jump_by_hand(values):
    """The scan rules, one step at a time."""
    at, still, total = 0, False, 0
    while at < len(values):
        window = values[at:at + 5]
        if window[0] >= 0:
            total, at = total + window[0], at + 1
            continue
        good = [k for k, v in enumerate(window) if v >= 0]
        if good and not still:
            at += good[0]
        elif at + 5 >= len(values):
            break
        elif not still and max(window) == window[0]:
            total, still = total + window[0], True
        else:
            best = int(np.argmax(window[1:])) + 1 if still else int(np.argmax(window))
            total, at, still = total + window[best], at + best, False
    return total


def test_jump_goldens(spark):
    cases = {
        "all good": ([1, 2, 3], 6), "jump over": ([1, -5, -5, 4], 5), "ends in loss": ([2, -1, -1], 2),
        "least bad": ([-3, -2, -4, -5, -6, 7], 5), "stay, then move on": ([-1, -2, -3, -4, -5, -6, 8], 0),
    }
    data = [(name, i, float(v)) for name, (vs, _) in cases.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "k string, i int, v double")
    got = {r.k: r.score for r in sequence.bounded_jump_score(df, "v", ["k"], ["i"]).collect()}
    assert got == {k: float(jump_by_hand(vs)) for k, (vs, _) in cases.items()}
    assert got == {k: float(want) for k, (_, want) in cases.items()}


def test_jump_random_against_steps(spark):
    rng = np.random.default_rng(3)
    series = {k: rng.integers(-9, 4, 60).tolist() for k in range(20)}
    df = spark.createDataFrame([(k, i, float(v)) for k, vs in series.items() for i, v in enumerate(vs)], "k int, i int, v double")
    for chunk in (6, 25, 1000):
        got = {r.k: r.score for r in sequence.bounded_jump_score(df, "v", ["k"], ["i"], chunk=chunk).collect()}
        assert got == {k: float(jump_by_hand(vs)) for k, vs in series.items()}


def test_merge_cases(spark, as_rows):
    data = [("a", 0, 10), ("a", 2, 5), ("a", 10, 12), ("a", 13, 14), ("a", 13, 14), ("b", 5, 6)]
    df = spark.createDataFrame(data, "k string, s int, e int")
    # nested keeps the outer end, touching joins, identical once
    assert as_rows(sequence.merge_intervals(df, "s", "e", ["k"])) == [("a", 0, 12), ("a", 13, 14), ("b", 5, 6)]


def test_frame_labels(spark, as_rows):
    spans = spark.createDataFrame([("f", 0.0, 50.0)], "file string, start double, end double")
    segments = spark.createDataFrame(
        [("f", 5.0, 10.0), ("f", 21.0, 24.0), ("f", 25.0, 28.5), ("f", 38.0, 41.0)], "file string, start double, end double")
    got = {r.frame: (round(r.covered, 6), r.label) for r in sequence.label_frames(spans, segments, 10, "file").collect()}
    # exactly half of frame 0 is not enough; two short pieces make frame 2
    assert got == {0: (0.5, 0), 1: (0.0, 0), 2: (0.65, 1), 3: (0.2, 0), 4: (0.1, 0)}


def test_long_ranges_are_cut(spark):
    df = spark.createDataFrame([(0, 10_000), (5, 4)], "a long, b long")
    out = sequence._explode_range(df, "n", F.col("a"), F.col("b"))
    assert out.agg(F.count("*"), F.sum("n")).first() == (10_001, 50_005_000)


def test_session_concat(spark, as_rows):
    df = spark.createDataFrame(
        [("f", i, y, w) for i, (y, w) in enumerate([(0.0, "the"), (5.0, "quick"), (8.0, "brown"), (9.0, "fox runs"), (60.0, "short")])],
        "file string, line int, y double, word string")
    cut = sequence.gap_sessions(df, F.col("y"), 30, ["file"], ["line"])
    # the first and the last paragraph are there; the last is too short to keep
    assert cut.select("session").distinct().count() == 2
    assert as_rows(sequence.session_concat(cut, "word", ["file", "session"], ["line"])) == [("f", 0, "the quick brown fox runs")]


def series(spark, values, keys=("a",)):
    return spark.createDataFrame([(k, i, float(v)) for k in keys for i, v in enumerate(values)], "k string, i long, x double")


def test_acf_blocks_and_gaps(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    c = x - x.mean()
    want = [float((c[:300 - h] * c[h:]).sum() / (c * c).sum()) for h in range(21)]
    for block in (21, 64, 8192):
        got = [r.acf for r in timeseries.acf(series(spark, x), "i", "x", 20, block).orderBy("lag").collect()]
        assert got == pytest.approx(want)


def test_pacf_solves_yule_walker(spark):
    rng = np.random.default_rng(2)
    x = [0.0]
    for e in rng.normal(size=400):
        x.append(0.7 * x[-1] + e)
    df = series(spark, x)
    r = [row.acf for row in timeseries.acf(df, "i", "x", 6).orderBy("lag").collect()]
    got = [row.pacf for row in timeseries.pacf(df, "i", "x", 6).orderBy("lag").collect()]
    for k in range(1, 7):
        system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(system, r[1:k + 1])[-1])
    ar = {row.term: row.coefficient for row in timeseries.ar_fit(df, "i", "x", 1).collect()}
    assert ar["lag_1"] == pytest.approx(np.polyfit(x[:-1], x[1:], 1)[0])


def test_fill_bins(spark, as_rows):
    df = spark.sql("select timestamp_ntz'2024-01-01 05:00:00' ts, 1d v union all select timestamp_ntz'2024-01-03 01:00:00', 3d")
    out = timeseries.fill_bins(timeseries.resample(df, "ts", "v", "day"), "day")
    assert [(str(b), m) for b, m in as_rows(out)] == [("2024-01-01 00:00:00", 1.0), ("2024-01-02 00:00:00", None), ("2024-01-03 00:00:00", 3.0)]


def test_day_frames_drop_incomplete(spark):
    df = spark.range(30).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) bin", "cast(id as double) mean")
    out = timeseries.day_frames(df).collect()
    assert len(out) == 1 and len(out[0].features) == 23 and out[0].target == 23 - 14.5


def test_spectrum_finds_the_sine(spark):
    n = np.arange(128)
    df = series(spark, 5 + np.sin(2 * np.pi * 9 * n / 128))
    bins = signals.periodogram(df, "i", "x")
    assert signals.dominant_bin(bins).first().k == 9
    fft = np.fft.fft(5 + np.sin(2 * np.pi * 9 * n / 128))
    assert [r.re for r in bins.orderBy("k").collect()] == pytest.approx(fft.real[1:65], abs=1e-9)
    assert [r.im for r in bins.orderBy("k").collect()] == pytest.approx(fft.imag[1:65], abs=1e-9)


@pytest.mark.parametrize("per_block", [2, 256])
def test_stft(spark, per_block):
    x = np.sin(2 * np.pi * 8 * np.arange(500) / 64)
    got = signals.stft_power(series(spark, x, ("a", "b")), "k", "i", "x", 64, per_block).where("k = 'b'").orderBy("frame").collect()
    pad = np.concatenate([np.zeros(32), x, np.zeros(32)])
    pad = np.concatenate([pad, np.zeros(-(len(pad) - 64) % 32)])
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(64) / 64)
    want = [np.abs(np.fft.rfft(pad[s:s + 64] * w) / w.sum()) ** 2 for s in range(0, len(pad) - 63, 32)]
    assert len(got) == len(want)
    assert np.allclose([r.power for r in got], want)
    assert np.argmax(got[5].power) == 8
    examples = signals.group_frames(signals.stft_power(series(spark, x), "k", "i", "x", 64, per_block), "k", 3)
    assert examples.count() == len(want) // 3


def test_cwt_blocks_agree_and_peak(spark):
    x = np.zeros(400)
    x[200] = 1.0
    whole = signals.cwt_ricker(series(spark, x), "k", "i", "x").orderBy("i").collect()
    cut = signals.cwt_ricker(series(spark, x), "k", "i", "x", block=80).orderBy("i").collect()
    assert len(whole) == 400 and np.allclose([r.coef for r in whole], [r.coef for r in cut])
    coef = np.array([r.coef for r in whole])
    assert (np.argmax(coef, axis=0) == 200).all()
    # an impulse shows the wavelet itself, which sums to nothing
    assert np.abs(coef.sum(axis=0)).max() < 1e-2
    hat = lambda t: (1 - t * t) * math.exp(-t * t / 2) * 2 / (math.sqrt(3) * math.pi ** 0.25)
    assert coef[200 + 4, 8] == pytest.approx(hat(4 / 9) / 3, rel=0.05)


def test_kde_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(200, 2)) @ np.array([[2.0, 0.3], [0.0, 0.5]])
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts], "x double, y double").repartition(3)
    got = signals.kde_grid(df, "x", "y", 6).orderBy("i", "j").collect()
    cov = np.cov(pts.T) * 200 ** (-1 / 3)
    inv, norm = np.linalg.inv(cov), 200 * 2 * np.pi * np.sqrt(np.linalg.det(cov))
    for r in got:
        d = np.array([r.x, r.y]) - pts
        assert r.density == pytest.approx(np.exp(-0.5 * np.einsum("ni,ij,nj->n", d, inv, d)).sum() / norm)


def test_template(spark):
    i = np.arange(1100)
    s = -2 * np.pi * 0.6 + 4 * np.pi * 0.6 * np.minimum(i + 90, 1099) / 1099
    y = 1.6 * (np.cos(7 * s) - np.exp(-24.5)) * np.exp(-s * s / 2) * np.pi ** -0.25
    row = signals.template_fit(series(spark, y), "i", "x", 1100).first()
    assert row.r2 == pytest.approx(1.0) and row.residual == pytest.approx(0.0, abs=1e-9)


def test_noise_has_its_power(spark):
    out = signals.add_noise(series(spark, np.zeros(4000)), "x", 8.0, 3, "i")
    assert out.agg(F.stddev("x")).first()[0] == pytest.approx(math.sqrt(2), rel=0.1)


def test_spectrum_of_a_series_with_gaps(spark):
    rows = [(t + 1000, 5.0 + math.sin(2 * math.pi * 30 * t / 720)) for t in range(720) if t % 7 or t in (0, 719)]
    bins = signals.periodogram(spark.createDataFrame(rows, "i long, x double"), "i", "x")
    assert bins.count() == 360 and signals.dominant_bin(bins).first().k == 30


@pytest.mark.parametrize("n", [50, 3000])
def test_binned_density_is_near_the_sums(spark, n):
    rng = np.random.default_rng(n)
    points = rng.normal(size=(n, 2)) @ np.array([[1.0, 0.7], [0.0, 30.0]]) + [1e9, 5]
    df = spark.createDataFrame([*((float(a), float(b)) for a, b in points), (None, 1.0)], "a double, b double")
    exact = signals.kde_grid(df, "a", "b", 40).orderBy("i", "j").collect()
    found = signals.kde_binned(df, "a", "b", 40, fine=20).orderBy("i", "j").collect()
    assert [(r.i, r.j) for r in found] == [(r.i, r.j) for r in exact] and np.allclose([r.x for r in found], [r.x for r in exact])
    want = np.array([r.density for r in exact])
    assert np.abs(np.array([r.density for r in found]) - want).max() <= 1e-4 * want.max()
