"""Spectra, wavelets, template fit, density on a grid, noise."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from grainfold.operators import fourier
from grainfold.operators.clean import attach
from grainfold.operators.sequence import halo_blocks


def periodogram(series: DataFrame, index: str, value: str, keys: Sequence[str] = (), max_bin: int | None = None) -> DataFrame:
    """Fourier coefficients re, im and magnitude per series, of bins 1 up to half its length (or ``max_bin``).

    A series lies on a whole-number grid that begins at its first index; its mean is taken off, so that gaps count as
    the mean. Series are transformed in pieces of bounded size (see :mod:`fourier`), at a cost of n log n.
    """
    keys = list(keys)
    grid = series.groupBy(*keys).agg(F.min(index).alias("_at"), (F.max(index) - F.min(index) + 1).cast("bigint").alias("_n"), F.avg(value).alias("_mean"))
    if keys:
        rows = attach(series, grid, keys)
    else:
        rows = series.withColumns({c: grid.select(c).scalar() for c in ("_at", "_n", "_mean")})
    off = F.coalesce((F.col(value) - F.col("_mean")).cast("double"), F.lit(0.0))
    samples = rows.where("_n > 1").select(*keys, "_n", (F.col(index) - F.col("_at")).cast("long").alias("_j"), off.alias("re"), F.lit(0.0).alias("im"))
    lengths = grid.where("_n > 1").select(*keys, "_n")
    found = fourier.spectrum(samples, lengths, keys).where((F.col("k") >= 1) & (F.col("k") <= F.floor(F.col("_n") / 2)))
    if max_bin is not None:
        found = found.where(F.col("k") <= max_bin)
    return found.select(*keys, "k", "re", "im", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("magnitude"))


def dominant_bin(spectrum: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bin of the largest magnitude; of equals the lowest."""
    return spectrum.groupBy(*keys).agg(
        F.max_by("k", F.struct("magnitude", -F.col("k"))).alias("k"), F.max("magnitude").alias("magnitude")
    )


def morlet(index: Column, length: int | Column, w: float = 7.0, s: float = 0.6) -> Column:
    """Real part of the complete Morlet wavelet of ``length`` samples at ``index``."""
    x = (F.lit(-2 * math.pi * s) + F.lit(4 * math.pi * s) * index / (F.lit(length) - 1))
    return (F.cos(x * w) - math.exp(-0.5 * w * w)) * F.exp(x * x * -0.5) * (math.pi ** -0.25)


def template_fit(
    series: DataFrame, index: str, value: str, length: int | Column, shift: int = 90, scale: float = 1.6, w: float = 7.0, s: float = 0.6
) -> DataFrame:
    """R squared and L2 residual of a shifted, scaled Morlet wavelet against the series.

    The last ``shift`` samples hold the wavelet's final value.
    """
    at = F.least(F.col(index) + shift, F.lit(length) - 1)
    rows = series.select(F.col(value).alias("y"), (morlet(at, length, w, s) * scale).alias("f"))
    gap = F.col("y") - F.col("f")
    return rows.agg(
        (1 - F.try_divide(F.sum(gap * gap), F.var_pop("y") * F.count("y"))).alias("r2"),
        F.sqrt(F.sum(gap * gap)).alias("residual"),
    )


def _kernel(df: DataFrame, x: str, y: str) -> tuple[DataFrame, Row, np.ndarray]:
    """Points without nulls, their moments, and the covariance of the kernel: that of the points times Scott's n^(-1/3)."""
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    m = points.agg(
        F.count("x").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("vxy"),
    ).first()
    return points, m, np.array([[m.vx, m.vxy], [m.vxy, m.vy]]) * m.n ** (-2 / 6)


def kde_binned(df: DataFrame, x: str, y: str, cells: int = 200, fine: int = 4) -> DataFrame:
    """What ``kde_grid`` gives, from points that are first dealt to the nodes of a grid ``fine`` times as close.

    A point weighs on the four nodes around it as near as it is to each; the weights, whose number is bounded by the grid, are
    convolved with the rotated kernel by a Fourier transform. The cost is points + nodes log nodes. With nodes
    ``h`` kernel deviations apart the error is at most about h * h / 8 in each direction, in shares of the largest density: below 1e-4
    for 200 cells and tens of thousands of points; for many more points, whose kernel is narrower, raise ``fine``.
    """
    points, m, cov = _kernel(df, x, y)
    nodes = (cells - 1) * fine + 1
    step = np.array([m.x1 - m.x0, m.y1 - m.y0]) / (nodes - 1)
    a, b = ((F.col(c) - F.lit(lo)) / F.lit(float(s)) for c, lo, s in (("x", m.x0, step[0]), ("y", m.y0, step[1])))
    i, j = (F.least(F.floor(v), F.lit(nodes - 2)) for v in (a, b))
    corners = F.array(*[
        F.struct((i + di).alias("i"), (j + dj).alias("j"), ((a - i if di else 1 - (a - i)) * (b - j if dj else 1 - (b - j))).alias("w")) for di in (0, 1) for dj in (0, 1)
    ])
    weights = points.select(F.inline(corners)).groupBy("i", "j").agg(F.sum("w").alias("w")).toArrow()
    grid = np.zeros((nodes, nodes))
    grid[weights.column("i").to_numpy(), weights.column("j").to_numpy()] = weights.column("w").to_numpy()
    away = np.arange(-nodes + 1, nodes)
    inv = np.linalg.inv(cov)
    dx, dy = away[:, None] * step[0], away[None] * step[1]
    kernel = np.exp(-0.5 * (inv[0, 0] * dx * dx + 2 * inv[0, 1] * dx * dy + inv[1, 1] * dy * dy))
    # what wraps around at this size lies outside the part that is kept
    size = (2 * nodes,) * 2
    whole = np.fft.irfft2(np.fft.rfft2(grid, size) * np.fft.rfft2(kernel, size), size)[nodes - 1 : 2 * nodes - 1, nodes - 1 : 2 * nodes - 1]
    density = np.maximum(whole[::fine, ::fine], 0) / (m.n * 2 * math.pi * math.sqrt(np.linalg.det(cov)))
    at = np.arange(cells)
    columns = {"i": np.repeat(at, cells), "j": np.tile(at, cells), "x": np.repeat(m.x0 + at * (m.x1 - m.x0) / (cells - 1), cells), "y": np.tile(m.y0 + at * (m.y1 - m.y0) / (cells - 1), cells), "density": density.ravel()}
    return df.sparkSession.createDataFrame(pa.table(columns))


def kde_grid(df: DataFrame, x: str, y: str, cells: int = 200) -> DataFrame:
    """Gaussian kernel density of (x, y) on a cells x cells grid over the data range.

    Full covariance with Scott's factor n^(-1/6). The first pass brings back one
    row of moments. In the second each task adds its points up on the grid, which
    is bounded by ``cells``; points are never shuffled or paired with each other.
    """
    points, m, cov = _kernel(df, x, y)
    inv = np.linalg.inv(cov)
    # whitening turns the Mahalanobis distance into a plain one
    white = np.linalg.cholesky(inv).T
    gx, gy = np.linspace(m.x0, m.x1, cells), np.linspace(m.y0, m.y1, cells)
    grid = np.stack(np.meshgrid(gx, gy, indexing="ij"), axis=-1).reshape(-1, 2)
    grid_w = grid @ white.T
    norm = m.n * 2 * math.pi * math.sqrt(np.linalg.det(cov))
    patch = min(len(grid), 40_000)  # cells that are worked together
    step = max(1, 2_000_000 // patch)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(grid_w))
        for pdf in batches:
            pts = pdf[["x", "y"]].to_numpy() @ white.T
            for i in range(0, len(pts), step):
                for c in range(0, len(grid_w), patch):
                    dx = grid_w[c:c + patch, :1] - pts[i:i + step, 0]
                    dy = grid_w[c:c + patch, 1:] - pts[i:i + step, 1]
                    total[c:c + patch] += np.exp(-0.5 * (dx * dx + dy * dy)).sum(axis=1)
        yield pd.DataFrame({"cell": np.arange(len(total)), "s": total})

    sums = points.mapInPandas(add_up, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    i, j = F.floor(F.col("cell") / cells), F.col("cell") % cells
    return sums.select(
        i.alias("i"), j.alias("j"),
        (F.lit(m.x0) + i * ((m.x1 - m.x0) / (cells - 1))).alias("x"),
        (F.lit(m.y0) + j * ((m.y1 - m.y0) / (cells - 1))).alias("y"),
        (F.col("s") / norm).alias("density"),
    )


def stft_power(
    samples: DataFrame, key: str, index: str, value: str, nperseg: int = 256, frames_per_block: int = 256
) -> DataFrame:
    """Power per (key, frame) of the short-time Fourier transform, as an array over frequencies.

    Hann window, half overlap, the signal padded by half a window of zeros on both
    sides and to a whole number of hops at the end. Blocks of frames are transformed
    together; a block sees one window beyond its end.
    """
    hop, half = nperseg // 2, nperseg // 2
    size = hop * frames_per_block
    padded = samples.select(F.col(key).alias("_key"), (F.col(index) + half).cast("long").alias("_i"), F.col(value).cast("double").alias("_x"))
    lengths = padded.groupBy("_key").agg((F.max("_i") + 1 + half).alias("_len"))
    lengths = lengths.withColumn("_frames", F.ceil((F.col("_len") - nperseg) / hop) + 1)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    scale = 1.0 / window.sum()

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        block, frames = int(pdf["block"].iloc[0]), int(pdf["_frames"].iloc[0])
        x = np.zeros(size + nperseg)
        x[pdf["_i"].to_numpy() - block * size] = pdf["_x"].to_numpy()
        first = block * frames_per_block
        count = min(frames_per_block, frames - first)
        if count <= 0:
            return pd.DataFrame(columns=["_key", "frame", "power"])
        parts = np.lib.stride_tricks.sliding_window_view(x, nperseg)[::hop][:count]
        power = np.abs(np.fft.rfft(parts * window, axis=1) * scale) ** 2
        return pd.DataFrame({"_key": pdf["_key"].iloc[0], "frame": np.arange(first, first + count), "power": list(power)})

    cut = attach(halo_blocks(padded, "_i", size, 0, nperseg).where("block >= 0"), lengths, ["_key"])
    kind = samples.schema[key].dataType.simpleString()
    return cut.groupBy("_key", "block").applyInPandas(
        transform, f"_key {kind}, frame long, power array<double>"
    ).withColumnRenamed("_key", key)


def group_frames(frames: DataFrame, key: str, width: int = 3) -> DataFrame:
    """Join each run of ``width`` neighbouring frames into one example; an incomplete last run goes."""
    run = F.floor(F.col("frame") / width)
    return frames.groupBy(key, run.alias("example")).agg(
        F.array_sort(F.collect_list(F.struct("frame", "power"))).alias("_f")
    ).where(F.size("_f") == width).select(key, "example", F.transform("_f", lambda f: f["power"]).alias("power"))


def _mexican_hat(scale: int, reach: float = 8.0) -> np.ndarray:
    """The Mexican hat at a scale, integrated over each sample's unit interval."""
    half = int(reach * scale)
    edges = (np.arange(-half, half + 2) - 0.5) / scale
    integral = edges * np.exp(-edges * edges / 2) * (2 / (math.sqrt(3) * math.pi ** 0.25))
    return np.diff(integral) * math.sqrt(scale)


def cwt_ricker(
    samples: DataFrame, key: str, index: str, value: str, scales: Sequence[int] = tuple(range(1, 10)), block: int = 65_536
) -> DataFrame:
    """Mexican-hat wavelet coefficients per sample: an array over ``scales``.

    The wavelet is integrated per sample interval, then the signal is convolved
    with it; samples beyond the ends count as zero. Blocks see the kernel's reach
    on both sides.
    """
    kernels = [_mexican_hat(s) for s in scales]
    pad = max(len(k) // 2 for k in kernels)
    block = max(block, pad + 1)

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        start = int(pdf["block"].iloc[0]) * block
        x = np.zeros(block + 2 * pad)
        at = pdf["_i"].to_numpy() - start + pad
        x[at] = pdf["_x"].to_numpy()
        rows = []
        for k in kernels:
            h = len(k) // 2
            rows.append(np.convolve(x[pad - h:pad + block + h], k[::-1], mode="valid"))
        own = np.sort(at[(at >= pad) & (at < pad + block)]) - pad
        if len(own) == 0:
            return pd.DataFrame(columns=["_key", "_i", "coef"])
        coefs = np.stack(rows, axis=1)[own]
        return pd.DataFrame({"_key": pdf["_key"].iloc[0], "_i": own + start, "coef": list(coefs)})

    rows = samples.select(F.col(key).alias("_key"), F.col(index).cast("long").alias("_i"), F.col(value).cast("double").alias("_x"))
    kind = samples.schema[key].dataType.simpleString()
    cut = halo_blocks(rows, "_i", block, pad, pad).where("block >= 0")
    return cut.groupBy("_key", "block").applyInPandas(
        transform, f"_key {kind}, _i long, coef array<double>"
    ).withColumnsRenamed({"_key": key, "_i": index})


def _uniform(key: Column, salt: str) -> Column:
    """Number above 0 and up to 1 from 52 bits of the MD5 of a key's text."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(salt), key.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 1) / float(1 << 52)


def add_noise(df: DataFrame, value: str, rate: float, seed: int, *keys: str) -> DataFrame:
    """Add Gaussian noise of power 0.5 * rate / 2 that depends on the row's keys and the seed alone."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    first, second = _uniform(key, f"{seed}a"), _uniform(key, f"{seed}b")
    normal = F.sqrt(-2 * F.ln(first)) * F.cos(2 * math.pi * second)
    return df.withColumn(value, F.col(value) + normal * math.sqrt(0.5 * rate / 2))


def cut_frames(samples: DataFrame, key: str, index: str, value: str, width: int) -> DataFrame:
    """Cut every signal into frames of ``width`` samples; an incomplete last frame goes."""
    return samples.groupBy(key, F.floor(F.col(index) / width).alias("frame")).agg(
        F.array_sort(F.collect_list(F.struct(index, value))).alias("_s")
    ).where(F.size("_s") == width).select(key, "frame", F.transform("_s", lambda s: s[value]).alias("samples"))
