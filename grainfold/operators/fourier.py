"""Discrete Fourier transforms of series of any length, in groups of bounded size."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Samples that one group transforms.
LONGEST = 1 << 16


def _divisor(longest: int):
    """Column function: the largest divisor of a length that a group may hold."""

    @F.pandas_udf("long")
    def find(lengths):
        known = {}
        for n in lengths.unique():
            d = np.arange(1, min(int(n), longest) + 1)
            known[n] = int(d[n % d == 0][-1])
        return lengths.map(known).astype("int64")

    return find


def _rows_of(keys: Sequence[str], schema, extra: str) -> str:
    return ", ".join([f"`{k}` {schema[k].dataType.simpleString()}" for k in keys] + [extra])


def transform(rows: DataFrame, keys: Sequence[str], inverse: bool = False, longest: int | None = None, cut: bool = True) -> DataFrame:
    """(keys, _n, k, re, im): the transform of every series, all bins from 0 to its length less 1.

    ``rows`` is (keys, _n, _j, re, im): complex samples on places 0 to ``_n`` less 1; places without a sample are 0, several on one add up.
    A length ``n`` is cut into ``n1 * n2``, ``n1`` the largest divisor of at most ``longest``: columns of ``n1`` samples are transformed,
    turned by their twiddle factors, dealt out anew by bin and transformed along rows of ``n2`` (four-step transform). No group
    holds more than the larger of ``n1`` and ``n2`` samples; each sample is shuffled once, and once more if ``n2`` isn't 1. ``inverse`` turns the
    other way and divides by ``n``. Lengths of which ``n2`` would be above ``longest`` are for :func:`spectrum`. With
    ``cut=False`` the caller knows that all lengths fit a group.
    """
    keys, sign, longest = list(keys), 1 if inverse else -1, longest or LONGEST
    rows = rows.withColumn("_n1", _divisor(longest)("_n")).withColumn("_n2", (F.col("_n") / F.col("_n1")).cast("long"))

    def spin(x: np.ndarray) -> np.ndarray:
        return np.fft.ifft(x) if inverse else np.fft.fft(x)

    def out(key: tuple, **columns: np.ndarray) -> pa.Table:
        n = len(columns["re"])
        held = {k: pa.array([key[i].as_py()] * n, key[i].type) for i, k in enumerate(keys)}
        return pa.table({**held, **{c: pa.array(v) for c, v in columns.items()}})

    def columns(key: tuple, table: pa.Table) -> pa.Table:
        n, n1 = table.column("_n")[0].as_py(), table.column("_n1")[0].as_py()
        n2 = n // n1
        j = table.column("_j").to_numpy()
        x = np.zeros(n1, complex)
        np.add.at(x, j // n2, table.column("re").to_numpy() + 1j * table.column("im").to_numpy())
        j2, k1 = int(j[0] % n2), np.arange(n1)
        y = spin(x) * np.exp(sign * 2j * np.pi * (j2 * k1 % n) / n)
        same = np.full(n1, n)
        return out(key, _n=same, _n1=np.full(n1, n1), j2=np.full(n1, j2), k1=k1, re=y.real.copy(), im=y.imag.copy())

    def along(key: tuple, table: pa.Table) -> pa.Table:
        n, n1, k1 = (table.column(c)[0].as_py() for c in ("_n", "_n1", "k1"))
        x = np.zeros(n // n1, complex)
        x[table.column("j2").to_numpy()] = table.column("re").to_numpy() + 1j * table.column("im").to_numpy()
        y = spin(x)
        return out(key, _n=np.full(len(y), n), k=k1 + n1 * np.arange(len(y)), re=y.real.copy(), im=y.imag.copy())

    column = F.pmod(F.col("_j"), F.col("_n2")).alias("_c")
    first = rows.groupBy(*keys, column).applyInArrow(columns, _rows_of(keys, rows.schema, "_n long, _n1 long, j2 long, k1 long, re double, im double"))
    if not cut:
        return first.select(*keys, "_n", F.col("k1").alias("k"), "re", "im")
    return first.groupBy(*keys, "k1").applyInArrow(along, _rows_of(keys, rows.schema, "_n long, k long, re double, im double"))


def _chirp(j: Column, n: Column, sign: int) -> tuple[Column, Column]:
    """exp(sign * i * pi * j * j / n) as two columns; j * j is reduced before it is divided."""
    angle = sign * math.pi * F.pmod(j * j, 2 * n) / n
    return F.cos(angle), F.sin(angle)


def _places(series: DataFrame, upto: Column, name: str) -> DataFrame:
    """A row for each place from 0 on; arrays that are unfolded hold some thousands of places."""
    step = 4096
    blocks = series.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((upto - 1) / step))))
    at = F.sequence(F.col("_b") * step, F.least((F.col("_b") + 1) * step, upto) - 1)
    return blocks.withColumn(name, F.explode(at)).drop("_b")


def spectrum(rows: DataFrame, lengths: DataFrame, keys: Sequence[str], longest: int | None = None) -> DataFrame:
    """(keys, _n, k, re, im) as :func:`transform` gives them, for series of any length below 2 ** 31.

    ``lengths`` is (keys, _n), a row per series. Lengths without a fitting divisor, such as large primes, become a convolution with a
    chirp whose transforms have a power of two as length (Bluestein).
    """
    keys, longest = list(keys), longest or LONGEST
    rest = F.col("_n") / _divisor(longest)("_n")
    top = lengths.agg(F.max(rest).alias("n2")).first()["n2"] or 1
    if top <= longest:
        return transform(rows, keys, longest=longest, cut=top > 1)
    plain = transform(rows.where(rest <= longest), keys, longest=longest)
    rows = rows.where(rest > longest)
    series = lengths.where(rest > longest).select(*keys, "_n", F.pow(F.lit(2.0), F.ceil(F.log2(2 * F.col("_n") - 1))).cast("long").alias("_m"))
    j, n = F.col("_j"), F.col("_n")
    cos, sin = _chirp(j, n, -1)
    turned = rows.join(series.select(*keys, "_m"), keys) if keys else rows.withColumn("_m", F.lit(series.first()["_m"]))
    turned = turned.select(*keys, F.col("_m").alias("_n"), "_j", (F.col("re") * cos - F.col("im") * sin).alias("re"), (F.col("re") * sin + F.col("im") * cos).alias("im"))
    grid = _places(series, n, "_j")
    cos, sin = _chirp(j, n, 1)
    both = F.explode(F.array_distinct(F.array(j, F.pmod(-j, F.col("_m")))))
    kernel = grid.select(*keys, F.col("_m").alias("_n"), cos.alias("re"), sin.alias("im"), both.alias("_j"))
    a = transform(turned, keys, longest=longest)
    b = transform(kernel, keys, longest=longest).withColumnsRenamed({"re": "_re", "im": "_im"}).drop("_n")
    product = a.join(b, [*keys, "k"]).select(
        *keys, "_n", F.col("k").alias("_j"), (F.col("re") * F.col("_re") - F.col("im") * F.col("_im")).alias("re"), (F.col("re") * F.col("_im") + F.col("im") * F.col("_re")).alias("im")
    )
    back = transform(product, keys, inverse=True, longest=longest).drop("_n")
    back = back.join(series, keys) if keys else back.withColumns({"_n": F.lit(series.first()["_n"]), "_m": F.lit(0)})
    k = F.col("k")
    cos, sin = _chirp(k, n, -1)
    found = back.where(k < n).select(*keys, "_n", "k", (F.col("re") * cos - F.col("im") * sin).alias("re"), (F.col("re") * sin + F.col("im") * cos).alias("im"))
    return plain.unionByName(found)
