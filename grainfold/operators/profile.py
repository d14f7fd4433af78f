"""Profiles: counts, summaries, quantiles, correlations, histograms, norms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold.session import discard, stored


def completeness(df: DataFrame) -> DataFrame:
    """Known values per column as (column, known), one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column", "known")


def distinct_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct known values per column as (column, n_distinct)."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    counts = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n_distinct")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequency of every value, most frequent first, ties by value."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return out.limit(top) if top else out


@F.arrow_udf(T.LongType())
def _order_bits(values: pa.Array) -> pa.Array:
    """64 bits of each double, as a long that orders as the doubles do; -0.0 is 0.0, NaN the largest."""
    x = values.to_numpy(zero_copy_only=False) + 0.0
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return pa.array(bits ^ ((bits >> 63) & np.int64((1 << 63) - 1)))


@F.arrow_udf(T.DoubleType())
def _value_of_bits(bits: pa.Array) -> pa.Array:
    b = bits.to_numpy(zero_copy_only=False)
    return pa.array((b ^ ((b >> 63) & np.int64((1 << 63) - 1))).view(np.float64))


#: Bits that the first and the later histograms tell apart, 64 together.
_DIGITS = (16, 24, 24)


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
) -> DataFrame:
    """Exact quantiles per group with linear interpolation: one row per group, columns q25, q50, ...

    Radix histograms: rows are counted by the leading 16 bits of their values, and the bucket that holds a rank is
    looked at again by the next 24, and once more by the last. Counts are summed in the tasks first; a
    group has no more than 2 ** 24 buckets for each rank, however many rows, and far fewer in the first pass, which is the only
    one over all rows beside that which keeps those of the buckets looked for.
    """
    keys, ranks = list(keys), len(probs) * 2
    # without keys, all rows are one group under a constant
    names = [f"_k{i}" for i in range(max(1, len(keys)))]
    groups = [F.col(k) for k in keys] or [F.lit(0)]
    rows = df.where(F.col(value).isNotNull()).select(*[k.alias(n) for k, n in zip(groups, names)], _order_bits(F.col(value).cast("double")).alias("_b"))

    def digits(shift: int) -> Column:
        """The leading bits of a value down to a place."""
        return F.shiftright("_b", shift)

    def same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
        return left.alias("l").join(right.alias("r"), [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns], how)

    def narrowed(counts: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
        """(names, _t, _r, _at): the bucket of each rank, and the rank inside it. ``counts`` is (by, _d, n), ``wanted`` (by, _t, _r)."""
        upto = F.sum("n").over(Window.partitionBy(*by).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
        hit = same(counts.withColumn("_upto", upto), wanted, by, "inner").where((F.col("_r") >= F.col("_upto") - F.col("n")) & (F.col("_r") < F.col("_upto")))
        return stored(hit.select(*[F.col(f"l.{n}") for n in names], "_t", (F.col("_r") - F.col("_upto") + F.col("n")).alias("_r"), F.col("_d").alias("_at")))

    shift = 64 - _DIGITS[0]
    first = stored(rows.groupBy(*names, digits(shift).alias("_d")).agg(F.count(F.lit(1)).alias("n")))
    totals = first.groupBy(*names).agg(F.sum("n").alias("_n")).where(F.col("_n").isNotNull())
    place = F.array(*[(F.col("_n") - 1) * F.lit(float(p)) for p in probs])
    wanted = totals.select(*names, F.posexplode(F.flatten(F.transform(place, lambda r: F.array(F.floor(r), F.ceil(r))))).alias("_t", "_r"))
    found = narrowed(first, wanted, names)
    needed = found.select(*names, "_at").distinct()
    kept = stored(same(rows.withColumn("_at", digits(shift)), needed, [*names, "_at"], "left_semi").drop("_at"))
    for bits in _DIGITS[1:]:
        inside = same(kept.withColumn("_at", digits(shift)), found.select(*names, "_at").distinct(), [*names, "_at"], "left_semi")
        shift -= bits
        counts = inside.groupBy(*names, "_at", digits(shift).alias("_d")).agg(F.count(F.lit(1)).alias("n"))
        wider, found = found, narrowed(counts, found, [*names, "_at"])
        discard(wider)
    discard(kept)
    ends = found.groupBy(*names).pivot("_t", list(range(ranks))).agg(F.first(_value_of_bits(F.col("_at"))))
    out = same(ends, totals, names, "inner").select(*[F.col(f"l.{n}").alias(k) for n, k in zip(names, keys)], *[F.col(f"`{i}`") for i in range(ranks)], *[p.alias(f"_p{i}") for i, p in enumerate((F.col("_n") - 1) * F.lit(float(q)) for q in probs)])
    picked = []
    for i, p in enumerate(probs):
        low, high, rank = F.col(f"`{2 * i}`"), F.col(f"`{2 * i + 1}`"), F.col(f"_p{i}")
        share = F.when(low == high, 0.0).otherwise((high - low) * (rank - F.floor(rank)))
        picked.append((low + share).alias(f"q{100 * p:g}".replace(".", "_")))
    return out.select(*keys, *picked)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of numeric columns."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    base = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return base.join(quantiles(long, ["column"], "value", [0.25, 0.5, 0.75]), "column", "left")


def profile_by_factor(df: DataFrame, factors: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean of every value for every level of every factor, in one pass: (factor, level, ...).

    Grouping sets expand each row once per factor and combine on the map side.
    """
    sets = [[f] for f in factors]
    grouped = df.groupingSets(sets, *factors).agg(
        *[F.avg(v).alias(f"avg_{v}") for v in values], F.count(F.lit(1)).alias("n"),
        *[F.grouping(f).alias(f"_out_{f}") for f in factors],
    )
    factor = F.coalesce(*[F.when(F.col(f"_out_{f}") == 0, F.lit(f)) for f in factors])
    level = F.coalesce(*[F.when(F.col(f"_out_{f}") == 0, F.col(f).cast("string")) for f in factors])
    return grouped.select(
        factor.alias("factor"), level.alias("level"), *[f"avg_{v}" for v in values], "n"
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the Pearson matrix as (a, b, r).

    Rows with a NULL in a pair are skipped; r is NULL for a constant column, where
    Spark's ``corr`` raises under ANSI mode.
    """
    pairs = [(b, a) for a, b in combinations(columns, 2)]

    def r(a: str, b: str) -> Column:
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    row = df.agg(*[r(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return row.select(F.inline(cells))


def segment_profit(df: DataFrame, segment: str, revenue: str, cost: str) -> DataFrame:
    """Revenue, cost and their difference per segment."""
    return df.groupBy(segment).agg(
        F.sum(revenue).alias("revenue"), F.sum(cost).alias("cost"),
        (F.sum(revenue) - F.sum(cost)).alias("profit"),
    )


def minmax_norm(df: DataFrame, column: str, name: str) -> DataFrame:
    """Scale a column to 0..1; a constant column becomes 0."""
    low = df.select(F.min(column)).scalar()
    span = df.select(F.max(column) - F.min(column)).scalar()
    return df.withColumn(name, F.coalesce(F.try_divide(F.col(column) - low, span), F.col(column) * 0.0))


def max_norm(df: DataFrame, column: str, name: str, by: DataFrame | None = None) -> DataFrame:
    """Divide by the largest value, taken from ``by`` (the training rows) if given."""
    top = (df if by is None else by).select(F.max(column)).scalar()
    return df.withColumn(name, F.try_divide(F.col(column).cast("double"), top))


def centre(df: DataFrame, column: str, name: str) -> DataFrame:
    """Subtract the column mean."""
    return df.withColumn(name, F.col(column) - df.select(F.avg(column)).scalar())


def array_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, elements, mean and population deviation over all elements of an array column.

    Sums are taken per row first, so nothing is exploded.
    """
    total = F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    squares = F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    rows = df.select(*by, F.size(column).alias("_n"), total.alias("_s"), squares.alias("_q"))
    mean = F.sum("_s") / F.sum("_n")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_n").alias("n_values"), mean.alias("mean"),
        F.sqrt(F.greatest(F.sum("_q") / F.sum("_n") - mean * mean, F.lit(0.0))).alias("std"),
    )


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin, 1..bins, 0 and bins + 1 for values outside."""
    cell = F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.groupBy(*by, cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
