"""Filters, unions, null handling and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold.session import stored

# fixed values: cabin names as they occur, and the class each stands for
CABIN_CLASSES = {
    "economy": "economy", "Economy": "economy", "ECONOMY": "economy", "COACH": "economy",
    "premium_economy": "premium_economy", "Premium Economy": "premium_economy",
    "premiumEconomy": "premium_economy",
    "business": "business", "Business": "business",
    "first": "first", "First": "first", "First Class": "first",
    "mixed": "mixed",
}
# fixed values: prices that mean "no price"
PRICE_SENTINELS = ["-1.0", "0.0", "9999.99", "99999.99", "999999.99"]


def normalise_names(df: DataFrame) -> DataFrame:
    """Trim blanks around column names; columns without a name go."""
    names = [c.strip() for c in df.columns]
    return df.toDF(*[n or f"_blank{i}" for i, n in enumerate(names)]).drop(
        *[f"_blank{i}" for i, n in enumerate(names) if not n]
    )


def sentinels_to_null(df: DataFrame, value: float, nan: bool = True) -> DataFrame:
    """Replace ``value`` (and NaN) by NULL in every numeric column, in text columns its spelling."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and nan:
            c = F.when(~F.isnan(c), c)
        if isinstance(f.dataType, T.NumericType):
            c = F.nullif(c, F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit(f"{value:g}"))
        out.append(c.alias(f.name))
    return df.select(*out)


def drop_header_rows(df: DataFrame, column: str) -> DataFrame:
    """Drop rows that repeat the header, i.e. hold a column's own name; NULL rows stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(column)))


def sentinel_audit(df: DataFrame, column: str, sentinels: Sequence[str]) -> DataFrame:
    """How often each sentinel occurs: (sentinel, n), one pass, zeros included."""
    counts = df.agg(*[F.count_if(F.col(column) == s).alias(str(i)) for i, s in enumerate(sentinels)])
    rows = F.array(*[F.struct(F.lit(s).alias("sentinel"), F.col(str(i)).alias("n")) for i, s in enumerate(sentinels)])
    return counts.select(F.inline(rows))


def split_labelled(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a label and rows to predict."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def union_flagged(parts: Mapping[object, DataFrame], flag: str) -> DataFrame:
    """Union by name; ``flag`` tells which part a row came from, missing columns are NULL."""
    out = None
    for value, df in parts.items():
        df = df.withColumn(flag, F.lit(value))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def union_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of the columns both sides have, in the order of ``a``."""
    common = [c for c in a.columns if c in b.columns]
    return a.select(*common).unionByName(b.select(*common))


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``stats`` (an aggregate with one row per key) to every row.

    A join instead of a window: the aggregate is combined on the map side, so a
    group holding much of the table is never sorted in one task. It is stored
    first, so its size is known: below Spark's broadcast threshold the rows are
    not shuffled at all; above, the partitions of heavy keys are split (AQE skew
    join). Rows with a NULL key part find nothing and get NULL.
    """
    return df.join(stored(stats), list(keys), "left")


def _known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def impute_group_mean(df: DataFrame, columns: Sequence[str], keys: Sequence[str], half_even: bool = False) -> DataFrame:
    """Fill NULLs with the group mean, rounded half-even to a whole number on request."""
    means = _known_keys(df, keys).groupBy(*keys).agg(
        *[(F.bround(F.avg(c)) if half_even else F.avg(c)).alias(f"_mean_{c}") for c in columns]
    )
    out = attach(df, means, keys)
    return out.select(*[
        F.coalesce(c, f"_mean_{c}").alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def impute_group_mode(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Fill NULLs with the group's most frequent value; of equally frequent ones the smallest."""
    known = _known_keys(df, [*keys, column]).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v")))
    modes = known.groupBy(*keys).agg(best["v"].alias("_mode"))
    out = attach(df, modes, keys)
    return out.select(*[F.coalesce(c, "_mode").alias(c) if c == column else F.col(c) for c in df.columns])


def group_size(df: DataFrame, keys: Sequence[str], name: str = "group_size") -> DataFrame:
    """Number of rows of the same group on every row."""
    sizes = _known_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return attach(df, sizes, keys)
