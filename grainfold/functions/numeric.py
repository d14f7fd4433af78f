"""Numeric expressions that cannot raise under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def margin(revenue: Column, cost: Column) -> Column:
    """Share of revenue left after cost; 0 without revenue."""
    return guarded_ratio(revenue - cost, revenue)


def bin_by(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts at or below the value: below the first cut is 0."""
    out = F.when(value < cuts[0], 0)
    for n, cut in enumerate(cuts[1:], start=1):
        out = out.when(value < cut, n)
    return out.when(value.isNotNull(), len(cuts))


def safe_double(text: Column, fallback: Column) -> Column:
    """Text as a number, or ``fallback`` where it is none."""
    return F.coalesce(F.trim(text).try_cast("double"), fallback)


def remap(value: Column, mapping: Mapping[str, str]) -> Column:
    """Look the value up in a literal map; NULL if it is not there."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def md5_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket of a key that any engine with md5 can reproduce."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("long") % buckets
