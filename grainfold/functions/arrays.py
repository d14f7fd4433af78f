"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def left_pad(items: Column, length: int, fill: int = 0) -> Column:
    """The last ``length`` items, with ``fill`` put in front of shorter arrays."""
    kept = F.when(F.size(items) > length, F.slice(items, -length, length)).otherwise(items)
    short = F.greatest(F.lit(length) - F.size(items), F.lit(0))
    return F.concat(F.array_repeat(F.lit(fill).cast("int"), short), kept.cast("array<int>"))


def l2_norm(items: Column) -> Column:
    squares = F.transform(items, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def l2_normalize(items: Column) -> Column:
    """The array scaled to length 1; a zero array stays as it is."""
    norm = l2_norm(items)
    return F.transform(items, lambda x: F.when(norm == 0, x.cast("double")).otherwise(x / norm))
