"""Where the named queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that must give the same rows."""

    def add(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} registered twice")
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def r(column: Column | str, digits: int = 4) -> Column:
    """Rounded value, so that sums added in another order compare equal."""
    return F.round(column, digits)


def r_half(column: Column | str, digits: int = 4) -> Column:
    """Rounded value for columns that often end in an exact half.

    Engines disagree on such halves; a nudge far below the last digit, also in the
    SQL twin, settles them.
    """
    return F.round(F.col(column) + 1e-7 if isinstance(column, str) else column + 1e-7, digits)
