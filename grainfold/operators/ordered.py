"""Order-dependent columns over groups of any size.

A plain window sorts a whole group in one task, however large it is. Here rows are
range partitioned on (group, order), so that a large group, or a table without
groups, spreads over many partitions; every value is then computed inside a
(group, partition) piece and corrected by what the earlier pieces of the same
group carry over. There is one carry row per piece, so the second window handles
at most one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.session import settle

_PIECE = "_piece"


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and totally ordered by ``order``.

    ``order`` must be unique inside a group, otherwise results depend on how ties
    fall, as they would in any engine. Methods add one column and can be chained;
    ``frame()`` gives the result.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.keys, self.order = list(keys), list(order)
        # ranges are sampled, so they are fixed by a checkpoint; AQE merges small ones
        ranged = df.repartitionByRange(*self.keys, *self.order)
        self._df = settle(ranged.withColumn(_PIECE, F.spark_partition_id()))

    def frame(self) -> DataFrame:
        return self._df.drop(_PIECE)

    def _window(self, descending: bool = False):
        part = [*self.keys, _PIECE]
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*part).orderBy(*order)

    def _carry(self, summary: Column, combine, name: str, after: bool = False) -> DataFrame:
        """Per piece, ``combine`` of ``summary`` over the pieces before (or after) it."""
        pieces = self._df.groupBy(*self.keys, _PIECE).agg(summary.alias("_own"))
        order = F.col(_PIECE).desc() if after else F.col(_PIECE).asc()
        window = Window.partitionBy(*self.keys).orderBy(order)
        return pieces.select(*self.keys, _PIECE, combine(F.col("_own"), window).alias(name))

    def _join(self, carry: DataFrame) -> None:
        # group keys may be NULL, and so must match null-safely
        left, right = self._df.alias("l"), carry.alias("r")
        on = F.col(f"l.{_PIECE}") == F.col(f"r.{_PIECE}")
        for k in self.keys:
            on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        extra = [c for c in carry.columns if c not in self.keys and c != _PIECE]
        self._df = left.join(right, on, "left").select("l.*", *[f"r.{c}" for c in extra])

    def _last(self, col: Column) -> Column:
        return F.max_by(F.struct(col.alias("v")), F.struct(*self.order))

    def previous(self, name: str, col: Column) -> "OrderedGroups":
        """Value of ``col`` on the row before; NULL on a group's first row."""
        self._join(self._carry(self._last(col), lambda own, w: F.lag(own).over(w), "_before"))
        window = self._window()
        self._df = self._df.withColumn(
            name,
            F.when(F.row_number().over(window) == 1, F.col("_before.v")).otherwise(F.lag(col).over(window)),
        ).drop("_before")
        return self

    def running_sum(self, name: str, col: Column) -> "OrderedGroups":
        """Sum of ``col`` from the group's first row up to this one."""
        local = F.sum(col).over(self._window().rowsBetween(Window.unboundedPreceding, 0))
        total = lambda own, w: F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, -1))
        self._join(self._carry(F.sum(col), total, "_before"))
        both_null = F.col(name).isNull() & F.col("_before").isNull()
        self._df = self._df.withColumn(name, local).withColumn(
            name,
            F.when(~both_null, F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col("_before"), F.lit(0))),
        ).drop("_before")
        return self

    def position(self, name: str) -> "OrderedGroups":
        """1-based position of the row in its group."""
        return self.running_sum(name, F.lit(1).cast("long"))

    def max_before(self, name: str, col: Column) -> "OrderedGroups":
        """Largest ``col`` over the rows strictly before this one."""
        before = (Window.unboundedPreceding, -1)
        local = F.max(col).over(self._window().rowsBetween(*before))
        self._join(self._carry(F.max(col), lambda own, w: F.max(own).over(w.rowsBetween(*before)), "_before"))
        self._df = self._df.withColumn(name, local).withColumn(
            name, F.greatest(F.col(name), F.col("_before"))
        ).drop("_before")
        return self

    def nearest_known(self, name: str, col: Column, after: bool = False) -> "OrderedGroups":
        """Last non-null ``col`` up to this row, or the first from it on if ``after``."""
        upto = (Window.unboundedPreceding, 0)
        local = F.last(col, ignorenulls=True).over(self._window(after).rowsBetween(*upto))
        pick = F.min_by if after else F.max_by
        # rows without a value get a NULL order, which min_by / max_by skip
        known = pick(col, F.when(col.isNotNull(), F.struct(*self.order)))
        fill = lambda own, w: F.last(own, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        self._join(self._carry(known, fill, "_near", after))
        self._df = self._df.withColumn(name, local).withColumn(
            name, F.coalesce(F.col(name), F.col("_near"))
        ).drop("_near")
        return self
