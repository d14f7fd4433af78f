"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for all nodes of ``edges`` (``a``, ``b``).

    Each round takes the smallest label among the neighbours and then the label of that label,
    and is written as a table; rounds end when nothing changes. Null ends are ignored.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = stored(edges.union(edges.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        hooked = stored(labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        parent = hooked.select(F.col("node").alias("p"), F.col("label").alias("up"))
        jumped = stored(hooked.join(parent, F.col("label") == F.col("p")).select("node", F.least("label", "up").alias("label"), (F.least("label", "up") < F.col("old")).alias("moved")))
        if jumped.where("moved").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
