"""Nearest neighbours by collision counting over sorted single projections.

A block of vectors has one sorted array per random direction. Around a query's own projection a window
opens in every array; each round widens it (virtual rehashing), and a vector that falls into enough windows is
verified by its true distance. A query is done with a block when its k-th distance is within the windows: a vector
nearer than that then lies in each window with probability 0.68 or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grainfold.llm.common import bounded_batches
from grainfold.session import scratch, stored

#: Directions, collisions that make a candidate, growth of windows, queries that travel together.
DIRECTIONS, COLLISIONS, WIDEN, QUERY_BLOCK = 64, 38, 1.25, 4096


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows as doubles, worked out from floats without loss."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: np.ndarray):
        self.ids, self.vectors = ids, vectors
        projected = vectors @ directions
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.values = np.sort(projected, axis=0).T.copy()

    def search(self, query_id: int, query: np.ndarray, at: np.ndarray, k: int, limit: float, start: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the block's vectors that are verified, ``limit`` being a k-th distance already found."""
        n = len(self.ids)
        counts = np.zeros(n, np.int64)
        checked = self.ids == query_id
        lo = np.array([np.searchsorted(v, x) for v, x in zip(self.values, at)])
        hi = lo.copy()
        found_d, found_i = [np.zeros(0)], [np.zeros(0, np.int64)]
        width = start
        while True:
            new_lo = np.array([np.searchsorted(v, x - width) for v, x in zip(self.values, at)])
            new_hi = np.array([np.searchsorted(v, x + width, side="right") for v, x in zip(self.values, at)])
            fresh = [o[a:b] for o, a, b in zip(self.order, new_lo, lo)] + [o[a:b] for o, a, b in zip(self.order, hi, new_hi)]
            counts += np.bincount(np.concatenate(fresh), minlength=n)
            lo, hi = new_lo, new_hi
            candidates = np.flatnonzero((counts >= COLLISIONS) & ~checked)
            if len(candidates):
                checked[candidates] = True
                gap = self.vectors[candidates] - query
                found_d.append(np.sqrt((gap * gap).sum(axis=1)))
                found_i.append(self.ids[candidates])
                near = np.concatenate(found_d)
                if len(near) >= k:
                    limit = min(limit, float(np.partition(near, k - 1)[k - 1]))
            if width >= limit or checked.all() or (lo == 0).all() and (hi == n).all():
                return np.concatenate(found_d), np.concatenate(found_i)
            width = min(width * WIDEN, limit) if limit < np.inf else width * WIDEN


def nearest(rows: DataFrame, queries: Column, k: int = 10, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``k`` nearest other rows of each query row: ``query_id``, ``rank`` (from 1), key, ``score``.

    ``queries`` says which rows are queries; all rows are candidates, but for those with the query's own key.
    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the smaller key.
    Queries travel in blocks of bounded size to all vectors; each task keeps a query's best over its blocks.

    Null vectors, such with null, infinite or undefined components, zero vectors, rows without a key
    and vectors that haven't the most frequent length take no part. Of query rows with the same key the first in
    order of components counts; as candidates, repeated rows are listed each. An empty table gives an empty
    result; other columns don't matter.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    usable_rows = rows.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    sizes = usable_rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, id long, score double"
    path = scratch(spark, "neighbours")
    spark.createDataFrame([], schema).write.parquet(path)
    if sizes:
        dim = sizes[0]["d"]
        whole = usable_rows.where(F.size("v") == dim)
        asked = stored(whole.where("is_query").groupBy("id").agg(F.min("v").alias("v")))
        blocks = -(-asked.count() // QUERY_BLOCK)
        directions = np.random.Generator(np.random.PCG64(97)).normal(size=(dim, DIRECTIONS))
        for block in range(blocks):
            part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
            if part.num_rows:
                shared = spark.sparkContext.broadcast((part["id"].to_numpy(), _matrix(part["v"].combine_chunks(), dim), directions))
                whole.select("id", "v").mapInArrow(_searcher(shared, dim, k), schema).write.mode("append").parquet(path)
                shared.unpersist()
    found = spark.read.schema(schema).parquet(path)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def _searcher(shared, dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, directions = shared.value
        at = queries @ directions
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(query_ids)
        start = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Block(batch.column(0).to_numpy(), _matrix(batch.column(1), dim), directions)
            if start is None:  # a tenth of a typical spread of projections
                start = max(1e-9, 0.1 * float(np.median(block.values[:, -1] - block.values[:, 0])) / 6)
            for q, query_id in enumerate(query_ids):
                d, i = best[q]
                limit = float(d[-1]) if len(d) == k else np.inf
                new_d, new_i = block.search(query_id, queries[q], at[q], k, limit, start)
                d, i = np.concatenate([d, new_d]), np.concatenate([i, new_i])
                order = np.lexsort((i, d))[:k]
                best[q] = d[order], i[order]
        if start is not None:
            counts = [len(d) for d, _ in best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(query_ids, counts)), pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([d for d, _ in best]))], ["query_id", "id", "score"]
            )

    return run
