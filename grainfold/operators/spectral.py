"""Leading eigenvectors of a neighbour graph of any size, by power iteration over parts of neighbouring nodes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.session import discard, stored


#: Nodes of a part, about; parts are worked one at a time in a task.
PART = 1 << 13


def with_loops(edges: DataFrame, symmetric: bool) -> DataFrame:
    """(src, dst, w), stored: half the normalised weights of a graph, plus a half on every node itself.

    Weights are divided by the roots of both degrees if ``symmetric``, else by the source's degree. All
    eigenvalues then lie between 0 and 1, so that powers of the matrix single out the largest.
    """
    degree = stored(edges.groupBy("src").agg(F.sum("weight").alias("_d")))
    rows = edges.join(degree.hint("merge"), "src")
    if symmetric:
        rows = rows.join(degree.select(F.col("src").alias("dst"), F.col("_d").alias("_e")).hint("merge"), "dst")
        share = F.col("weight") / F.sqrt(F.col("_d") * F.col("_e"))
    else:
        share = F.col("weight") / F.col("_d")
    loops = degree.select("src", F.col("src").alias("dst"), F.lit(0.5).alias("w"))
    return stored(rows.select("src", "dst", (share / 2).alias("w")).unionByName(loops))


class Matrix(NamedTuple):
    """A matrix in parts: ``cells`` (part and home: of the target and the source; src, dst, w) and ``places`` (node, part), both stored."""

    cells: DataFrame
    places: DataFrame
    nodes: int
    parts: int


def parted(matrix: DataFrame, rounds: int = 3) -> Matrix:
    """The matrix, dealt out so that nodes of one neighbourhood mostly lie in one part.

    Nodes take the smallest hash among all nodes a few edges away, which those near to each other mostly have in common; hashes of
    these are the parts. Only a few bytes a cell move for it, but the products of a part's cells then add up inside the part.
    """
    near = matrix.groupBy(F.col("src").alias("node")).agg(F.min(F.xxhash64("dst")).alias("label"))
    for _ in range(rounds - 1):
        here = stored(near)
        near = matrix.join(here.withColumnRenamed("node", "dst").hint("merge"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("label"))
    named = stored(near)
    nodes = named.count()
    parts = nodes // PART + 1
    places = stored(named.select("node", F.pmod(F.xxhash64("label"), F.lit(parts)).cast("int").alias("part")))
    cells = matrix.join(places.withColumnRenamed("node", "dst").hint("merge"), "dst")
    cells = cells.join(places.select(F.col("node").alias("src"), F.col("part").alias("home")).hint("merge"), "src")
    return Matrix(stored(cells.select("part", "home", "src", "dst", "w")), places, nodes, parts)


def start_vectors(matrix: Matrix, width: int, seed: int) -> DataFrame:
    """(part, node, v): numbers between -1 and 1 from hashes of the nodes."""
    return matrix.places.select("part", "node", F.array(*[F.xxhash64("node", F.lit(seed), F.lit(i)) / float(1 << 63) for i in range(width)]).alias("v"))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x, float).ravel()))


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a part in order, and the sums of their vectors."""
    rows = rows.sort_by("node")
    node = rows["node"].to_numpy()
    x = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    return node[starts], np.add.reduceat(x, starts)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("part")).groupBy("part")


def _schema(matrix: Matrix) -> str:
    return f"part int, node {matrix.places.schema['node'].dataType.simpleString()}, v array<double>"


def multiply(matrix: Matrix, vectors: DataFrame, by: np.ndarray | None = None) -> DataFrame:
    """The matrix times the vectors, these times the small matrix ``by``.

    Vectors come and go as terms: rows of a node add up to its vector. A part adds up its nodes' terms, multiplies, and sends
    one term for each source, so these are the only wide rows that move.
    """

    def run(cells: pa.Table, rows: pa.Table) -> pa.Table:
        nodes, x = _summed(rows)
        x = x if by is None else x @ by
        cells = cells.sort_by([("home", "ascending"), ("src", "ascending")])
        src, w = cells["src"].to_numpy(), cells["w"].to_numpy()
        place = np.searchsorted(nodes, cells["dst"].to_numpy())
        starts = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
        ends, out = np.append(starts[1:], len(src)), np.empty((len(starts), x.shape[1]))
        for lo in range(0, len(starts), 4096):
            hi = min(lo + 4096, len(starts))
            cut = slice(starts[lo], ends[hi - 1])
            out[lo:hi] = np.add.reduceat(x[place[cut]] * w[cut, None], starts[lo:hi] - starts[lo])
        first = cells.select(["home", "src"]).take(pa.array(starts))
        return pa.table([first["home"], first["src"], _lists(out)], ["part", "node", "v"])

    return _dealt(matrix.cells, matrix.parts).cogroup(_dealt(vectors, matrix.parts)).applyInArrow(run, _schema(matrix))


def whole(matrix: Matrix, vectors: DataFrame) -> DataFrame:
    """Vectors with one row a node, stored."""

    def run(rows: pa.Table) -> pa.Table:
        nodes, x = _summed(rows)
        return pa.table([pa.array(np.full(len(nodes), rows["part"][0].as_py(), np.int32)), pa.array(nodes), _lists(x)], ["part", "node", "v"])

    return stored(_dealt(vectors, matrix.parts).applyInArrow(run, _schema(matrix)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Inner products of the vectors; width x width sums come to the driver, whatever the number of rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["i", "v"])

    out = np.zeros(width * width)
    for r in vectors.select("v").mapInArrow(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out.reshape(width, width)


def _upright(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrix that turns the vectors into orthonormal ones, those of the largest eigenvalues first, and their inner products."""
    values, turned = np.linalg.eigh(gram(vectors, width))
    lead = np.argsort(values)[::-1]
    lead = lead[values[lead] > values.max() * 1e-14]
    return turned[:, lead] / np.sqrt(values[lead]), values[lead]


def leading_vectors(edges: DataFrame, k: int, extra: int = 8, rounds: int = 6, steps: int = 4, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """((node, embedding), values): the ``k`` leading eigenvectors of the normalised graph, and their eigenvalues.

    Block power iteration over all edges: ``steps`` multiplications between two
    orthonormalisations from the vectors' inner products; these are the Ritz vectors, in falling order of their eigenvalues. ``extra`` vectors
    more than asked for speed it up. Only small square matrices are on the driver.
    """
    matrix = parted(with_loops(edges, symmetric=True))
    width = max(1, min(k + extra, matrix.nodes))
    here, held, turn, values = start_vectors(matrix, width, seed), None, None, None
    for _ in range(rounds):
        terms = here
        for step in range(steps):
            terms = multiply(matrix, terms, turn if step == 0 else None)
        here = whole(matrix, terms)
        if held is not None:
            discard(held)
        held = here
        turn, values = _upright(here, width if turn is None else turn.shape[1])
    k = min(k, turn.shape[1])
    by = turn[:, :k]

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(1), _lists(_matrix(batch.select([0])) @ by)], ["node", "embedding"])

    kind = matrix.places.schema["node"].dataType.simpleString()
    return here.select("v", "node").mapInArrow(turned, f"node {kind}, embedding array<double>"), 2 * values[:k] ** (0.5 / steps) - 1


def power_values(edges: DataFrame, rounds: int = 20, starts: int = 8, seed: int = 1, steps: int = 5) -> DataFrame:
    """(node, values): vectors of truncated power iteration on the graph's random walk, on which the rows of a cluster lie close together.

    A single vector may by chance give two clusters the same value, so there are several random ``starts``; each is scaled
    to a deviation of 1. Vectors are stored after every few ``steps``; nothing is sent through the driver but their deviations.
    """
    matrix = parted(with_loops(edges, symmetric=False))
    here, old = start_vectors(matrix, starts, seed), None
    for done in range(0, rounds, steps):
        terms = here
        for _ in range(min(steps, rounds - done)):
            terms = multiply(matrix, terms)
        here = whole(matrix, terms)
        if old is not None:
            discard(old)
        old = here
    names = [f"v{i}" for i in range(starts)]
    here = here.select("node", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)])
    spread = here.agg(*[F.stddev(c).alias(c) for c in names]).first()
    return here.select("node", F.array(*[F.col(c) / (spread[c] or 1.0) for c in names]).alias("values"))
