"""k-means for many numbers of clusters in the same passes over the rows, and their silhouettes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The coordinates that ``k`` clusters are looked for in, as a function of a matrix of rows and ``k``.
View = Callable[[np.ndarray, int], np.ndarray]


def whole(x: np.ndarray, k: int) -> np.ndarray:
    return x


def leading(x: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` coordinates, scaled to length 1."""
    part = x[:, :k]
    return part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-300)


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0.0)


def label_rows(x: np.ndarray, centres: Mapping[int, np.ndarray], view: View = whole) -> dict[int, np.ndarray]:
    """For every number of clusters the nearest centre of each row."""
    return {k: _gaps(view(x, k), c).argmin(1) for k, c in centres.items()}


def _cells(df: DataFrame, add: Callable[[pa.RecordBatch, dict], None]) -> dict[tuple[int, int], np.ndarray]:
    """Vectors by (k, cluster) that ``add`` sums up per task, added over all tasks; their number doesn't depend on the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                add(batch, held)
        for (k, c), v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(v), pa.int32()), pa.array([c] * len(v), pa.int32()), pa.array(np.arange(len(v))), pa.array(v)], ["k", "c", "i", "v"])

    sums = df.mapInArrow(run, "k int, c int, i long, v double").groupBy("k", "c", "i").agg(F.sum("v").alias("v"))
    found: dict[tuple[int, int], dict[int, float]] = {}
    for r in sums.collect():
        found.setdefault((r.k, r.c), {})[r.i] = r.v
    return {key: np.array([v[i] for i in range(len(v))]) for key, v in found.items()}


def _put(held: dict, key: tuple[int, int], value: np.ndarray) -> None:
    held[key] = held[key] + value if key in held else value.astype(float)


#: Draws of candidates at most, for a number of clusters that has fewer candidates than clusters.
MORE_STEPS = 16


def _uniform(hashes: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers from 0 to 1 that depend on row hashes and a salt alone."""
    x = hashes.astype(np.uint64) ^ np.uint64(hash(salt) & (1 << 63) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def _spread(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, tries: int = 8) -> np.ndarray:
    """k-means++ and Lloyd steps on weighted candidates; the best of several tries."""

    def one() -> tuple[float, np.ndarray]:
        centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < min(k, len(points)):
            odds = weights * _gaps(points, centres).min(1)
            if odds.sum() <= 0:
                break
            centres = np.vstack([centres, points[rng.choice(len(points), p=odds / odds.sum())]])
        for _ in range(30):
            label = _gaps(points, centres).argmin(1)
            moved = np.stack([np.average(points[label == c], axis=0, weights=weights[label == c]) if weights[label == c].sum() else centres[c] for c in range(len(centres))])
            if np.allclose(moved, centres):
                break
            centres = moved
        return float((weights * _gaps(points, centres).min(1)).sum()), centres

    return min((one() for _ in range(tries)), key=lambda found: found[0])[1]


def first_centres(points: DataFrame, ks: Sequence[int], view: View, seed: int, steps: int = 2) -> dict[int, np.ndarray]:
    """Starting centres for every k: candidates drawn over all rows in proportion to their squared distance, about ``2 k`` in each of
    ``steps``, weighted by the rows nearest to them, and thinned out to ``k`` on the driver, by the best of a few tries (k-means||).

    Copies of a row are drawn together, so few distinct rows may give too few candidates: those ``ks`` draw again, while rows lie off their candidates.
    """
    start = points.orderBy("h").select("x").first()
    if start is None:
        raise ValueError("no rows to cluster")
    row = np.array(start.x, float)[None]
    chosen = {k: view(row, k) for k in ks}
    known, begin = dict(chosen), {}
    for step in range(max(steps, MORE_STEPS)):
        if step >= steps:
            known = {k: c for k, c in chosen.items() if k in known and len(np.unique(c, axis=0)) < k}
        else:
            known = dict(chosen)
        if not known:
            break

        def cost(batch: pa.RecordBatch, held: dict) -> None:
            x = _vectors(batch, "x")
            for k, c in known.items():
                _put(held, (k, 0), np.array([_gaps(view(x, k), c).min(1).sum()]))

        total = {k: float(v[0]) for (k, _), v in _cells(points, cost).items()}
        begin = begin or total
        if step >= steps:
            known = {k: c for k, c in known.items() if total[k] > 1e-9 * begin[k]}
            if not known:
                break

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, h = _vectors(batch, "x"), batch.column("h").to_numpy()
                for k, c in known.items():
                    seen = view(x, k)
                    odds = 2 * k * _gaps(seen, c).min(1) / max(total[k], 1e-300)
                    hit = np.flatnonzero(_uniform(h, seed, step, k) < odds)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(hit), pa.int32()), pa.array(list(seen[hit]), pa.list_(pa.float64()))], ["k", "x"])

        for r in points.mapInArrow(draw, "k int, x array<double>").orderBy("k", "x").collect():
            chosen[r.k] = np.vstack([chosen[r.k], np.array(r.x)[None]])
    chosen = {k: np.unique(c, axis=0) for k, c in chosen.items()}

    def weigh(batch: pa.RecordBatch, held: dict) -> None:
        x = _vectors(batch, "x")
        for k, label in label_rows(x, chosen, view).items():
            _put(held, (k, 0), np.bincount(label, minlength=len(chosen[k])).astype(float))

    weights = {k: v for (k, _), v in _cells(points, weigh).items()}
    return {k: _spread(chosen[k], weights[k], k, np.random.default_rng(seed)) for k in ks}


def fit_many(points: DataFrame, ks: Sequence[int], view: View = whole, seed: int = 10, rounds: int = 20, tol: float = 1e-4) -> dict[int, np.ndarray]:
    """Centres for every number of clusters in ``ks``. ``points`` is a stored table of ``h`` (a long hash of the row) and ``x``.

    Each pass assigns every row for all ``k`` that still move and adds up the rows of each centre in the task, so
    one pass serves all of them; at most ``rounds`` passes follow the five that find the starting centres.
    """
    centres = first_centres(points, ks, view, seed)
    moving = set(ks)
    for _ in range(rounds):
        here = {k: centres[k] for k in sorted(moving)}

        def add(batch: pa.RecordBatch, held: dict) -> None:
            x = _vectors(batch, "x")
            for k, label in label_rows(x, here, view).items():
                seen = view(x, k)
                ones = np.zeros((len(here[k]), len(x)))
                ones[label, np.arange(len(x))] = 1
                for c, v in enumerate(np.column_stack([ones.sum(1), ones @ seen])):
                    if v[0]:
                        _put(held, (k, c), v)

        new = {k: c.copy() for k, c in here.items()}
        for (k, c), v in _cells(points, add).items():
            new[k][c] = v[1:] / v[0]
        for k, c in new.items():
            if ((c - centres[k]) ** 2).sum(1).max() <= tol * tol:
                moving.discard(k)
            centres[k] = c
        if not moving:
            break
    return centres


def judge_many(points: DataFrame, centres: Mapping[int, np.ndarray], view: View = whole, on: str = "x") -> DataFrame:
    """(k, inertia, silhouette) for every number of clusters in two passes: inertia in the view, silhouettes on the column ``on``.

    A row's mean squared distance to a cluster follows from that cluster's count, sum and sum of squares, so no
    pairs are formed. A row alone in its cluster has a silhouette of 0.
    """

    def add(batch: pa.RecordBatch, held: dict) -> None:
        x, y = _vectors(batch, "x"), _vectors(batch, on)
        for k, label in label_rows(x, centres, view).items():
            own = ((view(x, k) - centres[k][label]) ** 2).sum(1)
            square = (y * y).sum(1)
            ones = np.zeros((len(centres[k]), len(x)))
            ones[label, np.arange(len(x))] = 1
            for c, v in enumerate(np.column_stack([ones.sum(1), ones @ own, ones @ square, ones @ y])):
                if v[0]:
                    _put(held, (k, c), v)

    sums = _cells(points, add)
    stats = {}
    for k in centres:
        kept = {c: v for (j, c), v in sums.items() if j == k}
        at = sorted(kept)
        stats[k] = np.array(at), np.array([kept[c] for c in at])

    def score(batch: pa.RecordBatch, held: dict) -> None:
        x, y = _vectors(batch, "x"), _vectors(batch, on)
        square = (y * y).sum(1)
        for k, label in label_rows(x, centres, view).items():
            at, v = stats[k]
            n, squares, total = v[:, 0], v[:, 2], v[:, 3:]
            mean = np.maximum(square[:, None] + (squares / n)[None] - 2 * y @ (total / n[:, None]).T, 0.0)
            own = np.searchsorted(at, label)
            row = np.arange(len(x))
            inside = mean[row, own] * n[own] / np.maximum(n[own] - 1, 1)
            mean[row, own] = np.inf
            outside = mean.min(1)
            best = np.maximum(inside, outside)
            value = np.where((n[own] > 1) & np.isfinite(outside) & (best > 0), (outside - inside) / np.where(best > 0, best, 1), 0.0)
            _put(held, (k, 0), np.array([value.sum(), len(x)]))

    found = _cells(points, score)
    rows = [(k, float(stats[k][1][:, 1].sum()), float(found[k, 0][0] / found[k, 0][1])) for k in centres]
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def assign(points: DataFrame, key: str, centres: np.ndarray, k: int, view: View = whole) -> DataFrame:
    """(key, prediction): the nearest centre of each row."""
    kind = points.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                label = label_rows(_vectors(batch, "x"), {k: centres}, view)[k]
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(label.astype(np.int32))], [key, "prediction"])

    return points.select(key, "x").mapInArrow(place, f"`{key}` {kind}, prediction int")
