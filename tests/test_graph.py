"""Neighbour edges, spectral clusters and k-means of many sizes at once, on planted data and against all pairs."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from grainfold.operators import cluster, kmeans, neighbours, spectral

N, SMALL = 4000, 8


@pytest.fixture(scope="module")
def planted(spark):
    """Five large groups and one that holds 0.2 % of the rows."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 16))
    label = np.arange(N) % 5
    x = centre[label] + rng.normal(size=(N, 16)) * 0.35
    few = rng.choice(N, SMALL, replace=False)
    label[few], x[few] = 5, centre[5] + rng.normal(size=(SMALL, 16)) * 0.1
    df = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))], "id long, label int, x array<double>")
    return df.cache(), x


@pytest.fixture(scope="module")
def graph(planted):
    return cluster.neighbour_graph(planted[0], "id", "x")


def recall(edges, x, near):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -9)
    best = np.argsort(-sims, axis=1)[:, :near]
    found = {}
    for r in edges.collect():
        found.setdefault(r.src, set()).add(r.dst)
    return np.mean([len(found[i] & set(best[i])) / near for i in range(len(x))])


def test_edges_against_all_pairs(planted, graph):
    edges, members = graph
    assert recall(edges, planted[1], 10) >= 0.99
    assert members.count() == N and members.where("id <> node").count() == 0
    # both directions with one weight, no loops
    assert edges.where("src = dst").count() == 0
    assert edges.exceptAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).count() == 0


def test_edges_of_structureless_rows(spark):
    """Directions without groups are the hardest case; 2,000 of them in 64 dimensions."""
    x = np.random.default_rng(5).normal(size=(2000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    edges, _ = cluster.neighbour_graph(df, "id", "x")
    assert recall(edges, x, 10) >= 0.9


def test_copies_are_one_node(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(500)] + [(500 + i, [0.1 * i, 1.0, 0.0]) for i in range(20)]
    rows += [(900, None), (901, [0.0, 0.0, 0.0]), (902, [float("nan"), 1.0, 0.0]), (903, [1.0, None, 0.0]), (904, [2.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    nodes, members = neighbours.distinct_directions(df, "id", "x")
    assert nodes.count() == 21 and nodes.where("node = 0").first().n == 501
    assert members.where("node = 0").count() == 501 and members.count() == 521
    embedded = cluster.spectral_embedding(df, "id", "x", 3).collect()
    assert len(embedded) == 525 and all(len(r.embedding) == 3 for r in embedded)
    assert all(r.embedding == [0.0] * 3 for r in embedded if 900 <= r.id < 904)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [2.0, 1.0])]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "id long, x array<double>")
    assert cluster.spectral_embedding(df, "id", "x", 2).count() == len(rows)


def test_small_cluster_is_found(planted, graph):
    df, _ = planted
    vectors, values = spectral.leading_vectors(graph[0], 8)
    assert all(a >= b - 1e-9 for a, b in zip(values, values[1:])) and values[0] == pytest.approx(1, abs=1e-3)
    found = cluster.spectral_clusters(vectors.withColumnRenamed("node", "id"), "id", 6).join(df, "id")
    table = {(r.prediction, r.label): r["count"] for r in found.groupBy("prediction", "label").count().collect()}
    home = {label: max((c for c, x in table if x == label), key=lambda c: table[c, label]) for label in range(6)}
    assert len(set(home.values())) == 6 and table[home[5], 5] == SMALL
    assert sum(table[home[label], label] for label in range(6)) >= 0.99 * N


def test_vectors_are_eigenvectors(spark):
    """Against the dense matrix of a small graph."""
    rng = np.random.default_rng(1)
    w = np.triu(rng.uniform(0.1, 1, (30, 30)) * (rng.uniform(size=(30, 30)) < 0.2), 1)
    w[np.arange(29), np.arange(1, 30)] = 0.5
    w = w + w.T
    edges = spark.createDataFrame([(int(i), int(j), float(w[i, j])) for i, j in zip(*np.nonzero(w))], "src long, dst long, weight double")
    vectors, values = spectral.leading_vectors(edges, 4)
    root = np.sqrt(w.sum(1))
    want, turned = np.linalg.eigh(w / root[:, None] / root[None])
    assert np.allclose(values, want[::-1][:4], atol=1e-6)
    got = np.array([r.embedding for r in vectors.orderBy("node").collect()])
    assert np.allclose(np.abs((got * turned[:, ::-1][:, :4]).sum(0)), 1, atol=1e-5)


def test_power_iteration_finds_the_small_cluster(planted):
    df, _ = planted
    # with more neighbours than the cluster has rows, the walk soon leaves it
    found = cluster.pic_clusters(df, "id", "x", 6, near=5).join(df, "id")
    assert found.count() == N
    few = found.where("label = 5").groupBy("prediction").count().collect()
    assert len(few) == 1 and found.where(F.col("prediction") == few[0].prediction).count() == SMALL


def test_sweep_prefers_the_planted_number(planted):
    df, _ = planted
    sweep = {r.k: r.silhouette for r in cluster.spectral_sweep(df, "id", "x", [2, 5, 8]).collect()}
    assert max(sweep, key=sweep.get) == 5


def test_silhouettes_as_the_evaluator(spark, planted):
    df = planted[0].select(F.xxhash64("id").alias("h"), "x")
    centres = kmeans.fit_many(df, [2, 5, 9])
    table = {r.k: r for r in kmeans.judge_many(df, centres).collect()}
    for k, c in centres.items():
        labelled = kmeans.assign(df, "h", c, k).join(df, "h").withColumn("features", array_to_vector("x"))
        assert table[k].silhouette == pytest.approx(ClusteringEvaluator().evaluate(labelled), abs=1e-9)
        x = np.array([r.x for r in df.collect()])
        assert table[k].inertia == pytest.approx(((x[:, None] - c[None]) ** 2).sum(2).min(1).sum(), rel=1e-9)


def test_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [4.0])], "h long, x array<double>")
    centres = kmeans.fit_many(df, [2, 7])
    assert sorted(c[0] for c in centres[7]) == [0.0, 4.0]
    assert {r.k: (r.inertia, round(r.silhouette, 6)) for r in kmeans.judge_many(df, centres).collect()} == {2: (0.0, 0.666667), 7: (0.0, 0.666667)}


def test_products_over_parts(spark, monkeypatch):
    """In many parts: the product of the plain matrix; one term a part and source leaves, and a node's neighbours mostly share its part."""
    monkeypatch.setattr(spectral, "PART", 40)
    rng = np.random.default_rng(2)
    pairs = {(int(i), int(j)) for i in range(600) for j in 20 * (i // 20) + rng.integers(0, 20, 6) if i != j} | {(20 * i, 20 * i + 20) for i in range(29)}
    pairs |= {(j, i) for i, j in pairs}
    edges = spark.createDataFrame([(i, j, 1.0) for i, j in pairs], "src long, dst long, weight double")
    matrix = spectral.parted(spectral.with_loops(edges, symmetric=False))
    assert matrix.parts == 16 and matrix.nodes == 600
    w = np.zeros((600, 600))
    w[tuple(zip(*pairs))] = 1
    w = w / w.sum(1)[:, None] / 2 + np.eye(600) / 2
    x = np.array([r.v for r in spectral.start_vectors(matrix, 3, 1).orderBy("node").collect()])
    terms = spectral.multiply(matrix, spectral.multiply(matrix, spectral.start_vectors(matrix, 3, 1)), np.diag([1.0, 2.0, 3.0]))
    got = np.array([r.v for r in spectral.whole(matrix, terms).orderBy("node").collect()])
    np.testing.assert_allclose(got, w @ w @ x @ np.diag([1.0, 2.0, 3.0]), atol=1e-12)
    # dealt by hashes of nodes, nearly every cell would be a term of its own
    assert terms.count() == matrix.cells.select("part", "src").distinct().count() < 0.25 * matrix.cells.count()


def test_no_broadcast_in_the_rounds(spark):
    edges = spark.createDataFrame([(i, (i + d) % 50, 1.0) for i in range(50) for d in (1, 49)], "src long, dst long, weight double")
    matrix = spectral.parted(spectral.with_loops(edges, symmetric=True))
    plan = spectral.multiply(matrix, spectral.start_vectors(matrix, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
