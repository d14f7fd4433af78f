"""What a query does as its tables grow: work that must not be done again, and what must not reach the driver."""

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from grainfold.operators import cluster, evaluate, hinge, learn, terms
from grainfold.plans import QUERIES
from grainfold.sources import files


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_split_a_text_once(spark):
    df = spark.createDataFrame([(1, "aa bb cc aa bb"), (1, "aa bb"), (2, "dd"), (3, ""), (4, None), (None, "aa bb")], "id long, text string")
    counts = terms.term_counts(df, "id", "text", ngrams=2)
    assert plan(counts).count("regexp_extract_all") == 1
    want = Counter({(1, "aa"): 3, (1, "bb"): 3, (1, "cc"): 1, (1, "aa bb"): 3, (1, "bb cc"): 1, (1, "cc aa"): 1, (2, "dd"): 1, (None, "aa"): 1, (None, "bb"): 1, (None, "aa bb"): 1})
    assert {(r.id, r.term): r.n for r in counts.collect()} == want
    kept = terms.term_counts(df, "id", "text", ngrams=2, stop=["bb"]).where("id = 1")
    assert {r.term: r.n for r in kept.collect()} == {"aa": 3, "cc": 1, "aa cc": 1, "cc aa": 1}


def test_side_files_hold_a_thousand_events(spark, tmp_path):
    # ids of a user far apart: blocks of ids would give every event a file of its own
    df = spark.range(2500).select((F.col("id") * 1000).alias("event_id"), F.when(F.col("id") < 2400, 1).otherwise(2).cast("long").alias("user_id"), F.timestamp_seconds("id").alias("ts"), F.lit(0.5).alias("value"))
    df.write.parquet(str(tmp_path / "events.parquet"))
    out = QUERIES["json_sidecars"](spark, str(tmp_path))
    assert len(out.inputFiles()) == 4
    assert {(r.file_id, r.start, r.end) for r in out.collect()} == {(("1" if i < 2400 else "2"), float(i), i + 0.5) for i in range(2500)}


def test_file_names_stay_out_of_the_commit_message(spark, tmp_path):
    batch = pa.record_batch([pa.array([f"d/{i}" for i in range(1000)]), pa.array([b"x"] * 1000, pa.binary())], ["name", "content"])
    writer = files.FileWriter(str(tmp_path))
    message = writer.write(iter([batch, batch.slice(0, 0)]))
    assert len(pickle.dumps(message)) < 1000
    assert not (tmp_path / "d").exists()
    writer.commit([message, None])
    assert len(list((tmp_path / "d").iterdir())) == 1000 and not (tmp_path / "_temporary").exists()


def test_a_text_s_length_is_summed_once(spark):
    counts = spark.range(3000).select(F.lit(1).alias("id"), F.col("id").cast("string").alias("term"), (F.col("id") % 7 + 1).alias("n"))
    index = counts.select("term", F.col("term").cast("long").alias("idx"), F.lit(1).alias("df"))
    rows = terms.sparse_rows(counts, index, "id", 1, use_idf=False)
    # a sum inside the division would be made again for every weight
    assert "sqrt(aggregate(" not in plan(rows).lower()
    (row,) = rows.collect()
    assert row.idx == list(range(3000))
    size = sum((i % 7 + 1) ** 2 for i in range(3000)) ** 0.5
    assert row.val == [(i % 7 + 1) / size for i in range(3000)]


def test_steps_hand_on_matrices():
    made = hinge._out(0, np.arange(4), np.arange(8.0).reshape(4, 2))
    assert made.column("v").to_pylist() == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0], [6.0, 7.0]]
    assert made.schema.equals(hinge._out(1, np.empty(0, np.int64), np.empty((0, 1))).schema)


def test_a_sweep_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def count(i):
        made.add(1)
        return float(i % 3)

    rows = spark.range(40).select(count("id").alias("label"), F.col("id"))
    vectors = VectorAssembler(inputCols=["id"], outputCol="features").transform(rows)
    score = lambda scored: evaluate.regression_report(scored, "label", "prediction").select("mse")
    out = learn.tree_count_sweep(lambda n: learn.forest_regressor(trees=n, max_depth=1), [1, 2], vectors, vectors, score)
    assert [r.trees for r in out.collect()] == [1, 2]
    assert made.value == 80


def test_factors_by_matrices_are_those_by_cells(monkeypatch):
    rng = np.random.default_rng(3)
    size = np.array([1, 6, 10, 3])
    columns, values = np.concatenate([rng.choice(10, n, replace=False) for n in size]), rng.uniform(0.01, 1, size.sum())
    starts, row = np.cumsum(size) - size, np.repeat(np.arange(4), size)
    topics = rng.uniform(0.1, 1, (3, 10))
    made = []
    for dense in (0, 16):
        monkeypatch.setattr(cluster, "_DENSE", dense)
        with monkeypatch.context() as m:
            if dense:
                m.setattr(cluster, "_fold_in", None)
            made.append(cluster._sums_of(values, columns, starts, row, topics, 0.05, 0.05, 10))
    for a, b in zip(*made):
        np.testing.assert_allclose(a, b, rtol=1e-12)
