"""What the plans must and must not contain, whatever the data size."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from grainfold.operators import clean, split
from grainfold.plans import QUERIES

ITERATIVE = {n for n, f in QUERIES.items() if f.__module__.endswith("models")} | {"word2vec", "doc_vectors", "pacf", "ar_fit", "ar_fit_daily_lags", "ar_residuals"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE))
def test_no_pairing_of_all_rows_and_no_row_wise_python(spark, name):
    found = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in found


def scan_of(df):
    """The scan's part of the formatted plan, where nothing is cut short."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text[text.index("Location:"):].split("\n\n")[0]


def test_filters_and_columns_reach_the_scan(spark):
    found = scan_of(QUERIES["filter_rows"](spark, SF))
    assert "LessThan(l_quantity,5.0)" in found and "In(l_returnflag, [A,R])" in found
    assert "l_shipdate" not in found and "l_tax" not in found
    sliced = scan_of(QUERIES["time_slice"](spark, SF))
    assert "GreaterThanOrEqual(ts" in sliced and "props" not in sliced


def test_caps_and_tops_keep_few_rows_per_task(spark):
    assert plan(QUERIES["cap_per_class"](spark, SF)).count("WindowGroupLimit") == 2  # before and after the shuffle
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, SF))
    assert "TakeOrderedAndProject" in plan(QUERIES["preview_slice"](spark, SF))


def test_group_statistics_do_not_shuffle_the_rows(spark):
    for name in ("group_size", "impute_group_mean", "peer_deviation", "canonical_code"):
        assert "Exchange hashpartitioning" not in plan(QUERIES[name](spark, SF))


def test_counts_are_combined_before_the_shuffle(spark):
    for name in ("tag_profile", "bow_counts", "profile_by_factor", "avg_rating"):
        assert "partial_" in plan(QUERIES[name](spark, SF))


def test_a_heavy_key_is_split_when_statistics_are_too_big_to_broadcast(spark):
    """AQE cuts the partition of a key with a third of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), F.rand(1).alias("x"))
        out = clean.group_size(rows, ["k"]).where("group_size > 0")
        assert out.count() == 300_000
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_split_is_codegen_only(spark):
    found = plan(split.hash_split(spark.range(100), "id", {"a": 50, "b": 50}))
    assert "Exchange" not in found and "*(1)" in found
