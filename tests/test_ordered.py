"""Ordered operators: many small pieces must give what one piece gives, also with one heavy key."""

import pytest
from pyspark.sql import functions as F

from grainfold.operators import profile, sequence
from grainfold.operators.encode import category_codes
from grainfold.operators.evaluate import roc_auc
from grainfold.operators.ordered import OrderedGroups


@pytest.fixture(scope="module")
def skewed(spark):
    # a third of the rows in one key, NULL keys, NULL values, ties in t settled by id
    k = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 7)
    v = F.when(F.col("id") % 5 != 0, (F.col("id") * 37 % 101 - 50).cast("double"))
    return spark.range(2000).select("id", k.alias("k"), (F.col("id") / 4).cast("long").alias("t"), v.alias("v")).cache()


@pytest.fixture
def both(spark, as_rows):
    """Rows of what ``make`` gives, the same from one piece and from pieces of a few rows."""

    def run(make):
        found = []
        for parts in (1, 16):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found.append(as_rows(make()))
        assert found[0] == found[1]
        return found[0]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield run
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_heavy_key_is_in_many_pieces(spark, skewed, both):
    def pieces():
        rows = OrderedGroups(skewed, ["k"], ["t", "id"])._df
        return rows.where("k = 1").select("_piece").distinct().count()

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    assert pieces() > 3


def test_first_diff(skewed, both):
    both(lambda: sequence.first_diff(skewed, "v", ["k"], ["t", "id"]).select("id", "diff"))


def test_position_and_max_before(skewed, both):
    got = both(lambda: OrderedGroups(skewed, ["k"], ["id"]).position("p").max_before("m", F.col("v")).frame().select("k", "id", "p", "m").na.fill(-999))
    per_key = {}
    for k, _, p, _ in got:
        per_key.setdefault(k, []).append(p)
    assert all(ps == list(range(1, len(ps) + 1)) for ps in per_key.values())


def test_interpolation(skewed, both):
    both(lambda: sequence.interpolate_linear(skewed, "v", ["k"], ["t", "id"]).select("id", F.round("filled", 9).alias("f")).na.fill(-999.0))


def test_interpolation_leaves_the_ends(spark, as_rows):
    df = spark.createDataFrame([(1, None), (2, 10.0), (3, None), (4, None), (5, 40.0), (6, None)], "t int, v double")
    assert as_rows(sequence.interpolate_linear(df, "v", [], ["t"]).select("t", "filled")) == [
        (1, None), (2, 10.0), (3, 20.0), (4, 30.0), (5, 40.0), (6, None)
    ]


def test_sessions(skewed, both):
    both(lambda: sequence.gap_sessions(skewed, F.col("t").cast("double"), 1, ["k"], ["t", "id"]).select("id", "session"))


def test_merge_intervals(skewed, both):
    spans = skewed.where("k is not null").select("k", F.col("t").alias("s"), (F.col("t") + F.col("id") % 4).alias("e"))
    both(lambda: sequence.merge_intervals(spans, "s", "e", ["k"]))


def test_jump_score(skewed, both, as_rows):
    known = skewed.where("v is not null and k is not null")
    whole = both(lambda: sequence.bounded_jump_score(known, "v", ["k"], ["t", "id"]))
    for chunk in (5, 8, 13):
        assert as_rows(sequence.bounded_jump_score(known, "v", ["k"], ["t", "id"], chunk=chunk)) == whole


def test_quantiles(skewed, both):
    got = both(lambda: profile.quantiles(skewed, ["k"], "v", [0.1, 0.5]).na.fill(-999))
    want = skewed.groupBy("k").agg(F.percentile("v", [0.1, 0.5]).alias("q"))
    want = sorted((r.k if r.k is not None else -999, r.q[0], r.q[1]) for r in want.collect())
    assert [(a, pytest.approx(b), pytest.approx(c)) for a, b, c in want] == got


def test_codes_and_auc(skewed, both, as_rows):
    text = skewed.select("id", (F.col("id") % 50).cast("string").alias("c"), (F.col("id") % 2).alias("y"), "v")
    codes = dict(as_rows(category_codes(text, ["c"]).select("c", "c_code").distinct()))
    assert codes == {c: i for i, c in enumerate(sorted(codes))}
    known = text.where("v is not null")
    both(lambda: roc_auc(known, "y", "v").select(F.round("auc", 9).alias("auc")))
