import pytest
from pyspark.sql import functions as F

from grainfold.operators import clean, encode, lookup, profile, recommend, split


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    """Statistics below and above the broadcast threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    if request.param == "shuffle":
        spark.conf.set(name, -1)
    yield request.param
    spark.conf.set(name, before)


DATA = [(1, "a", "x", 1.0), (2, "a", "x", None), (3, "a", "y", 4.0), (4, "b", "y", 2.0), (5, "b", None, None),
        (6, "c", "z", None), (7, None, "q", None), (8, None, "q", 9.0)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, "id int, k string, c string, v double")


def test_group_mean(df, join_kind, as_rows):
    got = dict(as_rows(clean.impute_group_mean(df, ["v"], ["k"]).select("id", "v")))
    # no known value in group c, NULL key: stays NULL
    assert got == {1: 1.0, 2: 2.5, 3: 4.0, 4: 2.0, 5: 2.0, 6: None, 7: None, 8: 9.0}


def test_group_mean_half_even(df, join_kind, as_rows):
    got = dict(as_rows(clean.impute_group_mean(df, ["v"], ["k"], half_even=True).select("id", "v")))
    assert got[2] == 2.0  # 2.5 rounds to the even neighbour


def test_group_mode_ties_take_the_smallest(spark, join_kind, as_rows):
    df = spark.createDataFrame([(1, "a", "y"), (2, "a", "x"), (3, "a", None), (4, "b", None)], "id int, k string, c string")
    assert dict(as_rows(clean.impute_group_mode(df, "c", ["k"]).select("id", "c"))) == {1: "y", 2: "x", 3: "x", 4: None}


def test_group_size_and_deviation(df, join_kind, as_rows):
    assert dict(as_rows(clean.group_size(df, ["k"]).select("id", "group_size"))) == {
        1: 3, 2: 3, 3: 3, 4: 2, 5: 2, 6: 1, 7: None, 8: None}
    got = dict(as_rows(lookup.peer_deviation(df, "v", ["k"]).select("id", "deviation")))
    assert got == {1: -1.5, 2: None, 3: 1.5, 4: 0.0, 5: None, 6: None, 7: None, 8: None}


def test_attach_shuffles_rows_only_above_the_threshold(spark, join_kind):
    out = clean.group_size(spark.range(100).selectExpr("id", "id % 7 k"), ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (join_kind == "broadcast")
    assert ("SortMergeJoin" in plan) == (join_kind == "shuffle")


def test_attach_keeps_every_row(spark, join_kind):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    out = clean.group_size(big, ["k"])
    assert out.count() == 3000
    assert out.where("k = 0").select("group_size").distinct().first()[0] == 1000
    assert out.where("k <> 0 and group_size <> 1").count() == 0


def test_canonical_code_first_seen(spark, join_kind, as_rows):
    data = [(1, "N", "B"), (2, "N", "A"), (3, "M", "C"), (4, "M", "C")]
    df = spark.createDataFrame(data, "pos int, name string, code string")
    assert as_rows(lookup.use_canonical_code(df, "name", "code", "pos").select("pos", "code")) == [(1, "B"), (2, "B"), (3, "C"), (4, "C")]
    flipped = df.withColumn("pos", -F.col("pos"))
    assert as_rows(lookup.use_canonical_code(flipped, "name", "code", "pos").select("pos", "code")) == [
        (-4, "C"), (-3, "C"), (-2, "A"), (-1, "A")]


def test_sentinels(spark, as_rows):
    df = spark.createDataFrame([(1, -1.0, "-1"), (-1, float("nan"), "b")], "a int, b double, c string")
    assert clean.sentinels_to_null(df, -1).collect() == [(1, None, None), (None, None, "b")]


def test_header_rows_and_names(spark, as_rows):
    df = spark.createDataFrame([("a",), ("col",), (None,)], "col string")
    assert clean.drop_header_rows(df, "col").count() == 2
    wide = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(" USD", "GBP ", " ")
    assert clean.normalise_names(wide).columns == ["USD", "GBP"]


def test_unions(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2.0, 2)], "d double, i int")
    assert clean.union_common(a, b).columns == ["i"]
    flagged = clean.union_flagged({0: a, 1: b}, "test")
    assert flagged.columns == ["i", "s", "test", "d"] and flagged.where("test = 1").first().s is None


def test_rates(spark, as_rows):
    rates = spark.createDataFrame([(1.0, 2.0)], "EUR double, USD double")
    df = spark.createDataFrame([("USD", 3.0), ("XXX", 1.0)], "cur string, fare double")
    assert as_rows(lookup.rate_lookup(df, rates, "cur")) == [("USD", 3.0, 2.0)]


def test_profiles(spark, df, as_rows):
    assert dict(as_rows(profile.completeness(df))) == {"id": 8, "k": 6, "c": 7, "v": 4}
    got = profile.profile_by_factor(df, ["k", "c"], ["v"]).where("factor = 'k' and level is null").first()
    assert got.n == 2 and got.avg_v == 9.0
    flat = spark.createDataFrame([(1, 5.0), (2, 5.0)], "i int, v double")
    assert as_rows(profile.corr_matrix(flat, ["i", "v"])) == [("v", "i", None)]
    assert [r.s for r in profile.minmax_norm(flat, "v", "s").collect()] == [0.0, 0.0]


def test_one_hot_unknown_is_zero(df, as_rows):
    got = encode.one_hot(df, "c", ["x", "y", "z"], drop="z").where("id in (1, 5, 6)").select("c_x", "c_y")
    assert as_rows(got) == [(0, 0), (0, 0), (1, 0)]


def test_codes_null_is_minus_one(df, as_rows):
    assert dict(as_rows(encode.category_codes(df, ["k"]).select("id", "k_code"))) == {
        1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 2, 7: -1, 8: -1}


def test_split_is_disjoint_and_stable(spark):
    df = split.hash_split(spark.range(2000), "id", {"train": 70, "valid": 15, "test": 15})
    sizes = {r.part: r.n for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 2000 and 1300 < sizes["train"] < 1500
    again = split.hash_split(spark.range(2000).repartition(5), "id", {"train": 70, "valid": 15, "test": 15})
    assert df.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        split.split_name(F.col("id"), {"train": 70})


def test_recommender(spark, as_rows):
    movies = spark.createDataFrame(
        [("1", "Anchor (2016)", "Mystery|Thriller"), ("2", "B (1999)", "Mystery|Thriller"), ("3", "C", "Drama"),
         ("11", "D (2000)", "Thriller"), ("4", "E (2001)", "Mystery")], "movieId string, title string, genres string")
    tags = spark.createDataFrame(
        [("u", "1", "Dark"), ("v", "1", "dark"), ("w", "1", "art"), ("u", "2", "DARK"), ("u", "3", "art"),
         ("u", "11", "fun"), ("v", "11", "art"), ("u", "4", "none")], "userId string, movieId string, tag string")
    ratings = spark.createDataFrame(
        [("u", "1", 5.0), ("u", "2", 5.0), ("u", "11", 5.0), ("u", "3", 5.0), ("v", "3", 1.0), ("v", "4", 5.0)],
        "userId string, movieId string, rating double")
    scores = dict(as_rows(recommend.tag_similarity(tags, "movieId", "tag", "1")))
    assert scores == {"2": pytest.approx(2 / 3), "3": pytest.approx(1 / 3), "11": pytest.approx(1 / 6), "4": 0.0}
    out = recommend.recommend(movies, tags, ratings, "1")
    # 3 is rated too low, 4 was liked by nobody who liked the anchor, "11" is not the anchor "1"
    assert [(r.movieId, round(r.score, 6)) for r in out.collect()] == [("2", 2.0), ("11", 0.75)]
    assert [r.movieId for r in recommend.recommend(movies, tags, ratings, "1", need_year=True).collect()] == ["2", "11"]
