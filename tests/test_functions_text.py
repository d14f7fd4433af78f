import pytest
from pyspark.sql import functions as F

from grainfold.functions import arrays, dates, numeric, text as t
from grainfold.operators import terms


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def test_parts_and_sizes(spark):
    x = F.col("x")
    assert one(spark, t.part(x, ";", 0), x="a;b;c") == "a"
    assert one(spark, t.part(x, ";", -1), x="a;b;c") == "c"
    assert one(spark, t.part(x, ";", 5), x="a;b;c") is None
    assert one(spark, t.list_size(x, ";"), x="a;b;c") == 3
    assert one(spark, t.list_size(x, ";"), x=None) == 0
    assert one(spark, t.list_size(x, ";"), x="") == 0


@pytest.mark.parametrize("raw, want", [("a b c d e", "a b"), ("a b c", ""), ("a", ""), ("a\u0085 b c d", "a")])
def test_drop_last_tokens(spark, raw, want):
    assert one(spark, t.drop_last_tokens(F.col("x")), x=raw) == want


@pytest.mark.parametrize("raw, want", [
    ("Kelly, Mr. James", "Kelly, Mr. James"),
    ('Hill, Mrs. Ann "Nan"', "Hill, Mrs. Ann "),
    ('Hill, Mrs. Ann "Nan" (Eve)', "Hill, Mrs. Ann Nan (Eve)"),
    ('Hill, Mr. "Two Words" X', "Hill, Mr. Two Words X"),
    ('Hill, Mr. "A" X', "Hill, Mr. A X"),
    ("A/B, Mr. C", "A-B, Mr. C"),
])
def test_quotes(spark, raw, want):
    assert one(spark, t.clean_quotes(F.col("x")), x=raw) == want


@pytest.mark.parametrize("raw, want", [
    ("Kelly, Mr. J", "Mr"), ("Rothes, the Countess. of", "Noble"), ("X, Mlle. Y", "Miss"), ("X, Mme. Y", "Mrs"),
    ("X, Major. Y", "Military"), ("X, Dr. Y", "Dr"), ("no comma", None),
])
def test_titles(spark, raw, want):
    assert one(spark, t.title_bucket(F.col("x")), x=raw) == want


def test_title_agrees(spark):
    agree = t.title_agrees(F.col("n"), F.col("s"))
    assert one(spark, agree, n="A, Mr. B", s="male") == 1
    assert one(spark, agree, n="A, Mr. B", s="female") == 0
    assert one(spark, agree, n="A B", s="male") == 0


def test_year_pairs_genres(spark):
    x = F.col("x")
    assert one(spark, t.title_year(x), x='Name (with part) (1999)"') == 1999
    assert one(spark, t.title_year(x), x="Name (1999) II") is None
    assert one(spark, t.pair_code(F.col("a"), F.col("b")), a="nce", b="CDG") == "CDGnce"
    assert [one(spark, t.genre_score(x), x=g) for g in ("Drama|Mystery|Thriller", "Thriller|Mystery", "Drama")] == [1.0, 0.5, 0.0]


def test_tokens_follow_unicode(spark):
    assert one(spark, t.tokens(F.col("x")), x="Été à l'île_2 x") == ["été", "île_2"]
    assert one(spark, t.tokens(F.col("x"), t.LETTERS), x="ab12cd 3") == ["ab", "cd"]
    assert one(spark, t.bigrams(t.tokens(F.col("x"))), x="aa bb cc") == ["aa bb", "bb cc"]
    assert one(spark, t.bigrams(t.tokens(F.col("x"))), x="aa") == []
    assert one(spark, t.clean_token(F.col("x")), x="l'été, ok!") == "l été  ok "


def test_numbers(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, numeric.guarded_ratio(a, b), a=1.0, b=0.0) == 0.0
    assert one(spark, numeric.margin(a, b), a=4.0, b=1.0) == 0.75
    assert [one(spark, numeric.bin_by(a, [5, 20]), a=v) for v in (4.9, 5.0, 19.0, 20.0)] == [0, 1, 1, 2]
    assert one(spark, numeric.safe_double(F.col("x"), b), x=" ", b=3.0) == 3.0
    assert one(spark, numeric.safe_double(F.col("x"), b), x=" 2.5 ", b=3.0) == 2.5
    assert one(spark, numeric.remap(F.col("x"), {"k": "v"}), x="other") is None


def test_dates(spark):
    x = F.col("x")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert one(spark, text(dates.parse_ts(x, dates.ISO)), x="2017-03-04T05:06:07+02:00") == "2017-03-04 05:06:07"
    assert one(spark, text(dates.parse_ts(x, dates.TIME_FIRST)), x="17:24:00::16/12/2006") == "2006-12-16 17:24:00"
    assert one(spark, text(dates.parse_ts(x)), x="nonsense") is None
    assert one(spark, text(dates.first_leg(x)), x=None) == "2001-01-01 00:00:00"
    assert one(spark, dates.calendar_parts(dates.parse_ts(x))["weekday"], x="2006-12-16 00:00:00") == 5
    late, early = dates.parse_ts(F.col("a")), dates.parse_ts(F.col("b"))
    assert one(spark, dates.days_until(late, early), a="2017-01-02 00:00:00", b="2016-12-31 23:00:00") == 2
    assert one(spark, dates.days_until(late, early, True), a="2001-01-01 00:00:00", b="2016-12-31 23:00:00") == 0


def test_padding(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3, 4],), ([],)], "a array<int>")
    assert [r[0] for r in df.select(arrays.left_pad(F.col("a"), 3)).collect()] == [[0, 1, 2], [2, 3, 4], [0, 0, 0]]


DOCS = [(1, "red red blue"), (2, "blue green"), (3, ""), (4, "red")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, text string")


def test_vocabulary_limits(docs, as_rows):
    counts = terms.term_counts(docs, "id", "text")
    assert as_rows(counts) == [(1, "blue", 1), (1, "red", 2), (2, "blue", 1), (2, "green", 1), (4, "red", 1)]
    n = F.lit(4)
    assert {r.term for r in terms.vocabulary(counts, n, min_df=2).collect()} == {"red", "blue"}
    assert {r.term for r in terms.vocabulary(counts, n, max_df=0.4).collect()} == {"green"}
    assert [r.term for r in terms.vocabulary(counts, n, max_features=1).collect()] == ["red"]


def test_tfidf_by_hand(docs):
    import math

    got = {(r.id, r.term): r.tfidf for r in terms.tfidf(docs, "id", "text").collect()}
    idf = lambda df: math.log(5 / (1 + df)) + 1
    red, blue = 2 * idf(2), idf(2)
    assert got[1, "red"] == pytest.approx(red / math.hypot(red, blue))
    assert got[4, "red"] == pytest.approx(1.0)


def test_token_numbers(docs):
    index = terms.vocabulary_index(terms.term_totals(docs, "text"), min_count=2)
    assert index.exceptAll(terms.vocabulary_index(terms.term_counts(docs, "id", "text"), min_count=2)).count() == 0
    assert {r.term: r.idx for r in index.collect()} == {"red": 1, "blue": 2}
    want = {1: [1, 1, 2], 2: [2, 0], 3: [], 4: [1]}
    assert {r.id: r.ids for r in terms.token_index(docs, "id", "text", index).collect()} == want


def test_stop_words(spark, docs):
    assert "ils" in terms.french_stop_words() and "au" in terms.french_stop_words()
    words = terms.token_array(F.col("text"), ngrams=2, stop=["red"])
    assert docs.where("id = 1").select(words).first()[0] == ["blue"]
