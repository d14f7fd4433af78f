"""The whole jobs on small tables with the schemas of their inputs."""

import pytest
from pyspark.sql import functions as F

from grainfold.jobs import bikes, cargo, curves, customers, fares, margin, paragraphs, passengers, power, speech, texts


@pytest.fixture(scope="module")
def flights(spark):
    rates = spark.createDataFrame([(1.0, 1.25, None)], "` EUR` double, `USD ` double, ` ` double")
    common = dict(
        partner_id=1, passengers=1, num_requests=2, supplier="s", cabin_class="Economy", currency="USD", origin="NCE",
        destination="cdg", fare=125.0, departure_datetime_1="2017-03-10T10:00:00+01:00;2017-03-10T18:00:00",
        arrival_datetime_1="2017-03-11T10:00:00", arrival_datetime_2=None, flight_num_1="1;2", flight_num_2=None,
    )
    types = "partner_id int, passengers int, num_requests int, supplier string, cabin_class string, currency string, origin string, destination string, fare double, departure_datetime_1 string, arrival_datetime_1 string, arrival_datetime_2 string, flight_num_1 string, flight_num_2 string"
    cabins = ["Economy", "Business", "mixed", "COACH"]
    search = [
        (f"s{i}", f"u{i % 10}", "2017-03-01 12:00:00", *{**common, "cabin_class": cabins[i % 4], "fare": 50.0 + i, "passengers": 0 if i == 5 else 1}.values())
        for i in range(120)
    ]
    search.append(search[0])  # an exact copy
    search.append(("sx", "u1", "2017-03-01 12:00:00", *{**common, "currency": "XXX"}.values()))
    book = [
        (f"b{i}", f"u{i % 3}", "2017-03-02 12:00:00", *{**common, "cabin_class": "First Class", "fare": 900.0 + i, "arrival_datetime_1": None}.values())
        for i in range(60)
    ]
    searches = spark.createDataFrame(search, "search_id string, search_user_id string, search_time string, " + types)
    bookings = spark.createDataFrame(book, "booking_id string, booking_user_id string, booking_time string, " + types)
    return searches, bookings.withColumnRenamed("arrival_datetime_2", "arrial_datetime_2"), rates


def test_fares(flights):
    searches, bookings, rates = flights
    merged = fares.merge_sources(searches, bookings)
    assert merged.count() == 121 + 60
    assert fares.merge_sources(searches, bookings, only_bookers=True).where("booked = 0").count() == 37
    features = fares.fare_features(merged, rates)
    assert features.count() == 119 + 60  # no passengers, unknown currency
    row = features.where("booking_id = 's0'").first()
    assert (row.fare_eur, row.days_to_departure, row.days_to_return, row.has_return) == (40.0, 9, 10, 1.0)
    assert (row.search_day_of_week, row.departure_day_of_year, row.nb_flights_departure, row.nb_flights_return) == (2, 69, 2, 0)
    assert (row.cabin_class, row.distance_code) == ("economy", "cdgNCE")
    row = features.where("booking_id = 'b0'").first()
    assert (row.days_to_return, row.has_return, row.return_day_of_year) == (0, 0.0, 1)
    _, report = fares.booking_classifier(features)
    assert report.where("class = 1").first().recall > 0.9
    _, errors = fares.fare_forest(features, trees=5)
    assert errors.first().r2 > 0.8


def test_margin(spark):
    ads = spark.range(300).select(
        F.col("id").alias("creative_id"), F.when(F.col("id") % 2 == 0, "ios").otherwise("android").alias("user_operating_system"),
        F.when(F.col("id") % 5 != 0, "Phone").alias("user_device"), (F.col("id") % 40).cast("double").alias("average_seconds_played"),
        F.lit(1.0).alias("cost"), F.when(F.col("id") % 40 > 20, 4.0).otherwise(0.0).alias("revenue"),
    )
    assert margin.prepare(ads).where("user_device = 'PersonalComputer'").count() == 60
    table = {r.user_operating_system: r for r in margin.margin_by_system(ads).collect()}
    assert table["ios"].profit == table["ios"].revenue - 150 and table["ios"].margin == pytest.approx(0.75 * table["ios"].revenue / 4)
    assert margin.correlations(ads).count() == 3
    _, report, importance = margin.revenue_forest(ads, trees=5)
    assert report.first().accuracy > 0.9 and importance.first().feature == "average_seconds_played"


def test_bikes(spark):
    rentals = spark.range(600).select(
        F.expr("timestamp_ntz'2011-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("datetime"),
        F.lit(1).alias("season"), F.lit(0).alias("holiday"), F.lit(1).alias("workingday"), (F.col("id") % 2 + 1).cast("int").alias("weather"),
        F.lit(10.0).alias("temp"), F.lit(12.0).alias("atemp"), (F.col("id") % 50).cast("double").alias("humidity"), F.lit(3.0).alias("windspeed"),
        F.lit(1).alias("casual"), F.lit(2).alias("registered"), (F.col("id") % 24 * 10).cast("int").alias("count"),
    )
    profile = bikes.demand_profile(rentals)
    assert profile.where("factor = 'hour' and level = '5'").first().avg_count == 50.0
    _, errors, importance = bikes.demand_forest(rentals, trees=5)
    assert {r.part for r in errors.collect()} == {"test", "valid"} and errors.where("part = 'valid'").first().r2 > 0.8
    assert importance.first().feature == "hour"


def test_cargo(spark):
    data = [
        (1, "2017", "01", "A1", "ACME", "X", 10.0, 2, 100.0), (2, "2017", "01", "A2", "ACME", "X", 10.0, 2, 140.0),
        (3, "2017", "01", "B", "BETA LTD", "X", 10.0, 2, 60.0), (4, "2017", "01", "B", "BETA LTD", None, 10.0, 2, 60.0),
        (5, "2017", "01", "B", "BETA LTD", "X", 10.0, 2, 0.0), (6, "2017", "01", "C", "C", "X", 10.0, 0, 9.0),
    ]
    rows = spark.createDataFrame(data, "row int, FlownYear string, FlownMonth string, AgentCode string, AgentName string, OriginCode string, ChargeableWeight double, Pieces int, Revenue double")
    rows = rows.selectExpr("*", "'c' CargoType", "'p' ProductCode", "'s' SpecialHandlingCodeList", "'k' CommodityCode", "'d' DestinationCode")
    out = {r.row: r for r in cargo.prepare(rows, "row").collect()}
    assert sorted(out) == [1, 2, 3, 4, 6] and out[2].AgentCode == "A1"
    # peers of row 1: pieces 2, weight per piece 5; row 6 has no pieces and so another mean of 50, 70, 30, 0
    assert out[1].RevenuePerPiece == 50 and out[6].RevenuePerPiece == 0
    assert out[1].Willingness == pytest.approx(50 - 37.5) and out[4].Willingness is None
    agents = {r.AgentCode: r.Willingness for r in cargo.agent_willingness(cargo.prepare(rows, "row")).collect()}
    assert agents["A1"] == pytest.approx(60 - 37.5)
    more = spark.range(140).selectExpr("cast(id as int) row", "cast(id % 7 as double) WeightPerPiece", "cast(id % 3 as int) Pieces", "cast(id % 7 as double) Willingness")
    table = cargo.willingness_search(more, "row", {"maxIter": [1, 3], "maxDepth": [1, 3]}, models=2, folds=2).collect()
    assert len(table) == 2 and table[0].metric <= table[1].metric


def test_power(spark, tmp_path):
    lines = ["Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3"]
    for day in range(16, 21):
        for minute in range(0, 1440, 20):
            known = not (day == 18 and minute == 600)
            values = f"{4.216 if minute == 0 else 1 + minute % 60 / 10:.3f};0.418;{240 + minute / 1440:.3f};18.4;0;1;17" if known else "?;?;?;?;?;?;?"
            lines.append(f"{day}/12/2006;{minute // 60:02d}:{minute % 60:02d}:00;{values}")
    (tmp_path / "p.txt").write_text("\n".join(lines))
    from grainfold.sources.readers import scan_csv

    raw = scan_csv(spark, str(tmp_path / "p.txt"), power.SCHEMA, sep=";", null="?")
    rows = power.prepare(raw).cache()
    first = rows.orderBy("datetime").first()
    assert first.Global_active_power == pytest.approx(70.26666666666667, abs=1e-9)
    assert (first.weekday, first.month, first.year, first.hour, first.minute) == (5, 12, 2006, 0, 0)
    gap = rows.where("datetime = timestamp_ntz'2006-12-18 10:00:00'").first()
    assert gap.Voltage == pytest.approx(240 + 600 / 1440, abs=2e-3) and gap.Global_active_power is not None
    series = power.daily(rows)
    assert [r.idx for r in series.orderBy("idx").collect()] == [0, 1, 2, 3, 4]
    assert power.daily_diff(series).where("diff is null").count() == 1
    assert power.correlogram(series, max_lag=2).where("lag = 0").first().acf == pytest.approx(1.0)
    assert power.hourly_windows(rows, "2006-12-17 00:00:00", "2006-12-19 23:59:00").count() == 3
    _, report, importance = power.power_forest(rows, trees=3)
    assert report.first().n > 20 and importance.count() == 4


def test_churn(spark):
    base = spark.range(240).select(
        F.col("id"), *[(F.when(F.col("id") % (i + 2) == 0, "y").otherwise("n")).alias(f"feature{i}") for i in range(1, 16)],
        F.when(F.col("id") % 9 == 0, " ").otherwise((F.col("id") % 12).cast("string")).alias("feature16"),
        (F.col("id") % 12).cast("double").alias("feature17"), F.lit(1.0).alias("feature18"),
        F.when(F.col("id") % 3 == 0, "Yes").otherwise("No").alias("Churn"),
    )
    rows = customers.churn_rows(base.where("id < 180"), base.where("id >= 180").drop("Churn"))
    assert rows.where("id = 9").first().feature16 == 9.0
    table, out = customers.churn_output(rows, {"maxIter": [1, 2], "maxDepth": [2]}, models=2, folds=2)
    assert table.count() == 2 and out.columns == ["id", "output"] and out.count() == 60
    assert out.where("output between 0 and 1").count() == 60
    # feature1 is the label: its probability must separate the classes
    assert out.where("(output > 0.5) <> (id % 3 = 0)").count() == 0


def test_newsletter(spark):
    sent = spark.range(120).selectExpr("id", "cast(id % 3 as int) email", "cast(id % 2 as int) gender", "if(id % 10 = 0, -1, cast(id % 4 as int)) geo",
                                       "cast(id % 2 as int) device", "cast(if(id % 7 = 0, -1, id % 5) as double) open_rate", "cast(id % 2 as int) open")
    to = spark.range(200, 230).selectExpr("id", "cast(id % 3 as int) email", "cast(id % 2 as int) gender", "1 geo", "cast(id % 2 as int) device", "1d open_rate")
    rows = customers.newsletter_rows(sent, to)
    assert rows.where("geo is null or open_rate is null").count() == 0
    assert rows.where("geo <> round(geo)").count() == 0
    table, out = customers.newsletter_output(rows, {"numTrees": [3], "maxDepth": [2, 4]}, folds=2)
    assert table.count() == 2 and out.count() == 30 and out.where("open <> id % 2").count() == 0


def test_passengers(spark):
    people = spark.range(200).selectExpr(
        "cast(id as int) PassengerId", "cast(id % 3 + 1 as int) Pclass", "concat('Fam', id % 60, ', ', if(id % 2 = 0, 'Mr', 'Miss'), '. First') Name",
        "if(id % 2 = 0, 'male', 'female') Sex", "if(id % 8 = 0, null, cast(id % 50 as double)) Age", "cast(id % 2 as int) SibSp", "0 Parch",
        "concat('PC ', id % 90) Ticket", "if(id = 13, null, cast(id % 3 * 10 + 5 as double)) Fare", "if(id = 7, null, element_at(array('C', 'Q', 'S'), cast(id % 3 + 1 as int))) Embarked",
        "cast(id % 2 as int) Survived")
    rows = passengers.prepare(people.where("PassengerId < 150"), people.where("PassengerId >= 150").drop("Survived"))
    assert rows.count() == 200 and rows.where("Embarked is null or Fare is null or Age is null").count() == 0
    assert rows.where("ConsistentSex = 0").count() == 0
    report = passengers.audit(rows)
    assert report["surnames"].count() == 10 and report["fares"].where("Pclass = 1").first().q50 == 5.0
    _, quality, out = passengers.survival_output(rows, {"numTrees": [3, 5]}, folds=2)
    assert quality.first().accuracy > 0.9
    assert out.columns == ["PassengerId", "Survived"] and out.count() == 50 and out.where("Survived between 0 and 1").count() == 50


def test_shop_and_legal_texts(spark):
    words = {"A": "red shoe leather", "B": "green salad bowl", "C": "blue sea boat"}
    data = [(i, f"{words['ABC'[i % 3]]} item tail one two", "ABC"[i % 3] if i < 150 else None) for i in range(180)]
    rows = texts.shop_rows(spark.createDataFrame(data, "id int, description string, cat string"))
    assert rows.first().text.endswith("item")
    model, report = texts.category_model(rows, "id", "cat", {"A": 1, "B": 10})
    assert report.first().accuracy == 1.0
    out = {r.id: r.predicted for r in texts.predict_categories(model, rows.where("cat is null"), "id").collect()}
    assert out == {i: "ABC"[i % 3] for i in range(150, 180)}


def test_products(spark):
    schema = "Identifiant_Produit int, prix string, Produit_Cdiscount string, Marque string, Libelle string, Description string, Categorie3 string"
    train = spark.createDataFrame([(1, "-1.0", "OUI", None, "l", "d", "c"), (None, "prix", "Produit_Cdiscount", "Marque", "Libelle", "Description", "Categorie3"), (2, "90.5", None, "m", "l", None, "c")], schema)
    rows = texts.product_rows(train, spark.createDataFrame([(3, "100.0", "NON", "m", "l", "x", None)], schema).drop("Categorie3"))
    assert {r.Identifiant_Produit: r.text for r in rows.collect()} == {1: " d", 2: None, 3: "m x"}
    audit = texts.price_audit(rows)
    assert audit["highest"].first().Identifiant_Produit == 3
    assert audit["sentinels"].where("n > 0").first().sentinel == "-1.0"


def test_curves(spark):
    curve = spark.range(256).selectExpr("id i", "sin(2 * pi() * 5 * id / 256) y")
    assert curves.spectrum(curve, "i", "y", 20)[1].first().k == 5
    assert curves.wavelet_fit(curve, "i", "y").first().residual > 0
    buys = spark.range(50).selectExpr("date_format(timestamp_ntz'2017-01-01 00:00:00' + make_dt_interval(0, cast(id as int)), 'yyyy-MM-dd HH:mm:ss') time", "cast(id * 7 % 11 as double) amount")
    grid = curves.purchase_density(buys, cells=5)
    assert grid.count() == 25 and grid.agg(F.min("x")).first()[0] == 1.0 and grid.where("density <= 0").count() == 0


def test_paragraphs(spark):
    words = ["le", "statut", "de", "la", "société", "Xzq", "anonyme,"]
    data = [(f"f{f}", 0, 100 * p + i, 50.0 * p + i, w) for f in range(2) for p in range(12) for i, w in enumerate(words)]
    tokens = spark.createDataFrame(data, "file string, block long, row long, y0 double, word string")
    known = spark.createDataFrame([(w.strip(","),) for w in words if w != "Xzq"], "word string")
    texts_ = paragraphs.paragraphs(tokens, known)
    assert texts_.count() == 24
    assert {r.text for r in texts_.collect()} == {"le statut de la société anonyme"}
    assert paragraphs.paragraphs(tokens, known).exceptAll(texts_).count() == 0
    rows = texts_.withColumn("id", F.concat("file", "paragraph")).cache()
    varied = rows.withColumn("text", F.concat("text", F.when(F.col("paragraph") % 2 == 0, F.lit(" capital actions parts")).otherwise(F.lit(" gérant assemblée vote"))))
    assert paragraphs.topics(varied, "id", k=2, words=3, min_df=2).count() == 6
    assert paragraphs.factors(varied, "id", k=2, words=3, min_df=2, max_iter=5).count() == 6
    vectors = paragraphs.text_vectors(varied, "id", size=6, min_count=1)
    assert paragraphs.cluster_sweep(vectors, ks=[2]).first().silhouette > 0.9


def test_speech(spark):
    samples = spark.range(2000).selectExpr("'1' file_id", "id i", "sin(id / 3) x")
    segments = spark.createDataFrame([("1", 0.0, 0.5), ("1", 0.4, 0.9)], "file_id string, start double, end double")
    out = speech.labelled_examples(samples, segments, rate=1000.0, nperseg=64).orderBy("example").collect()
    # examples of 96 samples; speech until sample 900 fills nine and a bit
    assert [r.label for r in out][:9] == [1] * 9 and not any(r.label for r in out[10:])
    assert len(out[0].power) == 3 and len(out[0].power[0]) == 33
    noisy = speech.labelled_examples(samples, segments, 1000.0, 64, noise_seed=1)
    assert noisy.count() == len(out)
    raw = speech.raw_examples(samples, segments, 1000.0)
    assert raw.count() == 100 and raw.agg(F.sum("label")).first()[0] == 45
    a = spark.createDataFrame([("1",), ("2",)], "stem string")
    assert speech.check_pairs(a, a.limit(1)).first().asDict() == {"paired": 1, "only_left": 1, "only_right": 0}
