"""Flight searches and bookings: features, booking classifier, fare forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions import dates, numeric, text
from grainfold.operators import clean, encode, evaluate, learn, lookup, split

# fixed values: search column names and the booking names they stand for
SEARCH_NAMES = {"search_id": "booking_id", "search_user_id": "booking_user_id", "search_time": "booking_time"}
MISSPELT = {"arrial_datetime_2": "arrival_datetime_2"}

SHARES = {"train": 36, "valid": 24, "test": 40}


def merge_sources(searches: DataFrame, bookings: DataFrame, only_bookers: bool = False) -> DataFrame:
    """Distinct searches (booked = 0) and bookings (booked = 1) in their common columns.

    ``only_bookers`` keeps the searches of users who booked at least once.
    """
    booked = bookings.dropDuplicates().withColumnsRenamed(MISSPELT).withColumn("booked", F.lit(1.0))
    seen = searches.dropDuplicates().withColumnsRenamed(SEARCH_NAMES).withColumn("booked", F.lit(0.0))
    if only_bookers:
        seen = lookup.keep_matching(seen, booked.select("booking_user_id"), "booking_user_id")
    return clean.union_common(booked, seen)


def fare_features(rows: DataFrame, rates: DataFrame, return_column: str = "arrival_datetime_1") -> DataFrame:
    """Euro fare, calendar, distance and itinerary features; unknown currencies and empty trips go.

    The return leg is read from the outbound arrival unless told otherwise.
    """
    rows = rows.where(F.col("passengers") != 0).withColumn(
        "cabin_class", numeric.remap(F.col("cabin_class"), clean.CABIN_CLASSES)
    )
    rows = lookup.rate_lookup(rows, clean.normalise_names(rates), "currency", "exchange")
    asked = dates.parse_ts(F.col("booking_time"))
    out, back = dates.first_leg(F.col("departure_datetime_1")), dates.first_leg(F.col(return_column))
    asked_parts, out_parts, back_parts = map(dates.calendar_parts, (asked, out, back))
    return rows.withColumns({
        "fare_eur": F.try_divide("fare", "exchange"),
        "days_to_departure": dates.days_until(out, asked),
        "search_day_of_year": asked_parts["day_of_year"],
        "search_day_of_week": asked_parts["weekday"],
        "departure_day_of_year": out_parts["day_of_year"],
        "departure_day_of_week": out_parts["weekday"],
        "days_to_return": dates.days_until(back, asked, zero_if_past_year=True),
        "return_day_of_year": back_parts["day_of_year"],
        "return_day_of_week": back_parts["weekday"],
        "has_return": F.col(return_column).isNotNull().cast("double"),
        "nb_flights_departure": text.list_size(F.col("flight_num_1"), ";"),
        "nb_flights_return": text.list_size(F.col("flight_num_2"), ";"),
        "distance_code": text.pair_code(F.col("origin"), F.col("destination")),
    })


def airport_places(airports: DataFrame) -> DataFrame:
    """(iata_code, coord) with the coordinates joined by ``;``."""
    return airports.select("iata_code", F.concat_ws(";", "lat", "lon", "alt").alias("coord"))


def _vectors(features: DataFrame, label: str, drop: Sequence[str] = ("booking_id", "booked", "fare_eur")) -> DataFrame:
    found = encode.levels(features, "cabin_class")
    wide = encode.one_hot(features, "cabin_class", found, drop="mixed")
    rows = encode.assemble(wide.withColumn("label", F.col(label).cast("double")), [*drop, "label", "exchange", "fare"])
    return split.hash_split(rows.select("booking_id", "label", "features"), "booking_id", SHARES)


def booking_classifier(features: DataFrame, booked_weight: float = 30.0) -> tuple[Model, DataFrame]:
    """Linear SVM on whether a search is booked, and its class report on the validation rows."""
    rows = _vectors(features.withColumn("fare", F.col("fare_eur")), "booked", ("booking_id", "booked"))
    rows = encode.class_weight(rows, "label", {1.0: booked_weight, 0.0: 1.0})
    model = learn.linear_svm("weight").fit(rows.where("part = 'train'"))
    return model, evaluate.classification_report(model.transform(rows.where("part = 'valid'")), "label", "prediction")


def fare_forest(features: DataFrame, trees: int = 100) -> tuple[Model, DataFrame]:
    """Forest on the euro fare, and its error on the validation rows."""
    rows = _vectors(features, "fare_eur")
    model = learn.forest_regressor(trees).fit(rows.where("part = 'train'"))
    return model, evaluate.regression_report(model.transform(rows.where("part = 'valid'")), "label", "prediction")
