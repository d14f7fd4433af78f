"""Bike demand by time and weather."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.dates import calendar_parts
from grainfold.operators import encode, evaluate, learn, profile, split

# fixed values: columns of the rental table, and those that the job adds
TIME_FACTORS = ["year", "season", "month", "day", "hour", "holiday", "workingday"]
WEATHER_FACTORS = ["weather", "temp", "atemp", "atempdiff", "humidity", "windspeed"]
COUNTS = ["casual", "registered", "count"]


def prepare(rentals: DataFrame) -> DataFrame:
    """Calendar parts (``day`` is the weekday) and the felt temperature difference."""
    parts = calendar_parts(F.col("datetime"))
    return rentals.withColumns({
        "year": parts["year"], "month": parts["month"], "day": parts["weekday"], "hour": parts["hour"],
        "atempdiff": F.col("temp") - F.col("atemp"),
    })


def demand_profile(rentals: DataFrame) -> DataFrame:
    """Mean casual, registered and total rentals for every level of every factor."""
    return profile.profile_by_factor(prepare(rentals), TIME_FACTORS + WEATHER_FACTORS, COUNTS)


def correlations(rentals: DataFrame) -> DataFrame:
    # fixed values: columns of the rental table
    columns = ["temp", "atemp", "casual", "registered", "humidity", "windspeed", "count", "atempdiff"]
    return profile.corr_matrix(prepare(rentals), columns)


def demand_forest(rentals: DataFrame, trees: int = 200) -> tuple[Model, DataFrame, DataFrame]:
    """Forest on the count, its error on test and validation rows, and feature importances."""
    rows = prepare(rentals).withColumn("label", F.col("count").cast("double"))
    # fixed values: columns that no forest may see
    hidden = ["datetime", "temp", "casual", "registered", "count", "label"]
    names = encode.feature_columns(rows, hidden)
    rows = split.hash_split(encode.assemble(rows, hidden), "datetime", {"train": 70, "valid": 15, "test": 15})
    model = learn.forest_regressor(trees).fit(rows.where("part = 'train'"))
    errors = None
    for part in ("test", "valid"):
        row = evaluate.regression_report(model.transform(rows.where(F.col("part") == part)), "label", "prediction")
        row = row.withColumn("part", F.lit(part))
        errors = row if errors is None else errors.unionByName(row)
    return model, errors, evaluate.importance_table(model, names, rentals.sparkSession)
