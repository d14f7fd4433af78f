"""Ad margin by operating system, and what brings revenue."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numeric import margin
from grainfold.operators import encode, evaluate, learn, profile, split


def prepare(ads: DataFrame) -> DataFrame:
    """Device filled in, revenue flag, rounded revenue and margin added."""
    return ads.fillna({"user_device": "PersonalComputer"}).withColumns({
        "is_revenue": (F.col("revenue") > 0).cast("int"),
        "round_revenue": F.bround("revenue", 2),
        "margin": margin(F.col("revenue"), F.col("cost")),
    })


def margin_by_system(ads: DataFrame) -> DataFrame:
    """Margin, revenue, cost and profit per operating system."""
    rows = prepare(ads)
    totals = rows.groupBy("user_operating_system").agg(F.sum("margin").alias("margin"))
    money = profile.segment_profit(rows, "user_operating_system", "revenue", "cost")
    return totals.join(money, "user_operating_system")


def correlations(ads: DataFrame) -> DataFrame:
    return profile.corr_matrix(ads, ["average_seconds_played", "cost", "revenue"])


def revenue_forest(ads: DataFrame, key: str = "creative_id", trees: int = 200) -> tuple[Model, DataFrame, DataFrame]:
    """Forest on the revenue flag, its report on the test rows, and feature importances."""
    rows = encode.category_codes(prepare(ads), ["user_operating_system", "user_device"])
    rows = rows.withColumn("label", F.col("is_revenue").cast("double"))
    hidden = [key, "label", "is_revenue", "revenue", "round_revenue", "margin"]
    names = encode.feature_columns(rows, hidden)
    rows = split.hash_split(encode.assemble(rows, hidden), key, {"train": 70, "valid": 15, "test": 15})
    model = learn.forest_classifier(trees).fit(rows.where("part = 'train'"))
    report = evaluate.classification_report(model.transform(rows.where("part = 'test'")), "label", "prediction")
    return model, report, evaluate.importance_table(model, names, ads.sparkSession)
