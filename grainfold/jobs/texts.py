"""Category of shop texts, product texts and legal texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions import text as t
from grainfold.operators import clean, evaluate, profile, split, textmodel

# fixed values: weights of the legal classes
LEGAL_WEIGHTS = {"CIV": 1, "COM": 10, "CRIM": 10, "SOC": 1}


def shop_rows(rows: DataFrame) -> DataFrame:
    """Descriptions without the control character and their last three tokens."""
    return rows.withColumn("text", t.drop_last_tokens(F.col("description")))


def product_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sets without repeated header rows; text = brand and description."""
    rows = clean.drop_header_rows(train.unionByName(test, allowMissingColumns=True), "Produit_Cdiscount")
    return rows.fillna({"Marque": ""}).withColumn("text", F.concat("Marque", F.lit(" "), "Description"))


def price_audit(rows: DataFrame) -> dict[str, DataFrame]:
    """How often a price is a sentinel, rows with the highest price, and known values per column."""
    price = F.col("prix").try_cast("double")
    top = rows.select(F.max(price)).scalar()
    return {
        "sentinels": clean.sentinel_audit(rows, "prix", clean.PRICE_SENTINELS),
        "highest": rows.where(price == top),
        "known": profile.completeness(rows),
    }


def category_model(
    rows: DataFrame, key: str, label: str, weights: Mapping | None = None, min_df: float = 1, ngrams: int = 2, stop: list[str] = (), alpha: float = 1e-3, epochs: int = 10,
) -> tuple[textmodel.TextSvm, DataFrame]:
    """SVM on TF-IDF of words and pairs, and the class report on the test rows."""
    known = rows.where(F.col(label).isNotNull() & F.col("text").isNotNull())
    known = split.hash_split(known, key, {"train": 70, "valid": 15, "test": 15})
    model = textmodel.fit_text_svm(known.where("part = 'train'"), key, "text", label, weights, alpha, epochs, ngrams, min_df=min_df, stop=stop)
    test = known.where("part = 'test'")
    scored = test.join(textmodel.predict_text(model, test, key, "text"), key)
    return model, evaluate.classification_report(scored, label, "prediction")


def search_category_model(rows: DataFrame, key: str, label: str, weights: Mapping | None = None, min_df: float = 1, stop: list[str] = ()) -> DataFrame:
    """Accuracy of all combinations of epochs, n-grams, IDF and penalty on the training rows."""
    known = rows.where(F.col(label).isNotNull() & F.col("text").isNotNull())
    train = split.hash_split(known, key, {"train": 70, "valid": 15, "test": 15}).where("part = 'train'")
    return textmodel.text_grid_search(train, key, "text", label, weights, min_df=min_df, stop=stop)


def predict_categories(model: textmodel.TextSvm, rows: DataFrame, key: str) -> DataFrame:
    """(key, predicted) with the category's own name; rows without text go."""
    return textmodel.predict_text(model, rows.where(F.col("text").isNotNull()), key, "text").withColumnRenamed("prediction", "predicted")
