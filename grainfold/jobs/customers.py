"""Churn and newsletter opens: both sets cleaned together, tuned, predicted."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numeric import safe_double
from grainfold.operators import clean, encode, learn, split

CHURN_CATEGORIES = [f"feature{i}" for i in range(1, 16)]


def churn_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sets with category codes; a charge total that is no number becomes feature17 * feature18."""
    rows = clean.union_flagged({0: train, 1: test}, "test")
    rows = rows.withColumn("feature16", safe_double(F.col("feature16"), F.col("feature17") * F.col("feature18")))
    return encode.category_codes(rows, CHURN_CATEGORIES).drop(*CHURN_CATEGORIES)


def churn_output(rows: DataFrame, grid: dict, label: str = "Churn", yes: str = "Yes", models: int = 5, folds: int = 7) -> tuple[DataFrame, DataFrame]:
    """Leaderboard by log loss, and (id, output) for the test rows from the best set refitted on all."""
    rows = rows.withColumn("label", (F.col(label) == yes).cast("double"))
    rows = encode.assemble(rows, ["id", "test", label, "label"])
    known = split.hash_fold(rows.where("test = 0"), "id", folds).select("id", "label", "features", "fold")
    trees = learn.boosted_classifier()
    chosen = learn.random_grid(learn.full_grid(trees, grid), models, seed=1)
    judge = MulticlassClassificationEvaluator(metricName="logLoss")
    fitted = learn.tune(trees, chosen, judge, folds, "fold").fit(known)
    table = learn.tuning_table(fitted, rows.sparkSession)
    return table, learn.predict_output(fitted.bestModel, rows.where("test = 1"), "id", probability=True)


def newsletter_rows(sent: DataFrame, recipients: DataFrame) -> DataFrame:
    """Both sets; -1 is missing and takes the rounded mean of the same e-mail domain and gender."""
    rows = sent.unionByName(recipients, allowMissingColumns=True)
    rows = clean.sentinels_to_null(rows, -1)
    return clean.impute_group_mean(rows, ["open_rate", "geo", "device"], ["email", "gender"], half_even=True)


def newsletter_output(rows: DataFrame, grid: dict, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Leaderboard by log loss, and (id, open) for the recipients."""
    for c in ("email", "gender", "geo", "device"):
        rows = encode.one_hot(rows, c, encode.levels(rows, c))
    rows = rows.drop("email", "gender", "geo", "device").withColumn("label", F.col("open").cast("double"))
    hidden = ["id", "open", "label"]
    known, unknown = clean.split_labelled(rows, "open")
    forest = learn.forest_classifier()
    judge = MulticlassClassificationEvaluator(metricName="logLoss")
    tuner = learn.tune(forest, learn.full_grid(forest, grid), judge, folds, "fold")
    fitted = tuner.fit(split.hash_fold(encode.assemble(known, hidden), "id", folds).select("id", "label", "features", "fold"))
    out = learn.predict_output(fitted.bestModel, encode.assemble(unknown, hidden), "id", "open")
    return learn.tuning_table(fitted, rows.sparkSession), out
