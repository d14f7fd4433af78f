"""Passenger list: quality audit, features, survival forest."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions import text
from grainfold.operators import clean, encode, evaluate, learn, profile, split

FEATURES = ["Age", "FareByPassenger", "Pclass", "FamilySize", "SexBinary", "Embarked_C", "Embarked_Q", "Embarked_S"]


def prepare(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sets: clean names, titles, filled ports, fares and ages, family size and fare per person."""
    rows = train.unionByName(test, allowMissingColumns=True)
    name = text.clean_quotes(F.col("Name"))
    rows = rows.withColumn("Name", name).withColumns({
        "TicketNumber": text.part(F.col("Ticket"), " ", -1),
        "ConsistentSex": text.title_agrees(F.col("Name"), F.col("Sex")),
        "Surname": F.trim(text.part(F.col("Name"), ",", 0)),
        "Title": text.title_bucket(F.col("Name")),
        "ChangedName": F.col("Name").contains("(").cast("int"),
    })
    rows = clean.group_size(rows, ["Surname"], "SurnameCount")
    rows = clean.impute_group_mode(rows, "Embarked", ["Sex", "Pclass", "SibSp"])
    rows = clean.impute_group_mean(rows, ["Fare"], ["Sex", "Pclass", "Embarked", "SibSp"])
    rows = clean.impute_group_mean(rows, ["Age"], ["Sex", "Pclass", "Embarked"])
    rows = clean.group_size(rows, ["TicketNumber"], "NbReservations")
    rows = encode.one_hot(rows, "Embarked", ["C", "Q", "S"])
    return rows.withColumns({
        "SexBinary": (F.col("Sex") == "male").cast("int"),
        "FamilySize": F.col("SibSp") + F.col("Parch") + F.lit(1.0),
        "FareByPassenger": F.try_divide("Fare", "NbReservations"),
    })


def audit(rows: DataFrame) -> dict[str, DataFrame]:
    """Known values per column, frequent surnames, and fares by class."""
    fares = rows.groupBy("Pclass").agg(F.avg("Fare").alias("mean_fare"))
    return {
        "known": profile.completeness(rows),
        "surnames": profile.value_counts(rows, "Surname", 10),
        "fares": fares.join(profile.quantiles(rows, ["Pclass"], "Fare", [0.5]), "Pclass"),
        "ages": profile.histogram(rows, "Age", 0, 90, 9, ["Sex", "Survived"]),
    }


def survival_output(rows: DataFrame, grid: dict, folds: int = 5) -> tuple[Model, DataFrame, DataFrame]:
    """Best forest, class report at 0.5 on the test rows, and (PassengerId, Survived) to hand in."""
    vectors = encode.assemble(
        rows.select("PassengerId", F.col("Survived").cast("double").alias("label"), *FEATURES).fillna({"label": -1.0}),
        ["PassengerId", "label"],
    )
    known = split.hash_split(vectors.where("label >= 0"), "PassengerId", {"train": 55, "valid": 15, "test": 30})
    train = split.hash_fold(known.where("part = 'train'"), "PassengerId", folds)
    forest = learn.forest_regressor()
    tuner = learn.tune(forest, learn.full_grid(forest, grid), RegressionEvaluator(metricName="r2"), folds, "fold")
    best = tuner.fit(train.select("label", "features", "fold")).bestModel
    scored = best.transform(known.where("part = 'test'")).withColumn("said", (F.col("prediction") > 0.5).cast("double"))
    report = evaluate.classification_report(scored, "label", "said")
    return best, report, learn.predict_output(best, vectors.where("label < 0"), "PassengerId", "Survived")
