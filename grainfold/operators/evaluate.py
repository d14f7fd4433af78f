"""Scores of predictions, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.operators.ordered import OrderedGroups


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): the one pass over the rows that the class report needs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and the accuracy on every row; 0 where undefined."""
    table = confusion(df, label, prediction)
    # each cell counts once for its true and once for its predicted class
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("true_n"), F.lit(0).cast("long").alias("said_n")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("true_n"), F.col("n").alias("said_n")),
    )
    cells = table.select(
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"), F.inline(sides)
    )
    hits, true_n, said_n = F.sum("hit") / 2, F.sum("true_n"), F.sum("said_n")
    zero = F.lit(0.0)
    accuracy = table.select(
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")
    ).scalar()
    return cells.groupBy("class").agg(
        F.coalesce(F.try_divide(hits, said_n), zero).alias("precision"),
        F.coalesce(F.try_divide(hits, true_n), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * hits, true_n + said_n), zero).alias("f1"),
        true_n.alias("support"),
    ).withColumn("accuracy", accuracy)


def regression_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """n, MSE, RMSE, MSLE, RMSLE, MAE and R squared in one pass; logs need values above -1."""
    y, p = F.col(truth), F.col(prediction)
    gap, log_gap = p - y, F.log1p(p) - F.log1p(y)
    mse, msle = F.avg(gap * gap), F.avg(log_gap * log_gap)
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        msle.alias("msle"), F.sqrt(msle).alias("rmsle"), F.avg(F.abs(gap)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
    )


def log_loss(df: DataFrame, label: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """Mean negative log likelihood of a 0/1 label under the probability of 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    return df.agg((-F.avg(F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p)))).alias("log_loss"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of a 0/1 label, ties counted half.

    Rows are first counted per distinct score; the running total over scores is
    the only ordered step, and is itself split.
    """
    counts = df.groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    run = OrderedGroups(counts, [], ["_score"]).running_sum("_below", F.col("_neg")).frame()
    wins = F.col("_pos") * (F.col("_below") - F.col("_neg") / 2)
    return run.agg(F.try_divide(F.sum(wins), F.sum("_pos") * F.sum("_neg").cast("double")).alias("auc"))


def importance_table(model, names: Sequence[str], spark) -> DataFrame:
    """Importance of every feature with its share of the largest and its deviation across trees."""
    import numpy as np

    total = model.featureImportances.toArray()
    trees = np.array([t.featureImportances.toArray() for t in model.trees])
    top = total.max() or 1.0
    rows = [
        (n, float(v), float(v / top), float(s)) for n, v, s in zip(names, total, trees.std(axis=0))
    ]
    return spark.createDataFrame(
        rows, "feature string, importance double, scaled double, tree_std double"
    ).orderBy(F.desc("importance"), "feature")
