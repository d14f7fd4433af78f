"""Writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, names: Mapping[str, str] | None = None, sep: str = ",") -> None:
    """Write a folder of delimited files with a header; ``names`` picks and renames columns."""
    if names:
        df = df.select(*[F.col(c).alias(n) for c, n in names.items()])
    df.write.mode("overwrite").option("sep", sep).option("header", True).option("escape", '"').csv(path)


def save_model(model: PipelineModel | Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
