"""Product images by class folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfold.operators import split
from grainfold.sources.readers import labelled_images


def training_images(spark: SparkSession, path: str, limit: int = 800, minimum: int = 1) -> DataFrame:
    """Readable images, at most ``limit`` per class; fails if a class has fewer than ``minimum``."""
    images = labelled_images(spark, path).withColumn("origin", F.col("image.origin"))
    short = split.class_shortfall(images, "label", minimum).limit(10).collect()
    if short:
        raise ValueError(f"classes with fewer than {minimum} images: {[r['label'] for r in short]}")
    return split.cap_per_class(images, "label", "origin", limit)
