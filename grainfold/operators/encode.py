"""Category codes, one-hot columns, weights, feature assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainfold.operators.clean import attach
from grainfold.operators.ordered import OrderedGroups
from grainfold.session import stored


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values of columns of one type with their alphabetical number from 0: (column, value, code).

    One pass over the rows for all columns.
    """
    long = df.select(*columns).unpivot([], list(columns), "column", "value")
    values = stored(long.where(F.col("value").isNotNull()).distinct())
    ranked = OrderedGroups(values, ["column"], ["value"]).position("_pos").frame()
    return ranked.select("column", "value", (F.col("_pos") - 1).cast("int").alias("code"))


def category_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Alphabetical integer code of every category column; NULL becomes -1."""
    by_type = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for same in by_type.values():
        index = stored(category_index(df, same))
        for c in same:
            codes = index.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(c + suffix))
            df = df.join(codes, c, "left").withColumn(c + suffix, F.coalesce(c + suffix, F.lit(-1)))
    return df


def one_hot(df: DataFrame, column: str, levels: Sequence, drop=None) -> DataFrame:
    """A 0/1 column ``<column>_<level>`` per level, except the dropped one; NULL is 0 everywhere.

    Numbers are written without a trailing ``.0``, and other dots as ``_``.
    """
    flags = {}
    for v in levels:
        if v != drop:
            name = f"{v:g}" if isinstance(v, float) else str(v)
            flag = F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
            flags[f"{column}_{name}".replace(".", "_")] = flag
    return df.withColumns(flags)


def levels(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """The levels of a category column in alphabetical order, as driver-side names for columns."""
    found = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels; use category_codes")
    return sorted(found)


def label_indexer(train: DataFrame, label: str, out: str = "label") -> StringIndexerModel:
    """Alphabetical label index fitted on the training rows; unseen labels become the extra index."""
    return StringIndexer(
        inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(train)


def class_weight(df: DataFrame, label: str, weights: Mapping | None = None, name: str = "weight") -> DataFrame:
    """Weight per row: from a fixed map (1 if absent), or one over the class size."""
    if weights is None:
        sizes = df.groupBy(label).agg((1.0 / F.count(F.lit(1))).alias(name))
        return attach(df, sizes, [label])
    pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
    looked_up = F.try_element_at(F.create_map(*pairs), F.col(label))
    return df.withColumn(name, F.coalesce(looked_up, F.lit(1.0)))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric and boolean columns that are not excluded, in table order."""
    return [
        f.name for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def assemble(df: DataFrame, exclude: Sequence[str], out: str = "features") -> DataFrame:
    """Put the feature columns into one vector; rows with a NULL feature go."""
    columns = feature_columns(df, exclude)
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="skip").transform(df)
