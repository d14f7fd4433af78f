"""What a client pays more than others for a like shipment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numeric import bin_by, guarded_ratio
from grainfold.operators import encode, learn, lookup, split

PEER = [
    "FlownMonth", "OriginCode", "CargoType", "ProductCode", "SpecialHandlingCodeList", "CommodityCode",
    "BinnedWeight", "BinnedPieces",
]


def prepare(shipments: DataFrame, order: str) -> DataFrame:
    """One code per agent name, per-piece weight and revenue, bins, and the deviation from the peers' mean.

    ``order`` tells which code of a name was seen first.
    """
    rows = shipments.drop("FlownYear", "DestinationCode").where(F.col("Revenue") != 0)
    rows = lookup.use_canonical_code(rows, "AgentName", "AgentCode", order)
    rows = rows.withColumns({
        "WeightPerPiece": guarded_ratio(F.col("ChargeableWeight"), F.col("Pieces")),
        "RevenuePerPiece": guarded_ratio(F.col("Revenue"), F.col("Pieces")),
    }).withColumns({
        "BinnedWeight": bin_by(F.col("WeightPerPiece"), [100, 1000]),
        "BinnedPieces": bin_by(F.col("Pieces"), [5, 20]),
    })
    return lookup.peer_deviation(rows, "RevenuePerPiece", PEER, "Willingness")


def agent_willingness(prepared: DataFrame) -> DataFrame:
    """Mean deviation per agent and kind of shipment."""
    keys = ["AgentCode", *PEER]
    return prepared.dropna(subset=keys).groupBy(*keys).agg(F.avg("Willingness").alias("Willingness"))


def willingness_search(prepared: DataFrame, key: str, grid: dict, models: int = 5, folds: int = 7) -> DataFrame:
    """Leaderboard of boosted trees on the deviation, best first.

    ``grid`` maps maxIter, maxDepth, stepSize and so on to their choices;
    ``models`` of the combinations are tried on ``folds`` folds dealt out by key.
    """
    from pyspark.ml.evaluation import RegressionEvaluator

    rows = prepared.select(key, "WeightPerPiece", "Pieces", F.col("Willingness").alias("label")).dropna()
    rows = split.hash_fold(encode.assemble(rows, [key, "label"]), key, folds)
    trees = learn.boosted_regressor()
    chosen = learn.random_grid(learn.full_grid(trees, grid), models, seed=1)
    fitted = learn.tune(trees, chosen, RegressionEvaluator(metricName="rmse"), folds, "fold").fit(rows)
    return learn.tuning_table(fitted, prepared.sparkSession)
