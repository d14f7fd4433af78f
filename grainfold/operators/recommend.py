"""Recommendation by tag profile, genre rule and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions.text import genre_score, title_year
from grainfold.operators.profile import minmax_norm
from grainfold.session import stored


def tag_profile(tags: DataFrame, item: str, tag: str) -> DataFrame:
    """Share of each lower-cased tag among an item's tags: (item, tag, freq)."""
    counts = tags.groupBy(item, F.lower(tag).alias(tag)).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(item).agg(F.sum("_n").alias("_all"))
    return counts.join(totals, item).select(item, tag, (F.col("_n") / F.col("_all")).alias("freq"))


def tag_similarity(tags: DataFrame, item: str, tag: str, anchor) -> DataFrame:
    """How far an item's tags are those of the anchor: (item, tag_score), the anchor left out.

    Sum over tags of the tag's share in the item times its share in the anchor;
    an item without a common tag gets 0.
    """
    counts = tags.groupBy(item, F.lower(tag).alias(tag)).agg(F.count(F.lit(1)).alias("_n"))
    of_anchor = counts.where(F.col(item) == F.lit(anchor)).select(tag, F.col("_n").alias("_a"))
    total = of_anchor.select(F.sum("_a")).scalar()
    scored = counts.where(F.col(item) != F.lit(anchor)).join(of_anchor, tag, "left")
    hits = F.sum(F.col("_n") * F.coalesce("_a", F.lit(0)))
    return scored.groupBy(item).agg((hits / F.sum("_n")).alias("_hits")).select(
        item, F.coalesce(F.try_divide(F.col("_hits"), total), F.lit(0.0)).alias("tag_score")
    )


def avg_rating(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    return ratings.groupBy(item).agg(F.avg(rating).alias("rating_score"))


def liked_together(ratings: DataFrame, user: str, item: str, rating: str, anchor, full: float = 5.0) -> DataFrame:
    """Items given the full rating by a user who gave it to the anchor too."""
    top = ratings.where(F.col(rating) == full)
    fans = top.where(F.col(item) == F.lit(anchor)).select(user).distinct()
    return top.join(fans, user, "left_semi").select(item).distinct()


def rank_items(
    items: DataFrame, tag_scores: DataFrame, liked: DataFrame, rated: DataFrame, anchor,
    item: str, title: str, genres: str, floor: float, k: int, genre=genre_score, need_year: bool = False,
) -> DataFrame:
    """The k best items: genre rule plus tag score scaled to 0..1, among liked and well-rated items."""
    described = items.where(F.col(item) != F.lit(anchor))
    if need_year:
        described = described.where(title_year(F.col(title)).isNotNull())
    described = described.select(item, title, genre(F.col(genres)).alias("_genre"))
    scaled = minmax_norm(stored(tag_scores), "tag_score", "_tag").select(item, "_tag")
    return (
        described.join(liked, item, "left_semi")
        .join(scaled, item)
        .join(rated.where(F.col("rating_score") > floor), item)
        .select(item, title, (F.col("_genre") + F.col("_tag")).alias("score"), "rating_score")
        # scores that differ by rounding noise only count as equal
        .orderBy(F.round("score", 9).desc(), item)
        .limit(k)
    )


def recommend(
    items: DataFrame, tags: DataFrame, ratings: DataFrame, anchor,
    item: str = "movieId", title: str = "title", genres: str = "genres", user: str = "userId", tag: str = "tag",
    rating: str = "rating", floor: float = 3.02, full: float = 5.0, k: int = 30, need_year: bool = False,
) -> DataFrame:
    """Items to suggest after the anchor, best first: what its fans also gave the full rating."""
    return rank_items(
        items, tag_similarity(tags, item, tag, anchor),
        liked_together(ratings, user, item, rating, anchor, full), avg_rating(ratings, item, rating),
        anchor, item, title, genres, floor, k, need_year=need_year,
    )
