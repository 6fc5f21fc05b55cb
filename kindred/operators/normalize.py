"""Means, norms and normalized ratings.

Inputs are ratings ``(user_id, item_id, rating)`` with one row per user and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import normalized, safe_ratio, scale
from kindred.params import RATING_HI, RATING_LO


def unique_ratings(ratings: DataFrame) -> DataFrame:
    """One row per user and item: the highest rating wins."""
    return ratings.groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))


def global_avg(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.avg("rating").alias("global_avg"))


def user_stats(ratings: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """``(user_id, n_items, user_avg, norm)`` per user; ``norm`` is the L2 norm of the deviations.

    The deviations depend on the mean, so the ratings are needed twice. They are counted per user and
    rating value first: the counts are combined before the shuffle, so a user with very many ratings
    sends few rows, and both steps read the counts instead of the ratings.
    """
    return stats_of_counts(rating_counts(ratings), lo, hi)


def rating_counts(ratings: DataFrame) -> DataFrame:
    """``(user_id, rating, n)``: how often each user gave each rating."""
    return ratings.groupBy("user_id", "rating").agg(F.count(F.lit(1)).alias("n"))


def stats_of_counts(counts: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """:func:`user_stats` from the counts."""
    means = counts.groupBy("user_id").agg(
        F.sum("n").alias("n_items"),
        (F.sum(F.col("rating") * F.col("n")) / F.sum("n")).alias("user_avg"),
    )
    dev = normalized(F.col("rating"), F.col("user_avg"), lo, hi)
    return (
        counts.join(means, "user_id")
        .groupBy("user_id", "n_items", "user_avg")
        .agg(F.sqrt(F.sum(dev * dev * F.col("n"))).alias("norm"))
    )


def with_stats(ratings: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the statistics of its user to each rating.

    There is one statistics row per user, so its side is the one to hash, and the ratings need no sort.
    A user with very many ratings makes a skewed partition of ratings only, which adaptive execution
    splits. Without the hint a small ratings table would be broadcast to a few statistics tasks.
    """
    return ratings.join(stats.hint("shuffle_hash"), "user_id")


def normalized_ratings(
    ratings: DataFrame, stats: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """``(user_id, item_id, rating, dev, pre, n_items)``: the rating, its deviation, the same scaled to a unit
    vector per user, and the size of that vector. A user whose ratings are all equal has the zero vector."""
    dev = normalized(F.col("rating"), F.col("user_avg"), lo, hi)
    return with_stats(ratings, stats).select(
        "user_id", "item_id", "rating", dev.alias("dev"), safe_ratio(dev, F.col("norm")).alias("pre"), "n_items"
    )


def rating_scales(
    ratings: DataFrame, stats: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    return with_stats(ratings, stats).select(
        "user_id", "item_id", scale(F.col("rating"), F.col("user_avg"), lo, hi).alias("scale")
    )


def global_deviation_avg(normed: DataFrame) -> DataFrame:
    return normed.agg(F.avg("dev").alias("dev_avg"))


def mean_rating(stats: DataFrame) -> Column:
    """The mean of all ratings as a scalar subquery, from one row per user instead of all ratings."""
    total = F.sum(F.col("user_avg") * F.col("n_items")) / F.sum("n_items")
    return stats.agg(total.alias("global_avg")).scalar()


def with_user_avg(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach ``user_avg`` to each row; a user without ratings gets the mean of all ratings."""
    return rows.join(stats.select("user_id", "user_avg"), "user_id", "left").withColumn(
        "user_avg", F.coalesce("user_avg", mean_rating(stats))
    )
