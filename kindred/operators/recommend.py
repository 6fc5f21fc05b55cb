"""Best unseen items for one user. Only that user's similarities are computed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import denormalized, normalized, rounded_similarity, safe_ratio
from kindred.operators.normalize import mean_rating, unique_ratings
from kindred.operators.predict import neighbour_weights, weighted_sums
from kindred.params import BROADCAST_ROWS, PREDICTION_DECIMALS, RATING_HI, RATING_LO, RECOMMEND_K_VALUES, TOP_N


def with_personal(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """All ratings, with one per user and item also if the personal user is among the others."""
    return unique_ratings(ratings.unionByName(personal))


def rated_items(personal: DataFrame) -> DataFrame:
    return personal.select("item_id")


def unrated_items(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """The rated items of all users that the personal user has not rated."""
    return ratings.select("item_id").distinct().join(rated_items(personal), "item_id", "left_anti")


def small(df: DataFrame, rows: int) -> DataFrame:
    """A side of a join of which ``rows`` is an upper bound: broadcast if that is few, else left to a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def personal_similarities(
    others: DataFrame, mine: DataFrame, n_mine: int, stats: DataFrame, user_id: int, lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """``(u, v, sim)`` of one user ``u``, who has the ``n_mine`` ratings ``mine``, with every user ``v`` of the others who shares an
    item. The ratings are reduced to the user's items before anything else happens to them.
    """
    unit = safe_ratio(normalized(F.col("rating"), F.col("user_avg"), lo, hi), F.col("norm"))
    own = mine.join(stats, "user_id").select("item_id", unit.alias("my_pre"))
    shared = others.join(small(own, n_mine), "item_id")
    dot = rounded_similarity(F.sum(unit * F.col("my_pre")))
    return (
        shared.join(stats, "user_id")
        .groupBy(F.col("user_id").alias("v"))
        .agg(dot.alias("sim"))
        .where(F.col("sim") != 0)
        .select(F.lit(user_id).cast("int").alias("u"), "v", "sim")
    )


def personal_predictions(
    others: DataFrame,
    mine: DataFrame,
    stats: DataFrame,
    neighbours: DataFrame,
    user_id: int,
    k_values: Sequence[int] = RECOMMEND_K_VALUES,
    lo: float = RATING_LO,
    hi: float = RATING_HI,
) -> DataFrame:
    """``(item_id, k<k>...)``: the user's predicted rating of each unseen item for each k.

    ``neighbours`` are those of this one user: at most ``max(k_values)`` rows.
    """
    near = neighbours.join(stats.select(F.col("user_id").alias("v"), "user_avg"), "v")
    dev = normalized(F.col("rating"), F.col("user_avg"), lo, hi)
    evidence = others.withColumnRenamed("user_id", "v").join(small(near, max(k_values)), "v").withColumn("dev", dev)
    weights = neighbour_weights(k_values)
    own = stats.where(F.col("user_id") == user_id).agg(F.max("user_avg").alias("own")).scalar()
    mean = F.col("own_avg")
    return (
        unrated_items(others, mine)
        .join(weighted_sums(evidence, ["item_id"], weights), "item_id", "left")
        .withColumn("own_avg", F.coalesce(own, mean_rating(stats)))
        .select(
            "item_id",
            *[denormalized(mean, safe_ratio(F.col(f"{w}_num"), F.col(f"{w}_den")), lo, hi).alias(w) for w in weights],
        )
    )


def with_title(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach the title; an item that is not in the catalog gets an empty one."""
    return rows.join(catalog, "item_id", "left").withColumn("title", F.coalesce("title", F.lit("")))


def best_items(
    predicted: DataFrame, k_values: Sequence[int] = RECOMMEND_K_VALUES, n: int = TOP_N, decimals: int = PREDICTION_DECIMALS
) -> DataFrame:
    """``(k, position, item_id, prediction)``: the ``n`` best items per k, ties to the smallest id.

    Predictions are compared after rounding to ``decimals``: the order in which sums arrive makes no difference.
    The rank limit applies within each task before the shuffle, so the two groups stay small.
    """
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.round(f"k{k}", decimals).alias("prediction")) for k in k_values])
    order = Window.partitionBy("k").orderBy(F.desc("prediction"), "item_id")
    return (
        predicted.select("item_id", F.inline(each))
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= n)
        .select("k", "position", "item_id", "prediction")
    )


def items_at_maximum(
    predicted: DataFrame, k: int, hi: float = RATING_HI, n: int = TOP_N, decimals: int = PREDICTION_DECIMALS
) -> DataFrame:
    """``(item_id, prediction)``: the first ``n`` items by id predicted to get the highest rating, up to ``decimals``."""
    return (
        predicted.select("item_id", F.round(f"k{k}", decimals).alias("prediction"))
        .where(F.col("prediction") == F.lit(hi))
        .orderBy("item_id")
        .limit(n)
    )
