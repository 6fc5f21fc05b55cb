"""Moments of the numbers of common items over all pairs of users, without pairing users where pairing items is less work.

With ``c(u, v)`` the common items of two users, and ``d(i, j)`` the common raters of two items, the squares of all ``c`` add up to the same as
those of all ``d``: both count the two users and two items with all four ratings. The ``c`` themselves add up to the squares of the items' numbers
of raters. So mean and deviation of the overlaps follow from the degrees and from the pairs on either side. Pairs are formed
on the side where the squares of the degrees, which is the number of matches, add up to less: with few items and many users, that is pairs of
items. Only the smallest and the largest overlap need pairs of users.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.blocks import dealt, group_self_join, measure_groups
from kindred.params import BLOCK_ROWS


@dataclass(frozen=True)
class Degrees:
    """Of one side: how many there are, and the sums of their degrees and of the squares."""

    count: int
    total: float
    squares: float


def degrees(ratings: DataFrame, key: str) -> Degrees:
    n = F.col("n")
    sizes = ratings.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("n"))
    row = sizes.agg(F.count(n).alias("count"), F.coalesce(F.sum(n), F.lit(0.0)).alias("total"), F.coalesce(F.sum(n * n), F.lit(0.0)).alias("squares"))
    return Degrees(**row.first().asDict())


def squared_overlaps(ratings: DataFrame, group: str, member: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row ``(squares)``: the squares of the numbers of common groups, added up over all ordered pairs of members, with themselves included."""
    rows = ratings.select(F.col(group).alias("shared"), F.col(member).alias("member"))
    groups = measure_groups("shared", rows, block_rows=block_rows)
    matches = group_self_join(rows, groups, "member")
    low, high = F.least("member_l", "member_r").alias("low"), F.greatest("member_l", "member_r").alias("high")
    counted = dealt(matches.select(low, high), groups.self_matches, "low", "high").groupBy("low", "high").agg(F.count(F.lit(1)).cast("double").alias("n"))
    squared = F.col("n") * F.col("n")
    both_orders = F.when(F.col("low") == F.col("high"), squared).otherwise(2 * squared)
    return counted.agg(F.coalesce(F.sum(both_orders), F.lit(0.0)).alias("squares"))


def overlap_moments(ratings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(pairs_all, avg_overlap, stddev_overlap, paired)`` over all pairs ``u <= v`` of the users of ``ratings``, which has one row per user and item.

    ``paired`` tells which side was paired, ``items`` or ``users``. Without users, the moments are null."""
    items, users = degrees(ratings, "item_id"), degrees(ratings, "user_id")
    by_items = users.squares < items.squares
    group, member = ("user_id", "item_id") if by_items else ("item_id", "user_id")
    # Ordered pairs are the unordered ones twice, less the pairs of a user with itself, whose overlap is the user's number of items.
    pairs = users.count * (users.count + 1) // 2
    mean = F.try_divide(F.lit((items.squares + users.total) / 2), F.lit(float(pairs)))
    square = F.try_divide((F.col("squares") + F.lit(users.squares)) / 2, F.lit(float(pairs)))
    return squared_overlaps(ratings, group, member, block_rows).select(
        F.lit(pairs).cast("long").alias("pairs_all"),
        mean.alias("avg_overlap"),
        F.when(mean.isNotNull(), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))).alias("stddev_overlap"),
        F.lit("items" if by_items else "users").alias("paired"),
    )
