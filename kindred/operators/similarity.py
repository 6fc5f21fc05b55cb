"""Similarities between users who rated an item in common.

Users without a common item have similarity zero and are never paired: all results over all pairs of
users are derived from the co-rated pairs and the number of users.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import first_of, pair_key, rounded_similarity, second_of, symmetric_pair_key
from kindred.operators.blocks import Groups, dealt, group_join, meet, pair_lists
from kindred.params import BYTES_PER_SIMILARITY


def co_rated_pairs(normed: DataFrame, groups: Groups) -> DataFrame:
    """``(pair, dot, overlap, sizes)`` for ``u <= v`` with a common item, ``u = v`` included.

    ``pair`` is the key of ``u`` and ``v``, ``dot`` is the product of the unit vectors, ``overlap`` the number of common items and ``sizes``
    the sum of both users' numbers of items.
    """
    lists = pair_lists(normed.select("item_id", "user_id", "pre", "n_items"), groups, "user_id")
    return pairs_of_lists(lists, TERMS, groups.self_matches, most_matches(normed, groups))


def pairs_of_lists(lists: DataFrame, terms: Mapping[str, tuple], matches: float, most: float) -> DataFrame:
    """``(pair, <term>...)`` from the lists of matches; a term is what adds it up, and what of a match."""
    found, keys = meet(lists, matches, most)
    summed = found.groupBy(*keys).agg(*[total(term()).alias(name) for name, (total, term) in terms.items()])
    return summed.select(pair_key(F.col("pair_first"), F.col("pair_second")).alias("pair"), *terms)


# How the columns of co_rated_pairs are made of the two sides of a match.
TERMS: dict[str, tuple[Callable[[Column], Column], Callable[[], Column]]] = {
    "dot": (F.sum, lambda: F.col("pre_l") * F.col("pre_r")),
    "overlap": (F.sum, lambda: F.lit(1)),
    "sizes": (F.max, lambda: F.col("n_items_l") + F.col("n_items_r")),
}


def most_matches(normed: DataFrame, groups: Groups) -> int:
    """What no user has more matches than: the largest number of items of a user, times that of raters of an item."""
    return normed.agg(F.coalesce(F.max("n_items"), F.lit(0))).first()[0] * groups.largest


def co_rated_pairs_of(wanted: DataFrame, normed: DataFrame, groups: Groups) -> DataFrame:
    """The co-rated pairs with a user of ``wanted``, as :func:`co_rated_pairs` gives them. ``groups`` has their ratings on the left
    and all ratings on the right."""
    ratings = normed.select("item_id", "user_id", "pre", "n_items")
    asked = wanted.select("user_id", F.lit(True).alias("wanted"))
    left = ratings.join(asked, "user_id", "left_semi")
    right = ratings.join(asked.hint("shuffle_hash"), "user_id", "left").withColumn("wanted", F.col("wanted").isNotNull())
    renamed = lambda df, side: df.withColumnsRenamed({c: f"{c}_{side}" for c in df.columns if c != "item_id"})
    matches = group_join(renamed(left, "l"), renamed(right, "r"), groups, ("user_id_l", "user_id_r"))
    # A pair of two wanted users is met from both sides.
    return _summed(matches.where(~F.col("wanted_r") | (F.col("user_id_l") <= F.col("user_id_r"))), groups.join_matches)


def _summed(matches: DataFrame, n_matches: float) -> DataFrame:
    keyed = matches.select(
        symmetric_pair_key(F.col("user_id_l"), F.col("user_id_r")).alias("pair"),
        (F.col("pre_l") * F.col("pre_r")).alias("product"),
        (F.col("n_items_l") + F.col("n_items_r")).alias("sizes"),
    )
    return dealt(keyed, n_matches, "pair").groupBy("pair").agg(
        F.sum("product").alias("dot"), F.count(F.lit(1)).alias("overlap"), F.max("sizes").alias("sizes")
    )


def cosine() -> Column:
    return F.col("dot")


def jaccard() -> Column:
    return F.col("overlap") / (F.col("sizes") - F.col("overlap"))


# A metric is an expression over the columns of co_rated_pairs.
METRICS: dict[str, Callable[[], Column]] = {"cosine": cosine, "jaccard": jaccard}
# The columns that they read.
METRIC_TERMS = {"cosine": ["dot"], "jaccard": ["overlap", "sizes"]}


def metric_column(metric: str | Callable[[], Column]) -> Column:
    expression = METRICS[metric] if isinstance(metric, str) else metric
    return rounded_similarity(expression())


def similarities(pairs: DataFrame, metric: str | Callable[[], Column] = "cosine") -> DataFrame:
    """``(u, v, sim)`` for the pairs ``u <= v`` whose similarity is not zero."""
    found = pairs.select("pair", metric_column(metric).alias("sim")).where(F.col("sim") != 0)
    return found.select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), "sim")


def pair_summary(
    pairs: DataFrame, n_users: int | Column, metric: str | Callable[[], Column] = "cosine"
) -> DataFrame:
    """Counts and overlap statistics over all pairs ``u <= v`` of users, in one row.

    Pairs without a common item are accounted for in closed form.
    """
    return summary_of_counts(pair_counts(pairs, metric), n_users)


def pair_counts(pairs: DataFrame, metric: str | Callable[[], Column] = "cosine") -> DataFrame:
    """What :func:`pair_summary` counts, in one row; :func:`added_counts` adds up those of several parts of the pairs."""
    overlap = F.col("overlap").cast("double")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(metric_column(metric) != 0).alias("pairs_nonzero"),
        F.min(overlap).alias("lowest"),
        F.max(overlap).alias("max_overlap"),
        F.sum(overlap).alias("total"),
        F.sum(overlap * overlap).alias("squares"),
    )


def added_counts(counts: DataFrame) -> DataFrame:
    added = [F.sum(c).alias(c) for c in ("n", "pairs_nonzero", "total", "squares")]
    return counts.agg(*added, F.min("lowest").alias("lowest"), F.max("max_overlap").alias("max_overlap"))


def summary_of_counts(found: DataFrame, n_users: int | Column) -> DataFrame:
    """:func:`pair_summary` from its counts over the co-rated pairs."""
    users = F.lit(n_users).cast("long")
    found = found.withColumn("pairs_all", (users * (users + 1) / 2).cast("long"))
    mean = F.col("total") / F.col("pairs_all")
    return found.select(
        "pairs_all",
        "pairs_nonzero",
        (F.lit(BYTES_PER_SIMILARITY) * F.col("pairs_nonzero")).cast("long").alias("bytes_nonzero"),
        F.when(F.col("n") < F.col("pairs_all"), 0.0).otherwise(F.col("lowest")).alias("min_overlap"),
        "max_overlap",
        mean.alias("avg_overlap"),
        F.sqrt(F.greatest(F.col("squares") / F.col("pairs_all") - mean * mean, F.lit(0.0))).alias("stddev_overlap"),
    )
