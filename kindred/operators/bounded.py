"""The k nearest neighbours without adding up the pairs that cannot be among them.

A user's similarity to another one is the sum of the products of their weights (the unit vector's entries) over common items. Only
products of equal sign raise it, and an item cannot add more than the user's weight times the largest weight of that sign that any rater
of the item has: the item's *cap* for the user. Three steps use that:

1. A bound from below. Each user's items with the highest caps, joined with the heaviest raters of these items, give some good candidates. Their exact
   similarities are computed, and the k-th best of them is a similarity that the user's k-th neighbour has at least.
2. Pairs that can reach it. In the order of falling caps, cut into levels of powers of two, the items of a user from some level on cannot add up to more than
   the smaller of the sum of their caps and the norm of their weights (Cauchy-Schwarz). Items whose bound is below a share of the similarity from step 1 are left
   out: who has only those in common with the user is never met. The others are joined with the raters of equal sign,
   and a pair whose sum plus the bound of what was left out does not reach that similarity is dropped.
3. The exact similarities of the pairs that remain, ranked.

A user for whom step 1 does not find k users of positive similarity needs all pairs, down to the negative ones, and gets them from the plain join.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import first_of, pair_key, rounded_similarity, second_of, symmetric_pair_key
from kindred.operators.blocks import Groups, dealt, group_join, group_rows, in_part, measure_groups, meet, member_lists, pair_lists, rounds_for, whole_lists
from kindred.operators.neighbours import both_directions, nearest
from kindred.operators.similarity import co_rated_pairs_of, most_matches, similarities
from kindred.params import BLOCK_ROWS
from kindred.session import staged

LEVELS = 40
HEADS = 4
SHARE = 0.5
# Sums in another order differ by less than this; similarities are rounded to ten decimals.
SLACK = 1e-9


@dataclass
class BoundedNeighbours:
    """``neighbours`` is the result, ``(u, v, sim, pos)``. The other tables tell what it took: ``met`` the directed pairs that step 2 added up, ``verified``
    the pairs whose exact similarity was computed, and ``thresholds`` the bound ``(u, least)`` of each user that needs no plain join."""

    neighbours: DataFrame
    thresholds: DataFrame
    met: DataFrame
    verified: DataFrame


def weighted_rows(normed: DataFrame) -> DataFrame:
    """``(posting, u, weight, n_items, cap, level)``: the non-zero entries of the unit vectors; a posting is an item and a sign."""
    rows = normed.where(F.col("pre") != 0).select(
        (F.col("item_id").cast("long") * 2 + (F.col("pre") > 0).cast("long")).alias("posting"),
        F.col("user_id").alias("u"),
        F.abs("pre").alias("weight"),
        "n_items",
    )
    tops = rows.groupBy("posting").agg(F.max("weight").alias("top"))
    capped = rows.join(tops.hint("shuffle_hash"), "posting").withColumn("cap", F.col("weight") * F.col("top")).drop("top")
    level = F.least(F.floor(-F.log2("cap")), F.lit(LEVELS - 1))
    return capped.withColumn("level", F.greatest(level, F.lit(0)).cast("int"))


def exact_similarities(pairs: DataFrame, normed: DataFrame) -> DataFrame:
    """``(u, v, sim)`` with ``u < v`` for distinct pairs ``(u, v, n_u, n_v)``: the items of the user who has fewer are looked up at the other one."""
    fewer = F.col("n_u") <= F.col("n_v")
    asked = pairs.select(
        F.when(fewer, F.col("u")).otherwise(F.col("v")).alias("a"), F.when(fewer, F.col("v")).otherwise(F.col("u")).alias("b")
    )
    entries = normed.where(F.col("pre") != 0)
    mine = entries.select(F.col("user_id").alias("a"), "item_id", F.col("pre").alias("pre_a"))
    other = entries.select(F.col("user_id").alias("b"), "item_id", F.col("pre").alias("pre_b"))
    matches = asked.join(mine, "a").join(other, ["b", "item_id"])
    dots = matches.groupBy(symmetric_pair_key(F.col("a"), F.col("b")).alias("pair")).agg(F.sum(F.col("pre_a") * F.col("pre_b")).alias("dot"))
    found = dots.select("pair", rounded_similarity(F.col("dot")).alias("sim")).where(F.col("sim") != 0)
    return found.select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), "sim")


def exact_from_lists(pairs: DataFrame, normed: DataFrame, groups: Groups, n_pairs: float, most: float) -> DataFrame:
    """:func:`exact_similarities` of up to ``n_pairs`` pairs, which may repeat: they are sent to where the matches of all pairs are added up, and the sums of the others are left out.

    A match is sent as its values only, so this is less than the vectors of one user for each pair, unless few pairs of many are asked for."""
    lists = pair_lists(normed.where(F.col("pre") != 0).select("item_id", "user_id", "pre"), groups, "user_id")
    return _asked_sims(pairs, lists, groups.self_matches + n_pairs, most)


def _asked_sims(pairs: DataFrame, lists: DataFrame, entries: float, most: float) -> DataFrame:
    asked = pairs.select(F.col("u").alias("pair_first"), F.array("v").alias("pair_second"), F.lit(True).alias("asked"))
    found, keys = meet(lists.unionByName(asked, allowMissingColumns=True), entries, most)
    dots = found.groupBy(*keys).agg(F.sum(F.col("pre_l") * F.col("pre_r")).alias("dot"), F.max("asked").alias("asked"))
    sims = dots.where("asked").select(F.col("pair_first").alias("u"), F.col("pair_second").alias("v"), rounded_similarity(F.col("dot")).alias("sim"))
    return sims.where(F.col("sim") != 0)


def _undirected(directed: DataFrame) -> DataFrame:
    """Pairs that were met from one side or from both, once each."""
    return _ordered(directed).groupBy("u", "v").agg(F.max("n_u").alias("n_u"), F.max("n_v").alias("n_v"))


def _ordered(directed: DataFrame) -> DataFrame:
    turned = F.col("u") > F.col("v")
    either = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    return directed.select(either("u", "v").alias("u"), either("v", "u").alias("v"), either("n_u", "n_v").alias("n_u"), either("n_v", "n_u").alias("n_v"))


def thresholds(rows: DataFrame, normed: DataFrame, k: int, heads: int = HEADS, exact: Callable[[DataFrame, float], DataFrame] | None = None) -> DataFrame:
    """``(u, least)``: a similarity that the k-th neighbour has at least, for the users with k candidates of positive similarity."""
    head, listed, each = _heads(rows, k, heads)
    candidates = head.join(listed, "posting").where(F.col("u") != F.col("v")).drop("posting")
    found = exact(candidates, heads * each) if exact else exact_similarities(_undirected(candidates), normed)
    return _least(both_directions(found), k)


def _heads(rows: DataFrame, k: int, heads: int) -> tuple[DataFrame, DataFrame, int]:
    """``(posting, u, n_u)``, the entries with the highest caps of each user, ``(posting, v, n_v)``, the heaviest raters of each posting, and how many these are."""
    best = Window.partitionBy("u").orderBy(F.desc("cap"), "posting")
    head = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= heads).select("posting", "u", F.col("n_items").alias("n_u"))
    heaviest = Window.partitionBy("posting").orderBy(F.desc("weight"), "u")
    each = math.ceil(2 * k / heads)
    listed = rows.withColumn("rank", F.row_number().over(heaviest)).where(F.col("rank") <= each)
    return head, listed.select("posting", F.col("u").alias("v"), F.col("n_items").alias("n_v")), each


def _least(sims: DataFrame, k: int) -> DataFrame:
    """``(u, least)``, the k-th positive similarity of each user that has so many."""
    sims = sims.where(F.col("sim") > 0)
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    ranked = sims.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.where(F.col("rank") == k).select("u", F.col("sim").alias("least"))


def prefixes(rows: DataFrame, least: DataFrame, share: float = SHARE) -> DataFrame:
    """``(u, cut, need)``: items of levels up to ``cut`` are joined; with less than ``need`` from them, a pair does not reach the user's threshold."""
    levels = rows.groupBy("u", "level").agg(F.sum("cap").alias("caps"), F.sum(F.col("weight") * F.col("weight")).alias("squares"))
    # One row per user and level: what the items of this level and those below can add.
    down = Window.partitionBy("u").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = F.least(F.sum("caps").over(down), F.sqrt(F.sum("squares").over(down)))
    bounded = levels.select("u", "level", rest.alias("rest")).join(least.hint("shuffle_hash"), "u")
    left_out = F.col("rest") <= F.col("least") * share
    cuts = bounded.groupBy("u").agg(
        F.max(F.when(~left_out, F.col("level"))).alias("cut"),
        F.coalesce(F.max(F.when(left_out, F.col("rest"))), F.lit(0.0)).alias("rest"),
        F.max("least").alias("least"),
    )
    return cuts.select("u", "cut", (F.col("least") - F.col("rest") - SLACK).alias("need"))


def _first(sims: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return sims.withColumn("pos", F.row_number().over(order).cast("long")).where(F.col("pos") <= k).select("u", "v", "sim", "pos")


class _Rounds:
    """The steps for one part of the users after the other: what is sent for a part is deleted before the next.

    A user's candidates and pairs are all in the round of that user, and so are the exact similarities that are asked for: pairs are directed here."""

    def __init__(self, normed: DataFrame, items: Groups, n_users: int, n_ratings: int, most: float):
        self.normed, self.items, self.n_users, self.n_ratings, self.most = normed, items, n_users, n_ratings, most

    def parts(self, n_pairs: float) -> list[Callable[[Column], Column]]:
        """The parts for so many pairs that are sent next to the whole lists of all users; none if they can be sent at once."""
        parts = rounds_for(2 * self.items.self_matches + n_pairs)
        return [in_part(part, parts) for part in range(parts)] if parts > 1 else []

    @cached_property
    def lists(self) -> DataFrame:
        return staged(member_lists(self.normed.where(F.col("pre") != 0).select("item_id", "user_id", "pre"), self.items, "user_id"), "member-lists")

    def exact(self, directed: DataFrame, chosen: Callable[[Column], Column], n_pairs: float, parts: int) -> DataFrame:
        """``(u, v, sim)`` of the pairs ``(u, v, n_u, n_v)`` of the chosen ``u``, which may repeat; :func:`exact_from_lists` where that is less. All parts have up to ``n_pairs``."""
        if n_pairs / max(self.n_users, 1) * self.n_ratings < self.items.self_matches:
            return both_directions(exact_similarities(_undirected(directed), self.normed)).where(chosen(F.col("u")))
        lists = whole_lists(self.lists, "user_id", chosen)
        sims = _asked_sims(directed, lists, (2 * self.items.self_matches + n_pairs) / parts, self.most)
        return sims.where(F.col("u") != F.col("v"))

    def thresholds(self, rows: DataFrame, k: int, heads: int) -> DataFrame:
        """:func:`thresholds`; a pair that one of the two has among the heaviest raters is a candidate of both."""
        head, listed, each = _heads(rows, k, heads)
        head, listed = staged(head, "knn-heads"), staged(listed, "knn-heaviest")
        n_pairs = 2 * heads * each * self.n_users
        parts, found = self.parts(2 * HEADS * k * self.n_users), []
        for chosen in parts:
            own = head.where(chosen(F.col("u"))).join(listed, "posting")
            turned = head.join(listed.where(chosen(F.col("v"))), "posting").select(F.col("v").alias("u"), F.col("u").alias("v"), F.col("n_v").alias("n_u"), F.col("n_u").alias("n_v"))
            candidates = own.drop("posting").unionByName(turned).where(F.col("u") != F.col("v"))
            found.append(staged(_least(self.exact(candidates, chosen, n_pairs, len(parts)), k), "knn-thresholds"))
        return reduce(DataFrame.unionByName, found)

    def closed(self, left: DataFrame, right: DataFrame, groups: Groups, k: int) -> DataFrame:
        """The neighbours of the users on the left, from the lists of the raters of each posting and of those who ask for them."""
        dealt_rows, keys = group_rows(left, right, groups, ("u", "v"))
        asker, rater = F.struct("u", "weight", "n_u", "need"), F.struct("v", "weight_v", "n_v")
        listed = lambda member, row: F.collect_list(F.when(F.col(member).isNotNull(), row))
        lists = dealt_rows.groupBy(*keys).agg(listed("u", asker).alias("askers"), listed("v", rater).alias("raters"))
        lists = staged(lists.where((F.size("askers") > 0) & (F.size("raters") > 0)).select("askers", "raters"), "knn-postings")
        parts, found = self.parts(groups.join_matches), []
        for chosen in parts:
            asked = lists.withColumn("asker", F.explode(F.filter("askers", lambda a: chosen(a["u"]))))
            sent = asked.select(
                F.col("asker.u").alias("pair_first"),
                F.col("raters.v").alias("pair_second"),
                F.col("asker.n_u").alias("n_u"),
                F.col("asker.need").alias("need"),
                F.transform("raters.weight_v", lambda w: w * F.col("asker.weight")).alias("product"),
                F.col("raters.n_v").alias("n_v"),
            )
            matches, names = meet(sent, groups.join_matches / len(parts), self.most)
            met = matches.where(F.col("pair_first") != F.col("pair_second")).groupBy(*names).agg(
                F.sum("product").alias("sum"), F.max("need").alias("need"), F.max("n_u").alias("n_u"), F.max("n_v").alias("n_v")
            )
            able = met.where(F.col("sum") >= F.col("need")).select(F.col("pair_first").alias("u"), F.col("pair_second").alias("v"), "n_u", "n_v")
            found.append(staged(_first(self.exact(able, chosen, groups.join_matches, len(parts)), k), "knn-closed"))
        return reduce(DataFrame.unionByName, found)


def bounded_neighbours(normed: DataFrame, n_users: int, k: int, block_rows: int = BLOCK_ROWS, share: float = SHARE, heads: int = HEADS) -> BoundedNeighbours:
    """The ``k`` nearest neighbours of every user, as :func:`kindred.operators.neighbours.nearest` gives them for all co-rated pairs."""
    rows = staged(weighted_rows(normed), "weighted-rows")
    items = measure_groups("item_id", normed, block_rows=block_rows)
    n_ratings, most = normed.count(), most_matches(normed, items)

    def exact(directed: DataFrame, per_user: float) -> DataFrame:
        # A pair that is looked up costs about as many rows as a user has items: all pairs of a user, as many as the ratings times the pairs of one.
        if per_user * n_ratings < items.self_matches:
            return exact_similarities(_undirected(directed), normed)
        return exact_from_lists(_ordered(directed), normed, items, per_user * n_users, 3 * most)

    in_rounds = _Rounds(normed, items, n_users, n_ratings, 3 * most)
    if in_rounds.parts(2 * HEADS * k * n_users):
        least = in_rounds.thresholds(rows, k, heads)
    else:
        least = staged(thresholds(rows, normed, k, heads, exact), "knn-thresholds")

    asking = rows.join(prefixes(rows, least, share).hint("shuffle_hash"), "u").where(F.col("level") <= F.col("cut"))
    left = staged(asking.select("posting", "u", "weight", F.col("n_items").alias("n_u"), "need"), "knn-prefixes")
    right = rows.select("posting", F.col("u").alias("v"), F.col("weight").alias("weight_v"), F.col("n_items").alias("n_v"))
    groups = measure_groups("posting", left, right, block_rows)
    matches = group_join(left, right, groups, ("u", "v")).where(F.col("u") != F.col("v"))
    keyed = matches.select(
        pair_key(F.col("u"), F.col("v")).alias("pair"), (F.col("weight") * F.col("weight_v")).alias("product"), "need", "n_u", "n_v"
    )
    met = dealt(keyed, groups.join_matches, "pair").groupBy("pair").agg(
        F.sum("product").alias("sum"), F.max("need").alias("need"), F.max("n_u").alias("n_u"), F.max("n_v").alias("n_v")
    )
    able = met.where(F.col("sum") >= F.col("need")).select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), "n_u", "n_v")
    verified = _undirected(able)
    if in_rounds.parts(groups.join_matches):
        closed = in_rounds.closed(left, right, groups, k)
    else:
        sims = both_directions(exact(able, groups.join_matches / max(n_users, 1))).join(least.select("u").hint("shuffle_hash"), "u", "left_semi")
        closed = _first(sims, k)

    # The others, by the plain join; users without any weight have no neighbours to list.
    others = staged(rows.select(F.col("u").alias("user_id")).distinct().join(least, F.col("user_id") == F.col("u"), "left_anti"), "knn-open-users")
    found = closed
    if not others.isEmpty():
        theirs = normed.join(others.hint("shuffle_hash"), "user_id", "left_semi")
        pairs = co_rated_pairs_of(others, normed, measure_groups("item_id", theirs, normed, block_rows))
        directed = both_directions(similarities(pairs)).join(others.select(F.col("user_id").alias("u")).hint("shuffle_hash"), "u", "left_semi")
        found = closed.unionByName(nearest(directed, n_users, k))
    return BoundedNeighbours(found, least, met, verified)
