"""The k most similar other users of each user."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import first_of, pair_key, second_of, similarity_units, units_similarity
from kindred.operators.blocks import meet, partitions_for
from kindred.params import BYTES_PER_SIMILARITY, RANK_LIMIT


def both_directions(sims: DataFrame) -> DataFrame:
    """From pairs ``u <= v`` to one row per user and other user."""
    either = F.array(F.struct("u", "v", "sim"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "sim"))
    return sims.where(F.col("u") != F.col("v")).select(F.inline(either))


def _head(directed: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``. Up to a ``k`` of 1000, Spark applies the
    limit in every task before the shuffle as well."""
    best = Window.partitionBy(*group).orderBy(F.desc("sim"), "v")
    return directed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nearest(directed: DataFrame, n_users: int, k: int, per_user: float = math.inf, listed: float = math.inf) -> DataFrame:
    """``(u, v, sim, pos)``: the neighbours with a non-zero similarity among the first ``k``.

    All other users are ranked by similarity, ties by id. Users in no pair have similarity zero and
    rank as one block between the positive and the negative similarities. They are not materialized:
    the negative ones are moved down by the size of that block.

    The neighbours of each user are counted, and only the ``k`` first of them are ranked: a position is never better than
    the rank among the non-zero ones. Above the ``k`` up to which Spark limits a ranking by itself, each user's neighbours
    are first cut into parts, and these reduced to ``k``; parts are chosen so that both steps sort equally few rows.

    Where users have hardly more neighbours than ``k`` (``per_user`` is an upper bound of their number on average), a limit would only sort them once more
    before the shuffle: they are ranked and counted in one window. Where no user is in more than ``listed`` pairs, and that leaves ``k`` other users of
    similarity zero, these come before all negative similarities, which are not ranked then.
    """
    everyone, best = Window.partitionBy("u"), Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    few = per_user <= 2 * k
    if n_users - 1 - listed >= k:
        positive = directed.where(F.col("sim") > 0)
        if few:
            # The rank as a running count, which no limit is derived from.
            pos = F.count(F.lit(1)).over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            return positive.select("u", "v", "sim", pos.alias("pos")).where(F.col("pos") <= k)
        return _first(positive, n_users, k).select("u", "v", "sim", F.col("rank").cast("long").alias("pos"))
    if few:
        ranks = F.row_number().over(best).alias("rank"), F.count(F.lit(1)).over(everyone).alias("n_listed")
        ranked = directed.select("u", "v", "sim", *ranks)
    else:
        counts = directed.groupBy("u").agg(F.count(F.lit(1)).alias("n_listed"))
        ranked = _first(directed, n_users, k).join(counts, "u")
    return placed(ranked, n_users, k)


def positive_units(lists: DataFrame, matches: float, most: float) -> tuple[DataFrame, list[str]]:
    """``(pair_first, ..., pair_second, units)`` of the positive cosine similarities from lists of matches, where :func:`meet` has brought
    the pairs, and the columns that the rows of a ``pair_first`` in one partition share. The lists have the ``product`` of each match."""
    found, keys = meet(lists, matches, most)
    summed = found.where("pair_first <> pair_second").groupBy(*keys).agg(similarity_units(F.sum("product")).alias("units"))
    return summed.where("units > 0"), keys[:-1]


def nearest_of_lists(lists: DataFrame, matches: float, most: float, k: int) -> DataFrame:
    """:func:`nearest` where only positive similarities can be among the first ``k``, from the lists of matches without the users themselves.

    The pairs of a ``pair_first`` are in one partition already, so the first ``k`` of them are taken before anything is sent; to the other user, each pair is sent.
    The ranking is dealt out by the number of matches, whatever the session's setting: it sorts in memory at any size of the input."""
    positive, here = positive_units(lists, matches, most)
    local = Window.partitionBy(*here).orderBy(F.desc("units"), "pair_second")
    # A running count, so that the rows beyond k are not dropped here: the other user needs them.
    ranked = positive.withColumn("place", F.count(F.lit(1)).over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    there = F.struct(pair_key(F.col("pair_second"), F.col("pair_first")).alias("pair"), "units")
    own = F.when(F.col("place") <= k, F.struct(pair_key(F.col("pair_first"), F.col("pair_second")).alias("pair"), "units"))
    sent = ranked.select(F.inline(F.array_compact(F.array(there, own)))).repartition(partitions_for(2 * matches), first_of(F.col("pair")))
    best = Window.partitionBy("u").orderBy(F.desc("units"), "v")
    placed = sent.select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), "units").withColumn("pos", F.row_number().over(best).cast("long"))
    return placed.where(F.col("pos") <= k).select("u", "v", units_similarity(F.col("units")).alias("sim"), "pos")


def placed(ranked: DataFrame, n_users: int, k: int) -> DataFrame:
    """``(u, v, sim, pos)`` up to ``k`` from the ``rank`` among the ``n_listed`` non-zero neighbours of each user."""
    zeros = F.lit(n_users - 1) - F.col("n_listed")
    pos = F.when(F.col("sim") > 0, F.col("rank")).otherwise(F.col("rank") + zeros).cast("long")
    return ranked.select("u", "v", "sim", pos.alias("pos")).where(F.col("pos") <= k)


def _first(directed: DataFrame, n_users: int, k: int) -> DataFrame:
    """The ``k`` first rows of each user with their ``rank``, limited before the shuffle for any ``k``."""
    if k > RANK_LIMIT:
        parts = math.ceil(math.sqrt(max(n_users, 1) / k))
        directed = _head(directed.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts))), ["u", "part"], k)
    return _head(directed, ["u"], k)


def neighbour_storage(stats: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """``(k, neighbours, bytes)`` to keep ``k`` neighbours, zero similarities included, per user."""
    users = stats.agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("n") * F.least(F.col("k"), F.col("n") - 1)
    return users.select("n", F.explode(F.array(*[F.lit(k) for k in k_values])).alias("k")).select(
        "k", kept.alias("neighbours"), (F.lit(BYTES_PER_SIMILARITY) * kept).cast("long").alias("bytes")
    )
