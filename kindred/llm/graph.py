"""Connected components, and links among the members of many overlapping lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import staged

Verify = Callable[[DataFrame], DataFrame]
MayLink = Callable[[Column, Column], Column]
Marks = Callable[[Column], Column]

# Longer lists are not paired up if there are marks; by so many members these are ordered.
LONG, SHOWN = 32, 16


def _size_and_sum(edges: DataFrame) -> tuple[int, int]:
    found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(found)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of the links ``(a, b)``: the smallest node that links lead to.

    Large-star and small-star steps alternate: every node is linked to the smallest of its neighbours, first the larger
    neighbours, then the smaller ones, until each component is a star. Each round is written as a table; the driver sees
    one row per round.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "edges")
    before = _size_and_sum(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.unionAll(lowest.where("m < u").select("u", F.col("m").alias("v"))).distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionAll(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _size_and_sum(edges)
        if after == before:
            break
        before = after
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(centres)


def _star_round(lists: DataFrame, verify: Verify, may_link: MayLink) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs of each list's smallest member with the others, the links among them, and the lists that these links leave in
    several components, as ``(item, node, trait, component, least, size)``."""
    least = lists.groupBy("item").agg(F.min(F.struct("node", "trait")).alias("least"))
    pairs = lists.join(least, "item").where("node > least.node").where(may_link(F.col("least.trait"), F.col("trait")))
    pairs = staged(pairs.select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct(), "star-pairs")
    links = staged(verify(pairs), "star-links")
    labelled = lists.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = staged(labelled, "labelled-lists")
    mixed = labelled.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("node").alias("least"), F.count(F.lit(1)).alias("size"))
    return pairs, links, staged(labelled.join(mixed.where("lo < hi").drop("lo", "hi"), "item"), "open-lists")


def _marked_lists(members: DataFrame, marks: Marks, unlike: int) -> DataFrame:
    """Lists of the members ``(item, node, component, trait)`` of each item that share one of their rarest marks.

    Linked members lack at most ``unlike`` of each other's marks. So in whatever order of an item's marks, the same for all its
    members, some mark is among the first ``unlike + 1`` of both: the one whose first marks end earlier would else have as many that the other
    lacks. Here marks go by how many of ``SHOWN`` members have them, and by value. The order does not change which links are found,
    only how long the lists are. Fixed marks are added at the end for members that have fewer.
    """
    marked = staged(members.withColumn("marks", marks(F.col("trait"))), "marked-members")
    shown = marked.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy("node"))).where(F.col("place") <= SHOWN)
    counts = shown.select("item", F.explode("marks").alias("mark")).groupBy("item", "mark").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("item", "n").agg(F.collect_list("mark").alias("marks"))
    counts = counts.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("n", "marks"))).alias("counts"))
    none = F.array().cast("array<bigint>")
    rare = F.array_sort(F.array_except("marks", F.coalesce(F.flatten(F.transform("counts", lambda c: c["marks"])), none)))
    others = F.coalesce(F.flatten(F.transform("counts", lambda c: F.array_sort(F.array_intersect(F.col("marks"), c["marks"])))), none)
    ordered = F.concat(rare, others, F.array(*[F.lit(i).cast("long") for i in range(unlike + 1)]))
    rows = marked.join(counts, "item", "left").select("item", "node", "component", "trait", F.explode(F.slice(ordered, 1, unlike + 1)).alias("mark"))
    return rows.select(F.xxhash64("item", "mark").alias("item"), "node", "component", "trait")


def linked_lists(
    lists: DataFrame, verify: Verify, may_link: MayLink, describe: Verify, may_link_across: MayLink, marks: Marks | None = None, unlike: int = 0
) -> DataFrame:
    """Components of the links among nodes that share a list: ``(node, component)`` for the linked nodes.

    ``lists`` has ``(item, node, trait)``, each pair of item and node once; a node always has the same trait. ``verify`` reduces
    candidate pairs ``(a, b)``, ``a < b``, to those that are linked, and is only asked about pairs whose traits
    ``may_link``. Every such pair of nodes that share a list is either verified, or already known to be connected, or ruled out by its marks:

    1. each member of a list is verified against the smallest member only, which takes as many pairs as there are entries;
    2. the components of those links are looked up, and only in lists that still hold several components are
       the pairs across components verified. For these lists ``describe`` adds traits that tell more, and no pair that
       ``may_link_across`` rules out by them leaves the join;
    3. of these lists, those of more than ``LONG`` members are gathered into clusters, the components of their members, if ``marks`` gives
       an array of different longs for what ``describe`` tells, of which linked nodes lack at most ``unlike`` of each other's. In a cluster
       only members that share one of their rarest marks are paired: see :func:`_marked_lists`.

    So a list of thousands of copies costs thousands of pairs, not millions, and no link is lost; nor does one of near copies
    that are not linked, if each has marks of its own.
    """
    first, links, open_lists = _star_round(lists, verify, may_link)
    columns, may_link = ["item", "node", "component", "trait"], may_link_across
    if marks is None:
        open_lists = describe(open_lists).select(*columns)
    else:
        long_lists, open_lists = open_lists.where(F.col("size") > LONG), describe(open_lists.where(F.col("size") <= LONG)).select(*columns)
        if not long_lists.isEmpty():
            clusters = components(long_lists.select(F.col("least").alias("a"), F.col("node").alias("b")))
            members = long_lists.select("node", "component", "trait").dropDuplicates(["node"])
            members = describe(members.join(clusters.select("node", F.col("component").alias("item")), "node")).select(*columns)
            open_lists = open_lists.unionAll(_marked_lists(members, marks, unlike))
    open_lists = staged(open_lists, "described-lists")
    left = open_lists.select("item", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("trait").alias("ta"))
    right = open_lists.select("item", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("trait").alias("tb"))
    shared = (left["item"] == right["item"]) & (F.col("ca") < F.col("cb")) & may_link(F.col("ta"), F.col("tb"))
    across = left.join(right, shared).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verify(across.distinct().join(first, ["a", "b"], "left_anti"))
    return components(links.unionAll(staged(more, "more-links")))


def settled_lists(lists: DataFrame, verify: Verify, may_link: MayLink, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same as :func:`linked_lists`, but without pairs in the second step: the lists that are still open are gathered into clusters,
    the components of their members, and ``settle`` finds links ``(a, b)`` that connect what is linked in each cluster of
    ``(node, cluster)``."""
    _, links, open_lists = _star_round(lists, verify, may_link)
    clusters = components(open_lists.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct())
    more = settle(staged(clusters.withColumnRenamed("component", "cluster"), "clusters"))
    return components(links.unionAll(staged(more, "more-links")))
