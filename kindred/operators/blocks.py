"""Joins within the groups of a key when some groups are too large for one task.

Matching the members of a group with each other costs the square of the group's size, so neither the
number of tasks nor the work of one task may follow from the bytes that go in. The group sizes are
counted first (one row comes back), and decide two things:

* how many tasks share the join, from the number of matches it will find;
* which groups are hot. A group of more than ``block_rows`` rows is cut into blocks by a hash of the
  member, and its rows are sent to a grid with a cell for each pair of a left and a right block. Each
  cell is a join key of its own, so a hot group becomes many small joins that any number of tasks can
  share. Every pair of members meets in exactly one cell: the result is that of the plain join. Rows of
  all other groups are sent once, and without hot groups there are no cells at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.params import BLOCK_ROWS, BROADCAST_ROWS, ENTRIES_PER_ROUND, MATCHES_PER_TASK, MOST_TASKS, PAIRS_PER_PARTITION
from kindred.session import staged


@dataclass(frozen=True)
class Groups:
    """What is known about the groups of ``key`` before they are joined.

    ``hot`` is a table ``(key, blocks_l, blocks_r)`` of ``n_hot`` rows, or None if no group is hot. ``self_matches`` and
    ``join_matches`` are the numbers of matches of the left side with itself and with the right one; ``largest`` is the size of the
    largest group on the left.
    """

    key: str
    hot: DataFrame | None
    n_hot: int
    self_matches: float
    join_matches: float
    largest: int = 0

    @property
    def self_tasks(self) -> int:
        return self._tasks(self.self_matches)

    @property
    def join_tasks(self) -> int:
        return self._tasks(self.join_matches)

    def _tasks(self, matches: float) -> int:
        wanted = min(math.ceil(matches / MATCHES_PER_TASK), MOST_TASKS)
        return max(SparkSession.active().sparkContext.defaultParallelism, wanted)


def measure_groups(key: str, left: DataFrame, right: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> Groups:
    """Count the groups of ``key`` in ``left``, and in ``right`` if they will be joined.

    A group is hot if it has more than ``block_rows`` rows on one side, whatever the size of the input. The hot groups are
    written as a table, since every join on the key reads them.
    """
    rows = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r"))
    if right is not None:
        rows = rows.unionAll(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    counts = rows.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    is_hot = F.greatest("l", "r") > F.lit(block_rows)
    left_n, right_n = F.col("l").cast("double"), F.col("r").cast("double")
    size = counts.agg(
        F.count_if(is_hot).alias("n_hot"),
        F.coalesce(F.sum(left_n * (left_n + 1) / 2), F.lit(0.0)).alias("self_matches"),
        F.coalesce(F.sum(left_n * right_n), F.lit(0.0)).alias("join_matches"),
        F.coalesce(F.max("l"), F.lit(0)).alias("largest"),
    ).first()
    hot = None
    if size.n_hot:
        blocks = lambda n: F.greatest(F.ceil(F.col(n) / F.lit(block_rows)), F.lit(1)).cast("int")
        hot = counts.where(is_hot).select(key, blocks("l").alias("blocks_l"), blocks("r").alias("blocks_r"))
        hot = staged(hot, "hot-groups")
    return Groups(key, hot, size.n_hot, size.self_matches, size.join_matches, size.largest)


def with_block(df: DataFrame, member: str, groups: Groups, side: str = "l") -> DataFrame:
    """Add ``blocks_l`` and ``blocks_r`` of the row's group, and ``block``, the row's own one on its side.

    Up to ``BROADCAST_ROWS`` hot groups are broadcast. More are the hashed side of a shuffle: the rows of ``df`` are not
    sorted, and adaptive execution may split a partition that a hot group fills.
    """
    one = F.lit(1)
    if groups.hot is None:
        return df.withColumns({"blocks_l": one, "blocks_r": one, "block": F.lit(0)})
    hot = F.broadcast(groups.hot) if groups.n_hot <= BROADCAST_ROWS else groups.hot.hint("shuffle_hash")
    found = df.join(hot, groups.key, "left")
    blocks = {name: F.coalesce(name, one) for name in ("blocks_l", "blocks_r")}
    own = F.pmod(F.xxhash64(member), blocks[f"blocks_{side}"]).cast("int")
    return found.withColumns({**blocks, "block": own})


def _cells(df: DataFrame, own: str, other: str, first: Column, last: Column) -> DataFrame:
    """Send each row to the cells of its block: ``own`` is the block, ``other`` runs from first to last."""
    sent = df.withColumn(other, F.explode(F.sequence(first, last))).withColumnRenamed("block", own)
    return sent.drop("blocks_l", "blocks_r")


def group_join(left: DataFrame, right: DataFrame, groups: Groups, members: tuple[str, str]) -> DataFrame:
    """Equi-join on the key; ``members`` names the column that identifies a row within its group.

    Each side has its own number of blocks: where one side of a hot group is small, the rows of the
    other side are spread but not repeated.
    """
    keys = [groups.key]
    if groups.hot is not None:
        zero = F.lit(0)
        left = _cells(with_block(left, members[0], groups, "l"), "cell_l", "cell_r", zero, F.col("blocks_r") - 1)
        right = _cells(with_block(right, members[1], groups, "r"), "cell_r", "cell_l", zero, F.col("blocks_l") - 1)
        keys += ["cell_l", "cell_r"]
    joined = left.repartition(groups.join_tasks, *keys).join(right.repartition(groups.join_tasks, *keys), keys)
    return joined.drop("cell_l", "cell_r")


def group_self_join(df: DataFrame, groups: Groups, member: str) -> DataFrame:
    """Join ``df``, the left side of ``groups``, with itself on the key: each unordered pair of members
    once, with itself included.

    Columns other than the key come back twice, with suffixes ``_l`` and ``_r``. Only the cells on one
    side of the grid's diagonal exist, so which member is on the left is arbitrary in hot groups.
    """
    keys = [groups.key]
    left = right = df
    once = F.col(f"{member}_l") <= F.col(f"{member}_r")
    if groups.hot is not None:
        blocked = with_block(df, member, groups, "l")
        left = _cells(blocked, "cell_l", "cell_r", F.col("block"), F.col("blocks_l") - 1)
        right = _cells(blocked, "cell_r", "cell_l", F.lit(0), F.col("block"))
        keys += ["cell_l", "cell_r"]
        once = (F.col("cell_l") < F.col("cell_r")) | once
    others = [c for c in df.columns if c != groups.key]
    left = left.repartition(groups.self_tasks, *keys).select(*keys, *[F.col(c).alias(f"{c}_l") for c in others])
    right = right.repartition(groups.self_tasks, *keys).select(*keys, *[F.col(c).alias(f"{c}_r") for c in others])
    return left.join(right, keys).where(once).drop("cell_l", "cell_r")


def member_lists(df: DataFrame, groups: Groups, member: str) -> DataFrame:
    """The members of a group, in the order of their ids, as arrays ``<column>_other``; those of a hot group's cell as ``<column>_own`` and ``<column>_other``, once for
    either order of its blocks. The key is not kept; null keys match nothing."""
    df = df.where(F.col(groups.key).isNotNull())
    columns = [member, *[c for c in df.columns if c not in (groups.key, member)]]
    entry = F.struct(*columns)
    listed = lambda rows: F.sort_array(F.collect_list(rows))
    split = lambda sides: [F.col(side)[c].alias(f"{c}_{side}") for c in columns for side in sides]
    if groups.hot is None:
        grouped = df.repartition(groups.self_tasks, groups.key).groupBy(groups.key).agg(listed(entry).alias("other"))
        return grouped.select(*split(["other"]))
    blocked = with_block(df, member, groups, "l").withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks_l") - 1)))
    sent = blocked.withColumns({"cell_l": F.least("block", "met"), "cell_r": F.greatest("block", "met")})
    keys = [groups.key, "cell_l", "cell_r"]
    side = lambda name: listed(F.when(F.col("block") == F.col(f"cell_{name}"), entry)).alias(name)
    cells = sent.repartition(groups.self_tasks, *keys).groupBy(*keys).agg(side("l"), side("r"))
    # Either block of a cell may have the smaller id of a pair.
    turned = F.when(F.col("cell_l") < F.col("cell_r"), F.struct(F.col("r").alias("own"), F.col("l").alias("other")))
    both = F.array_compact(F.array(F.struct(F.col("l").alias("own"), F.col("r").alias("other")), turned))
    return cells.select(F.inline(both)).select(*split(["own", "other"]))


def _own(lists: DataFrame, column: str) -> str:
    return f"{column}_own" if f"{column}_own" in lists.columns else f"{column}_other"


def _others(lists: DataFrame, member: str) -> list[str]:
    return [c.removesuffix("_other") for c in lists.columns if c.endswith("_other") and c != f"{member}_other"]


def rest_of_lists(lists: DataFrame, member: str, itself: bool = True, chosen: Callable[[Column], Column] | None = None) -> DataFrame:
    """:func:`pair_lists` from the lists of :func:`member_lists`, of the ``chosen`` members only."""
    own, others = _own(lists, member), _others(lists, member)
    if own == f"{member}_own":
        first = F.size(F.filter(f"{member}_other", lambda x: x < F.col("pair_first") if itself else x <= F.col("pair_first"))) + 1
    else:
        first = F.array_position(own, F.col("pair_first")).cast("int") + int(not itself)
    if chosen is None:
        at = lists.select("*", F.posexplode(own).alias("at", "pair_first"))
    else:
        at = _exploded(lists, own, chosen)
    at = at.withColumn("first", first)
    rest = lambda c: F.slice(f"{c}_other", F.col("first"), F.size(f"{member}_other"))
    return at.where(F.col("first") <= F.size(f"{member}_other")).select(
        "pair_first",
        rest(member).alias("pair_second"),
        *[F.get(_own(lists, c), F.col("at")).alias(f"{c}_l") for c in others],
        *[rest(c).alias(f"{c}_r") for c in others],
    )


def _exploded(lists: DataFrame, own: str, chosen: Callable[[Column], Column]) -> DataFrame:
    """A row for each chosen member of ``own``, the ``pair_first`` at place ``at``: the others are not made rows of."""
    places = F.filter(F.transform(own, lambda x, n: F.when(chosen(x), n)), F.isnotnull)
    return lists.withColumn("at", F.explode(places)).withColumn("pair_first", F.get(own, F.col("at")))


def whole_lists(lists: DataFrame, member: str, chosen: Callable[[Column], Column]) -> DataFrame:
    """As :func:`rest_of_lists`, but each chosen member gets the whole lists, not only what comes after it: all that is known of its pairs then."""
    others = _others(lists, member)
    return _exploded(lists, _own(lists, member), chosen).select(
        "pair_first",
        F.col(f"{member}_other").alias("pair_second"),
        *[F.get(_own(lists, c), F.col("at")).alias(f"{c}_l") for c in others],
        *[F.col(f"{c}_other").alias(f"{c}_r") for c in others],
    )


def pair_lists(df: DataFrame, groups: Groups, member: str, itself: bool = True) -> DataFrame:
    """The matches of :func:`group_self_join`, each once, as lists ``(pair_first, pair_second, <column>_l, <column>_r...)``; :func:`meet` makes rows of them.

    The members of a group (of a cell, in hot groups) are a list in the order of the ids, and each of them gets one row with the rest of the list, itself included, as
    one array for each column: in a shuffle, a match costs its values and nothing for the pair. The key is not kept; null keys match nothing.
    Without ``itself``, the list begins after the member; what remains of a member that a group holds twice still has it.
    """
    return rest_of_lists(member_lists(df, groups, member), member, itself)


def in_part(part: int, parts: int) -> Callable[[Column], Column]:
    """Whether an id is in one of ``parts`` parts of all ids; by another hash than that of a shuffle."""
    return lambda member: F.pmod(F.xxhash64(member), F.lit(parts)) == part


def rounds_for(entries: float) -> int:
    """In how many rounds ``entries`` entries of lists are sent. The shuffle files of a round are deleted before the next one, so the disk holds those of one."""
    return max(1, math.ceil(entries / ENTRIES_PER_ROUND))


def partitions_for(rows: float, least: int | None = None) -> int:
    """How many partitions ``rows`` rows of pairs need, at least one for each core."""
    least = SparkSession.active().sparkContext.defaultParallelism if least is None else least
    return max(least, min(math.ceil(rows / PAIRS_PER_PARTITION), MOST_TASKS))


def meet(lists: DataFrame, matches: float, most: float) -> tuple[DataFrame, list[str]]:
    """A row for each entry of the lists, and the columns that name its pair: rows of equal pairs are in one partition, whatever list they come from.

    All arrays of a row are as long as ``pair_second``, or null. ``matches`` is the number of entries, and ``most`` that of one ``pair_first`` at most: if it is more than a partition
    should hold, the entries are dealt by a hash of ``pair_second`` as well.
    """
    arrays = [c for c, kind in lists.dtypes if kind.startswith("array") and c != "pair_second"]
    others = [c for c in lists.columns if c not in (*arrays, "pair_first", "pair_second")]
    keys = ["pair_first"]
    parts = partitions_for(most, 1)
    if parts > 1:
        of = lambda x: F.pmod(F.xxhash64(x), F.lit(parts)).cast("int")
        lists = lists.withColumn("part", F.explode(F.array_distinct(F.transform("pair_second", of))))
        # Places are chosen by the second of the pair, and all arrays read there.
        places = F.filter(F.transform("pair_second", lambda x, n: F.when(of(x) == F.col("part"), n)), F.isnotnull)
        lists = lists.withColumn("places", places)
        taken = lambda c: F.when(F.col(c).isNotNull(), F.transform("places", lambda n: F.get(c, n)))
        lists = lists.select("pair_first", "part", *others, *[taken(c).alias(c) for c in ["pair_second", *arrays]])
        keys.append("part")
    rows = lists.repartition(partitions_for(matches), *keys).select(*keys, *others, *arrays, F.posexplode("pair_second").alias("at", "second"))
    found = rows.select(*keys, F.col("second").alias("pair_second"), *others, *[F.get(c, F.col("at")).alias(c) for c in arrays])
    return found, [*keys, "pair_second"]


def group_rows(left: DataFrame, right: DataFrame, groups: Groups, members: tuple[str, str]) -> tuple[DataFrame, list[str]]:
    """The rows of both sides, dealt out by the keys that they are to be grouped by: each pair of a left and a right member of a group, as :func:`group_join` finds it, has one group in common.

    Null keys are left out."""
    keys = [groups.key]
    if groups.hot is not None:
        zero = F.lit(0)
        left = _cells(with_block(left, members[0], groups, "l"), "cell_l", "cell_r", zero, F.col("blocks_r") - 1)
        right = _cells(with_block(right, members[1], groups, "r"), "cell_r", "cell_l", zero, F.col("blocks_l") - 1)
        keys += ["cell_l", "cell_r"]
    rows = left.unionByName(right, allowMissingColumns=True)
    return rows.where(F.col(groups.key).isNotNull()).repartition(groups.join_tasks, *keys), keys


def group_lists_join(listed: DataFrame, others: DataFrame, groups: Groups, members: tuple[str, str], swapped: bool = False, tasks: int | None = None) -> DataFrame:
    """:func:`group_join` with the rows of ``listed`` as a list ``own``, in the order of their member, next to each row of ``others``.

    ``listed`` is the left side of ``groups``, or the right one if ``swapped``. In hot groups, a row of ``others`` comes once for each block of its group on the other side.
    Dealt out to as many ``tasks`` as :func:`pair_lists` with the same rows and columns, the lists are those that it makes of groups that are not hot: rows are sent once.
    """
    keys = [groups.key]
    columns = [members[0], *[c for c in listed.columns if c not in (groups.key, members[0])]]
    if groups.hot is not None:
        own, other = ("r", "l") if swapped else ("l", "r")
        zero = F.lit(0)
        listed = _cells(with_block(listed, members[0], groups, own), f"cell_{own}", f"cell_{other}", zero, F.col(f"blocks_{other}") - 1)
        others = _cells(with_block(others, members[1], groups, other), f"cell_{other}", f"cell_{own}", zero, F.col(f"blocks_{own}") - 1)
        keys += ["cell_l", "cell_r"]
    tasks = tasks or groups.join_tasks
    lists = listed.where(F.col(groups.key).isNotNull()).repartition(tasks, *keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("own"))
    return others.repartition(tasks, *keys).join(lists, keys).drop("cell_l", "cell_r")


def dealt(df: DataFrame, rows: float, *keys: str) -> DataFrame:
    """Deal rows out by the keys to as many partitions as ``rows`` of them need, if the session's setting has too few.

    An aggregation or a join on the same keys that follows needs no other shuffle. Below that number, the shuffle is left to them:
    they combine rows before it.
    """
    partitions = min(math.ceil(rows / PAIRS_PER_PARTITION), MOST_TASKS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys) if partitions > usual else df
