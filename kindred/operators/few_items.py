"""All pairs of very many users over few items, reduced where they are multiplied.

With few items nearly all users have one in common, and the pairs can neither be rows nor be thinned out: each is multiplied. What a pair costs is what counts then, so

* a block of users is one row with one dense matrix of their weights, as bytes: sent and read without a look at its numbers. What was not rated is not a number;
* blocks meet in a Cartesian product, each unordered pair of blocks once, and are multiplied tile by tile in single precision. The error of such a product has a bound. Only products
  that the bound leaves open (near zero, or near what a user's neighbours have already) are computed again in double precision;
* overlaps are hardly multiplied at all. Their sums follow from the pairs of items, the largest one is that of a user with itself, and two users can only be without a common item if
  their numbers of items do not add up to more than there are.

The work still grows with the square of the users, over any number of tasks; memory does not, and what is written grows with the users.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.neighbours import placed
from kindred.operators.similarity import summary_of_counts
from kindred.params import SIMILARITY_DECIMALS
from kindred.session import staged

# More items than these are not few; a matrix of a block has a column for each.
MOST_ITEMS = 1024
# More neighbours than these are not kept for all users that a task meets.
MOST_NEIGHBOURS = 64
# Entries of a block's matrix, and its users, at most.
BLOCK_ENTRIES = 1 << 19
BLOCK_USERS = 4096
# Blocks of either side that a task multiplies.
BLOCKS_AT_HAND = 16
TILE = (256, 1024)

UNIT = float(10**SIMILARITY_DECIMALS)
BLOCK = "block int, users binary, weights binary, least binary, n_users long, n_lowest long, n_largest long"


def item_ids(normed: DataFrame) -> np.ndarray | None:
    """The ids of the items in their order, if they are few."""
    found = normed.select("item_id").where(F.col("item_id").isNotNull()).distinct().limit(MOST_ITEMS + 1).collect()
    return np.sort(np.array([r.item_id for r in found], dtype=np.int64)) if 0 < len(found) <= MOST_ITEMS else None


def rounded(dots: np.ndarray) -> np.ndarray:
    return np.rint(dots * UNIT) / UNIT


def error_bound(items: int, norms: float) -> float:
    """What a single-precision product of two vectors, whose norms multiply to ``norms`` at most, differs from the rounded double one at most."""
    return (items + 8) * 2.0**-22 * norms + 2 / UNIT


class Block:
    """The users of a row of :func:`user_matrices`, which items they have rated, and in both precisions the weights of those that have some."""

    def __init__(self, users: bytes, weights: bytes, least: bytes, items: int):
        self.users = np.frombuffer(users, dtype=np.int32)
        given = np.frombuffer(weights, dtype=np.float64).reshape(len(self.users), items)
        self.rated = ~np.isnan(given)
        self.sizes = np.count_nonzero(self.rated, axis=1)
        self.exact = np.nan_to_num(given)
        self.exact = self.exact[self.exact.any(axis=1)]
        self.single = self.exact.astype(np.float32)
        self.turned = np.ascontiguousarray(self.single.T)
        self.least = np.frombuffer(least, dtype=np.float64)
        self.norm = math.sqrt((self.exact * self.exact).sum(axis=1).max(initial=0.0))


def _blocks_of(cell, kept: dict, items: int) -> tuple[Block, Block]:
    """The two blocks of a cell; those of the cells before are kept, up to as many as a task has of either side."""
    found = []
    for side in ("l", "r"):
        key = getattr(cell, f"block_{side}")
        if key not in kept:
            while len(kept) >= BLOCKS_AT_HAND + 2:
                del kept[next(iter(kept))]
            kept[key] = Block(*[getattr(cell, f"{c}_{side}") for c in ("users", "weights", "least")], items)
        found.append(kept[key])
    return found[0], found[1]


def _reaching(weights: np.ndarray, k: int) -> np.ndarray:
    """For each user, the positive similarity that ``k`` others of the block have at least; minus infinity where there are not so many."""
    least = np.full(len(weights), -np.inf)
    if len(weights) > k:
        for start in range(0, len(weights), TILE[0]):
            sims = rounded(weights[start : start + TILE[0]] @ weights.T)
            sims[np.arange(len(sims)), start + np.arange(len(sims))] = -np.inf
            least[start : start + TILE[0]] = np.partition(sims, -k, axis=1)[:, -k]
    return np.where(least > 0, least, -np.inf)


def user_matrices(normed: DataFrame, items: np.ndarray, block_users: int, k: int | None = None) -> tuple[DataFrame, int]:
    """A row for each block of users, as a table, and about how many there are.

    With ``k``, only users whose weights are not all zero, in the order of their ids, with ``least``, a similarity that the user's k-th neighbour has at least; without, all users, in the
    order of their numbers of items. Of several ratings of a user for an item, one is kept."""
    normed = normed.where(F.col("item_id").isNotNull())
    users = normed.agg(F.approx_count_distinct("user_id")).first()[0]
    blocks = max(1, math.ceil(users / max(1, min(block_users, BLOCK_ENTRIES // len(items)))))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        users, at = np.unique(rows["user_id"].to_numpy(), return_inverse=True)
        weights = np.full((len(users), len(items)), np.nan)
        weights[at, np.searchsorted(items, rows["item_id"].to_numpy())] = np.nan_to_num(rows["pre"].to_numpy(dtype=np.float64))
        sizes, some = np.count_nonzero(~np.isnan(weights), axis=1), np.nan_to_num(weights).any(axis=1)
        order = np.argsort(sizes, kind="stable") if k is None else np.flatnonzero(some)
        users, weights = users[order], weights[order]
        least = b"" if k is None else _reaching(np.nan_to_num(weights), k).tobytes()
        row = (rows["block"].iloc[0], users.astype(np.int32).tobytes(), weights.tobytes(), least, len(sizes), sizes.min(), sizes.max())
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])

    rows = normed.select(F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int").alias("block"), "user_id", "item_id", "pre")
    cores = normed.sparkSession.sparkContext.defaultParallelism
    dealt = rows.repartition(max(min(blocks, 4 * cores), math.ceil(blocks / BLOCKS_AT_HAND)), "block")
    return staged(dealt.groupBy("block").applyInPandas(packed, BLOCK), "user-matrices"), blocks


def block_cells(table: DataFrame, blocks: int) -> DataFrame:
    """A row for each unordered pair of blocks, with ``_l`` and ``_r`` at their columns. The blocks are in ranges of their numbers, so that a task has all cells of two ranges or none."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    ranges = min(blocks, max(math.ceil(blocks / BLOCKS_AT_HAND), math.ceil(math.sqrt(8 * cores))))
    side = lambda name: table.select(*[F.col(c).alias(f"{c}_{name}") for c in ("block", "users", "weights", "least")]).repartitionByRange(ranges, f"block_{name}")
    return side("l").crossJoin(side("r").hint("shuffle_replicate_nl")).where(F.col("block_l") <= F.col("block_r"))


def _products(left: Block, right: Block) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """The products of the tiles in single precision, all in one place: the next one overwrites the last."""
    place = np.empty(TILE[0] * TILE[1], dtype=np.float32)
    for i in range(0, len(left.exact), TILE[0]):
        own = left.single[i : i + TILE[0]]
        for j in range(0, len(right.exact), TILE[1]):
            other = right.turned[:, j : j + TILE[1]]
            product = place[: len(own) * other.shape[1]].reshape(len(own), other.shape[1])
            yield slice(i, i + len(own)), slice(j, j + other.shape[1]), np.matmul(own, other, out=product)


def _places(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero``, which is many times faster in one dimension where few are chosen."""
    return np.divmod(np.flatnonzero(chosen.ravel()), chosen.shape[1])


def similar_pairs(left: Block, right: Block) -> int:
    """How many of all pairs of a left and a right user have a similarity that is not rounded to zero."""
    bound = np.float32(error_bound(left.exact.shape[1], left.norm * right.norm))
    found = len(left.exact) * len(right.exact)
    for rows, columns, product in _products(left, right):
        near = np.abs(product, out=product) <= bound
        open_ones = np.count_nonzero(near)
        if open_ones * 8 > near.size:
            found -= np.count_nonzero(rounded(left.exact[rows] @ right.exact[columns].T) == 0)
        elif open_ones:
            i, j = _places(near)
            found -= np.count_nonzero(rounded(np.einsum("ij,ij->i", left.exact[rows][i], right.exact[columns][j])) == 0)
    return found


def few_in_common(left: Block, right: Block, lowest: float) -> tuple[int, float]:
    """The number of pairs of a left and a right user without a common item, and the smallest positive number of common items, or ``lowest`` if that is not more. Users are in the
    order of their sizes: who cannot have so few in common is not multiplied."""
    items, apart = left.exact.shape[1], 0
    for start in range(0, len(right.users), TILE[0]):
        columns = slice(start, start + TILE[0])
        # Less than the lowest, or nothing, only if the sizes exceed the number of items by less.
        rows = np.searchsorted(left.sizes, items + max(lowest, 1) - 1 - right.sizes[start], side="right")
        for begin in range(0, rows, TILE[1]):
            common = left.rated[begin : min(begin + TILE[1], rows)].astype(np.float32) @ right.rated[columns].astype(np.float32).T
            apart += common.size - np.count_nonzero(common)
            lowest = min(lowest, common.min(where=common > 0.5, initial=np.inf))
    return apart, lowest


def cell_counts(items: int, lowest: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``(apart, similar, lowest)``: the pairs without a common item, those with a similarity other than zero, and the smallest number of common items where that is less than ``lowest``."""

    def counts(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, Block] = {}
        apart, similar, low = 0, 0, float(lowest)
        for batch in cells:
            for cell in batch.itertuples():
                left, right = _blocks_of(cell, kept, items)
                lone, low = few_in_common(left, right, low)
                alike = similar_pairs(left, right)
                if cell.block_l == cell.block_r:  # all ordered pairs, and the users with themselves, who have something in common
                    own = np.count_nonzero(rounded(np.einsum("ij,ij->i", left.exact, left.exact)))
                    lone, alike = lone // 2, (alike + own) // 2
                apart, similar = apart + lone, similar + alike
        yield pd.DataFrame({"apart": [apart], "similar": [similar], "lowest": [low]})

    return counts


def common_raters(items: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``(i, j, n)``: how many users have rated two items, for the blocks of a task."""

    def counts(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((items, items))
        for batch in blocks:
            for weights in batch["weights"]:
                rated = (~np.isnan(np.frombuffer(weights, dtype=np.float64).reshape(-1, items))).astype(np.float32)
                found += rated.T @ rated
        i, j = np.nonzero(found)
        yield pd.DataFrame({"i": i, "j": j, "n": found[i, j].astype(np.int64)})

    return counts


def pair_summary_of_few(normed: DataFrame, items: np.ndarray, n_users: int, block_users: int = BLOCK_USERS) -> DataFrame:
    """:func:`kindred.operators.similarity.pair_summary` of all pairs of users."""
    table, blocks = user_matrices(normed, items, block_users)
    users = table.agg(F.sum("n_users").alias("n_users"), F.min("n_lowest").alias("n_lowest"), F.max("n_largest").alias("n_largest"))
    cells = block_cells(table, blocks).mapInPandas(cell_counts(len(items), users.first().n_lowest), "apart long, similar long, lowest double")
    counted = cells.agg(F.sum("apart").alias("apart"), F.sum("similar").alias("pairs_nonzero"), F.min("lowest").alias("lowest"))
    # Ordered pairs of users and pairs of items count the same, see kindred.operators.overlaps; a user's pair with itself is there once.
    raters = table.select("weights").mapInPandas(common_raters(len(items)), "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").cast("double").alias("n"))
    n, own = F.col("n"), F.col("i") == F.col("j")
    by_items = raters.agg(F.sum(n * n).alias("squares"), F.sum(F.when(own, n * n)).alias("totals"), F.sum(F.when(own, n)).alias("ratings"))
    sizes = table.select("weights").mapInPandas(_squared_sizes(len(items)), "own double").agg(F.sum("own").alias("own"))
    among = lambda c: (F.col(c) * (F.col(c) + 1) / 2).cast("long")
    found = counted.crossJoin(users).crossJoin(by_items).crossJoin(sizes).select(
        (among("n_users") - F.col("apart")).alias("n"),
        "pairs_nonzero",
        "lowest",
        F.col("n_largest").cast("double").alias("max_overlap"),
        ((F.col("totals") + F.col("ratings")) / 2).alias("total"),
        ((F.col("squares") + F.col("own")) / 2).alias("squares"),
    )
    return summary_of_counts(found, n_users)


def _squared_sizes(items: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def squares(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in blocks:
            sizes = [np.count_nonzero(~np.isnan(np.frombuffer(w, dtype=np.float64).reshape(-1, items)), axis=1).astype(np.float64) for w in batch["weights"]]
            yield pd.DataFrame({"own": [float((s * s).sum()) for s in sizes]})

    return squares


class Best:
    """The ``k`` best neighbours found so far of each user of a block.

    ``least`` is a similarity that the k-th of all has at least. Without one, the user is *open*: there may be fewer than ``k`` positive similarities, so those that are not zero are
    ``listed`` (counted) and the negative ones ranked too."""

    def __init__(self, block: Block, k: int):
        self.k, self.users, self.least = k, block.users, block.least.copy()
        self.open = np.flatnonzero(np.isneginf(self.least))
        self.ids = np.zeros((len(self.users), k), dtype=np.int32)
        self.sims = np.full((len(self.users), k), -np.inf)
        self.listed = np.zeros(len(self.users), dtype=np.int64)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def cuts(self, bound: float) -> np.ndarray:
        """What a product in single precision must reach. Open users are not found in this way."""
        cut = np.where(np.isneginf(self.least), np.inf, self.least - bound)
        return cut.astype(np.float32)

    def add(self, at: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        enough = sims >= self.least[at]
        self.found.append((at[enough], ids[enough], sims[enough]))

    def merge(self) -> None:
        at, ids, sims = [np.concatenate(c) for c in zip(*self.found)] if self.found else (np.empty(0, np.int64),) * 3
        self.found = []
        if not len(at):
            return
        rows = np.unique(at)
        at = np.concatenate([np.repeat(rows, self.k), at])
        ids, sims = np.concatenate([self.ids[rows].ravel(), ids]), np.concatenate([self.sims[rows].ravel(), sims])
        order = np.lexsort((ids, -sims, at))
        ranked = at[order]
        place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        kept = place < self.k
        order, ranked, place = order[kept], ranked[kept], place[kept]
        self.ids[ranked, place], self.sims[ranked, place] = ids[order], sims[order]
        closed = rows[~np.isneginf(self.least[rows])]
        self.least[closed] = np.maximum(self.least[closed], self.sims[closed, -1])

    def rows(self) -> pd.DataFrame:
        i, j = np.nonzero(self.sims > -np.inf)
        return pd.DataFrame({"u": self.users[i], "v": self.ids[i, j], "sim": self.sims[i, j], "listed": np.where(j == 0, self.listed[i], 0)})


def _all_of(best: Best, rows: np.ndarray, own: Block, other: Block, same: bool, counted: bool, columns: slice = slice(None)) -> None:
    """The ``k`` best of some rows among the other block's users, all of them computed in double precision; ties go to the smaller id, which is first."""
    for start in range(0, len(rows), TILE[0]):
        some = rows[start : start + TILE[0]]
        sims = rounded(own.exact[some] @ other.exact[columns].T)
        if same:
            sims[own.users[some][:, None] == other.users[columns][None, :]] = 0.0
        if counted:
            best.listed[some] += np.count_nonzero(sims, axis=1)
        sims[sims == 0] = -np.inf
        first = np.argsort(-sims, axis=1, kind="stable")[:, : best.k]
        values = np.take_along_axis(sims, first, axis=1)
        i, j = np.nonzero(values > -np.inf)
        best.add(some[i], other.users[columns][first[i, j]], values[i, j])


def add_cell(left: Block, right: Block, mine: Best, theirs: Best, same: bool) -> None:
    """Add the pairs of two blocks to the best of both; of a block with itself, to those of the left only."""
    bound = error_bound(left.exact.shape[1], left.norm * right.norm)
    cut_l, cut_r = mine.cuts(bound), theirs.cuts(bound)
    for rows, columns, product in _products(left, right):
        sides = [(mine, left, right, rows, columns, product, cut_l, 1)]
        if not same:
            sides.append((theirs, right, left, columns, rows, product.T, cut_r, 0))
        for best, own, other, here, there, seen, cut, axis in sides:
            hit = np.flatnonzero(product.max(axis=axis) >= cut[here])
            if len(hit):
                near = seen[hit] >= cut[here][hit][:, None]
                i, j = _places(near)
                if len(i) * 8 > near.size and len(i) > 8 * best.k * len(hit):
                    _all_of(best, here.start + hit, own, other, same, False, there)
                    continue
                at, to = here.start + hit[i], there.start + j
                sims = rounded(np.einsum("ij,ij->i", own.exact[at], other.exact[to]))
                apart = (own.users[at] != other.users[to]) if same else np.True_
                best.add(at[apart & (sims > 0)], other.users[to[apart & (sims > 0)]], sims[apart & (sims > 0)])
    _all_of(mine, mine.open, left, right, same, True)
    if not same:
        _all_of(theirs, theirs.open, right, left, same, True)
    mine.merge()
    theirs.merge()


def cell_neighbours(items: int, k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``(u, v, sim, listed)``: for the users of all blocks that a task meets, the ``k`` best of those that they meet there, unless ``k`` better ones are known. ``listed`` is, on one row of
    each open user, the number of similarities other than zero."""

    def reduce(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, Block] = {}
        best: dict[int, Best] = {}
        for batch in cells:
            for cell in batch.itertuples():
                left, right = _blocks_of(cell, kept, items)
                for key, block in ((cell.block_l, left), (cell.block_r, right)):
                    if key not in best:
                        best[key] = Best(block, k)
                add_cell(left, right, best[cell.block_l], best[cell.block_r], cell.block_l == cell.block_r)
        for found in best.values():
            yield found.rows()

    return reduce


def nearest_of_few(normed: DataFrame, items: np.ndarray, n_users: int, k: int, block_users: int = BLOCK_USERS) -> DataFrame:
    """:func:`kindred.operators.neighbours.nearest` of all pairs of users."""
    table, blocks = user_matrices(normed, items, block_users, k)
    found = block_cells(table, blocks).mapInPandas(cell_neighbours(len(items), k), "u int, v int, sim double, listed long")
    best, everyone = Window.partitionBy("u").orderBy(F.desc("sim"), "v"), Window.partitionBy("u")
    ranked = found.select("u", "v", "sim", F.row_number().over(best).alias("rank"), F.sum("listed").over(everyone).alias("n_listed"))
    return placed(ranked.where(F.col("rank") <= k), n_users, k)
