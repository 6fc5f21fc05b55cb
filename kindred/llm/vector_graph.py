"""Near-duplicate vectors by a flat graph of pruned neighbour lists.

1. Equal vectors are one class. Every class goes to the shards of the ``OVERLAP`` centroids nearest to it; the centroids are those of
   at most ``SAMPLE`` vectors, chosen by a hash.
2. In each shard, every vector gets a list of near neighbours, robustly pruned: a neighbour that is much nearer to one already in
   the list than to the vector itself is left out, so that lists point in all directions. A few links across the shard are added.
3. The lists of a vector in its shards are united.
4. In each shard, every vector is searched for on the united lists: greedily from the medoid, keeping the best ``BEAM`` found,
   then expanding through all that lie within the range and a margin around it, until nothing new is met. Cosines of what is
   found are taken in double precision, and only those of at least the threshold are links.
5. The recall of links is audited against all vectors on a sample; below ``RECALL``, the work is done again with twice the overlap.

A link is counted by the first shard that holds both ends, and of the links only a spanning forest of each shard leaves its task, so a group
of thousands of near copies costs no pairs. A shard of more than ``SHARD`` vectors is cut into blocks, and each pair of blocks is a
shard of its own: no task grows with the input, and no pair of a hot shard is left out.

Defined results: vectors that are null, empty, of zero length, or hold null or non-finite components are linked with nothing, and so are their own
component; vectors of another number of components than the largest are filled up with zeros. Repeated rows are vectors of their own, linked
with each other. Rows with a null id take part; a component's id is its smallest, null if it has none. An empty table gives an
empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.graph import components
from kindred.llm.topk import usable
from kindred.session import staged

THRESHOLD = 0.95
MARGIN = 0.05  # how far below the threshold the search still expands
OVERLAP, SHARD, PER_CENTROID, CENTROIDS, SAMPLE = 3, 4096, 700, 1024, 16_384
NEIGHBOURS, DEGREE, PRUNE, LONG_LINKS, BEAM = 32, 12, 1.2, 3, 12
AT_ONCE = 256
RECALL, AUDITED = 0.97, 256


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """The vectors as rows of length one, in double precision; scaled first, so that squares neither overflow nor vanish."""
    width = max(map(len, vectors), default=0)
    matrix = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        matrix[i, : len(v)] = v
    matrix /= np.abs(matrix).max(axis=1, keepdims=True, initial=1e-300)
    return matrix / np.sqrt((matrix**2).sum(axis=1, keepdims=True))


def classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(vec_id, node)`` of all rows, ``node`` null for those that cannot be linked, and ``(node, copies, vector)`` of the classes."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    can = usable(F.col("embedding")) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(can, vector).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    found = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    return staged(rows.select("vec_id", "node"), "vectors"), staged(found, "vector-classes")


def centroids(found: DataFrame, count: int) -> np.ndarray:
    """Spherical k-means on a bounded sample: as many of the vectors of the smallest hashes as ``SAMPLE`` allows."""
    chosen = found.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / max(count, 1)))))
    rows = chosen.orderBy("node").select("vector").limit(SAMPLE).toPandas()
    x = unit_rows(rows["vector"])
    k = min(len(x), CENTROIDS, max(1, math.ceil(count / PER_CENTROID)))
    if not k:
        return np.zeros((0, 0))
    means = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(8):
        nearest = np.concatenate([(x[i : i + 2048] @ means.T).argmax(1) for i in range(0, len(x), 2048)])
        sums = np.zeros_like(means)
        np.add.at(sums, nearest, x)
        lengths = np.sqrt((sums**2).sum(1, keepdims=True))
        means = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), means)
    return means


def _assigned(found: DataFrame, means: np.ndarray, overlap: int) -> DataFrame:
    """``(node, copies, vector, homes)``: the shards of each class, in order."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit_rows(pd.Series(batch.column("vector").to_pylist()))
            width = min(x.shape[1], means.shape[1])
            near = x[:, :width] @ means[:, :width].T
            homes = np.sort(np.argsort(-near, axis=1, kind="stable")[:, :overlap], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(homes), pa.list_(pa.int32()))], [*batch.schema.names, "homes"])

    return found.mapInArrow(assign, "node long, copies long, vector array<double>, homes array<int>")


def _cells(assigned: DataFrame, per_shard: int) -> DataFrame:
    """A row per class and cell: ``(shard, lo, hi, node, copies, vector, homes, block)``."""
    members = assigned.withColumn("shard", F.explode("homes"))
    # As many rows as there are centroids.
    sizes = members.groupBy("shard").count().select("shard", F.when(F.col("count") > per_shard, F.ceil(F.col("count") * 2 / per_shard)).otherwise(1).cast("int").alias("blocks"))
    cut = members.join(F.broadcast(sizes), "shard").withColumn("block", F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int"))
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks")


def pruned_neighbours(x: np.ndarray, neighbours: int = NEIGHBOURS, degree: int = DEGREE) -> np.ndarray:
    """Robustly pruned lists of near neighbours, ``-1`` where a list is shorter."""
    n = len(x)
    lists = np.full((n, degree), -1, dtype=np.int64)
    k = min(neighbours, n - 1)
    if k < 1:
        return lists
    for start in range(0, n, AT_ONCE):
        near = x[start : start + AT_ONCE] @ x.T
        rows = np.arange(len(near))
        near[rows, rows + start] = -np.inf
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable"), 1)
        far = 1 - np.take_along_axis(near, best, 1)
        between = 1 - np.einsum("qid,qjd->qij", x[best], x[best])
        alive, filled = np.ones(best.shape, dtype=bool), np.zeros(len(near), dtype=np.int64)
        for i in range(k):
            take = alive[:, i] & (filled < degree)
            lists[start + rows[take], filled[take]] = best[take, i]
            filled[take] += 1
            # Whatever the new neighbour is much nearer to than the vector itself.
            alive[take] &= PRUNE * between[take, i, :] > far[take]
    return lists


def with_long_links(lists: np.ndarray, links: int = LONG_LINKS) -> np.ndarray:
    """The lists with ``links`` members each from all over the shard, and back from those: the vectors of a dense group are
    all near to each other, and would else neither be left nor met."""
    n = len(lists)
    draw = np.random.default_rng(n).integers(0, n, size=(n, links))
    back = np.full((n, 3 * links), -1, dtype=np.int64)
    target, source = draw.ravel(), np.repeat(np.arange(n), links)
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    fits = place < back.shape[1]
    back[target[fits], place[fits]] = source[fits]
    return np.hstack([lists, draw, back])


def range_search(x: np.ndarray, lists: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """``found[i, j]``: whether the search for ``i`` on the lists met ``j`` at no less than the threshold.

    It begins at the medoid and at the own list of ``i``, which is a node of the graph itself: a small group far from all others may not be
    met from the medoid."""
    n = len(x)
    lists = np.where(lists < 0, np.arange(n)[:, None], lists)
    middle = x.mean(axis=0)
    medoid = int((x @ middle).argmax())
    found = np.zeros((n, n), dtype=bool)
    for start in range(0, n, AT_ONCE):
        near = x[start : start + AT_ONCE] @ x.T
        met, expanded = np.zeros(near.shape, dtype=bool), np.zeros(near.shape, dtype=bool)
        met[:, medoid] = True
        met[np.arange(len(near))[:, None], lists[start : start + AT_ONCE]] = True
        active = np.arange(len(near))
        while len(active):  # greedily: expand what is not yet expanded of the best met
            seen = np.where(met[active], near[active], -np.inf)
            best = np.argpartition(-seen, min(BEAM, n) - 1, axis=1)[:, :BEAM]
            fresh = met[active[:, None], best] & ~expanded[active[:, None], best]
            q, place = np.nonzero(fresh)
            nodes, rows = best[q, place], active[q]
            expanded[rows, nodes] = True
            met[rows[:, None], lists[nodes]] = True
            active = active[fresh.any(axis=1)]
        wide = near >= threshold - MARGIN
        while True:  # expand all within the range and its margin
            rows, nodes = np.nonzero(met & wide & ~expanded)
            if not len(rows):
                break
            expanded[rows, nodes] = True
            met[rows[:, None], lists[nodes]] = True
        found[start : start + AT_ONCE] = met & (near >= threshold)
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def all_in_range(x: np.ndarray, threshold: float) -> np.ndarray:
    """The same without a graph."""
    found = np.zeros((len(x), len(x)), dtype=bool)
    for start in range(0, len(x), AT_ONCE):
        found[start : start + AT_ONCE] = x[start : start + AT_ONCE] @ x.T >= threshold
    np.fill_diagonal(found, False)
    return found


def _forest(found: np.ndarray) -> np.ndarray:
    """The first member of the component of each vector."""
    n = len(found)
    first = np.full(n, -1)
    for i in range(n):
        if first[i] >= 0:
            continue
        reached = np.zeros(n, dtype=bool)
        front = np.array([i])
        reached[i] = True
        while len(front):
            new = found[front].any(axis=0) & ~reached
            reached |= new
            front = np.flatnonzero(new)
        first[reached] = i
    return first


def _build(cell: pd.DataFrame) -> pd.DataFrame:
    cell = cell.sort_values("node", ignore_index=True)
    nodes = cell["node"].to_numpy()
    lists = with_long_links(pruned_neighbours(unit_rows(cell["vector"])))
    return pd.DataFrame({"node": nodes, "near": [nodes[row[row >= 0]] for row in lists]})


def _search(threshold: float, exhaustive: bool):
    def search(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("node", ignore_index=True)
        nodes, copies, block = cell["node"].to_numpy(), cell["copies"].to_numpy(), cell["block"].to_numpy()
        shard, lo, hi = (int(cell[c][0]) for c in ("shard", "lo", "hi"))
        near = [np.asarray(v if v is not None else [], dtype=np.int64) for v in cell["near"]]
        lists = np.full((len(nodes), max(map(len, near), default=0) or 1), -1, dtype=np.int64)
        for i, wanted in enumerate(near):  # lists may name vectors of other shards
            at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
            inside = at[nodes[at] == wanted] if len(wanted) else at
            lists[i, : len(inside)] = inside
        x = unit_rows(cell["vector"])
        found = all_in_range(x, threshold) if exhaustive else range_search(x, lists, threshold)
        first = _forest(found)
        homes = np.stack(cell["homes"].to_list())
        links = np.zeros(len(nodes), dtype=np.int64)
        for i in np.flatnonzero(found.any(axis=1)):
            others = np.flatnonzero(found[i])
            common = homes[others][:, :, None] == homes[i][None, None, :]
            smallest = np.where(common.any(axis=2), homes[others], np.iinfo(np.int32).max).min(axis=1)
            # The cell of this shard that both blocks belong to; within a block, the cell of the block alone.
            mine = (np.minimum(block[others], block[i]) == lo) & (np.maximum(block[others], block[i]) == hi)
            links[i] = copies[others[(smallest == shard) & mine]].sum()
        return pd.DataFrame({"node": nodes, "links": links, "root": nodes[first]})

    return search


def _links(found: DataFrame, means: np.ndarray, overlap: int, threshold: float, per_shard: int, exhaustive: bool = False) -> DataFrame:
    cells = staged(_cells(_assigned(found, means, overlap), per_shard), "vector-cells")
    key = ["shard", "lo", "hi"]
    lists = cells.select(*key, "node", "vector").groupBy(*key).applyInPandas(_build, "node long, near array<long>")
    united = staged(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "neighbour-lists")
    joined = cells.join(united, "node", "left").select(*key, "node", "copies", "vector", "homes", "block", "near")
    return staged(joined.groupBy(*key).applyInPandas(_search(threshold, exhaustive), "node long, links long, root long"), "vector-links")


def audited_recall(found: DataFrame, links: DataFrame, count: int, threshold: float = THRESHOLD) -> float:
    """Of a sample of about ``AUDITED`` classes, compared with all vectors: the share of its links that the search has found, per class that has any,
    on average. So the classes of a dense group do not outweigh isolated pairs."""
    limit = int((1 << 30) * min(1.0, AUDITED / max(count, 1)))
    sample = found.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < F.lit(limit)).orderBy("node").limit(4 * AUDITED).toPandas()
    if not len(sample):
        return 1.0
    asked, nodes = unit_rows(sample["vector"]), sample["node"].to_numpy()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(nodes), dtype=np.int64)
        for batch in batches:
            x = unit_rows(pd.Series(batch.column("vector").to_pylist()))
            width = min(x.shape[1], asked.shape[1])
            near = asked[:, :width] @ x[:, :width].T >= threshold
            near &= nodes[:, None] != batch.column("node").to_numpy()[None, :]
            total += near @ batch.column("copies").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(total)], ["node", "true"])

    true = found.mapInArrow(compare, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    seen = links.groupBy("node").agg(F.sum("links").alias("links"))
    share = F.least("true", F.coalesce("links", F.lit(0))) / F.col("true")
    return true.where(F.col("true") > 0).join(seen, "node", "left").agg(F.coalesce(F.avg(share), F.lit(1.0))).first()[0]


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, per_shard: int = SHARD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    rows, found = classes(embeddings)
    count = found.count()
    means = centroids(found, count)
    while True:
        links = _links(found, means, overlap, threshold, per_shard)
        if audited_recall(found, links, count, threshold) >= RECALL:
            break
        if overlap >= len(means):  # every vector is in every shard: the search misses what they hold
            links = _links(found, means, overlap, threshold, per_shard, exhaustive=True)
            break
        overlap *= 2
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = found.select("node", "copies").join(totals, "node").join(linked, "node", "left")
    named = named.select("node", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    joined = staged(rows.join(named, "node", "left"), "linked-vectors")
    ids = joined.where("node is not null").groupBy("component").agg(F.min("vec_id").alias("first_id"))
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("first_id"))
    result = joined.join(ids, "component", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
