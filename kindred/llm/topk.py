"""Exact top-k search by an impact-ordered index, a score at a time.

Vectors are quantised to integers, and a score is an integer inner product. Vectors are dealt into blocks. The postings of a block,
one per vector and dimension, are ordered by their impact, the magnitude of the value, and cut into segments by quantised impact.
For many queries at once, segments are processed in falling order, and sums kept per query and vector. After each segment,
no sum can gain more than the length of what is left of the vector times that of the query. Processing stops on proof
only: when few vectors are left that can still reach the k-th best score known, or when nothing is left. Those vectors are scored exactly. The k-th
best score known is that of the leaders after the first segment.

Query blocks meet row blocks in cells of bounded size, each a task of its own; the k best of each cell are merged.

Defined results: vectors that are null, or hold null or non-finite components, are neither queries nor candidates. Shorter vectors count
as if filled up with zeros. Vectors with a component beyond 2^28 after quantisation are not in the index: they are scored as whole numbers of any size.
A score among the best that does not fit a long fails. Rows with the query's own id are not its candidates;
other repeated rows are candidates each, and queries with the same id share one list. Ties go to the smaller id. An empty table gives an empty table. Other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import staged

SCALE = 64
ROW_BLOCK, QUERY_BLOCK = 16_384, 1_024
QUERIES_AT_ONCE = 64
SEGMENTS = (0.6, 0.25, 0.0)  # shares of the postings that have less impact than a segment's
MEMBERS = 0.02  # share of a block that is scored exactly at once
EXACT = 2.0**53  # sums of products below this are exact in double precision
BOUND = float(2**28)


def usable(vector: Column) -> Column:
    """Whether a vector is there, and all of its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False))), F.lit(False))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def is_wide(vector: Column, scale: int = SCALE) -> Column:
    """Whether a component's integer is beyond ``BOUND``: such vectors are scored as whole numbers of any size."""
    return F.exists(vector, lambda x: F.abs(x.cast("double")) * scale >= F.lit(BOUND))


def integers(vector: np.ndarray, scale: int) -> list[int]:
    """``floor(scale * x)`` of finite numbers of any size; beyond 2^53 they are whole numbers themselves."""
    return [int(x) * scale if abs(x) >= EXACT else math.floor(x * scale) for x in map(float, vector)]


class ImpactIndex:
    """The postings of a block of integer vectors, in segments of falling impact.

    The impact of a posting is the magnitude of its value, quantised to the ``SEGMENTS``: a segment is held as the vectors
    with zeros in place of the postings of other segments, so that a segment is processed for many queries at once.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        impacts = np.abs(vectors)
        limits = [float(np.quantile(impacts, share)) if impacts.size else 0.0 for share in SEGMENTS]
        self.segments, self.left = [], []
        above = np.zeros(vectors.shape, dtype=bool)
        for limit in limits:
            here = (impacts >= limit) & ~above
            above |= here
            self.segments.append(np.where(here, vectors, 0.0))
            # The length of what has not been processed of each vector.
            self.left.append(np.sqrt((np.where(above, 0, vectors).astype(float) ** 2).sum(1)))

    def search(self, queries: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and exact scores of the ``k`` best vectors and of all that tie with the last.

        ``own`` is a mask of the vectors that are no candidates of a query.
        """
        n = len(self.vectors)
        sums = np.where(own, -np.inf, 0.0)
        lengths = np.sqrt((queries.astype(float) ** 2).sum(1)) * (1 + 1e-9)
        threshold = np.full(len(queries), -np.inf)
        gain = np.zeros(sums.shape)
        for step, (segment, left) in enumerate(zip(self.segments, self.left)):
            sums += queries @ segment.T
            if n <= 2 * k:
                continue
            if step == 0:
                # The exact scores of the leaders: the k-th best score is not below the k-th of theirs.
                leaders = np.argpartition(-sums, k, axis=1)[:, : k + 1]
                for i, places in enumerate(leaders):
                    known = np.sort((self.vectors[places] @ queries[i])[~own[i, places]])
                    threshold[i] = known[-k] if len(known) >= k else -np.inf
            # No vector can gain more than the product of the lengths of what is left of it and of the query.
            gain = np.outer(lengths, left)
            if ((sums + gain >= threshold[:, None]).sum(1) <= max(4 * k, MEMBERS * n)).all():
                break
        else:
            gain = np.zeros(1)
        members = sums + gain >= threshold[:, None]
        found = []
        for i, row in enumerate(members & ~own):
            places = np.flatnonzero(row)
            scores = self.vectors[places].astype(np.int64) @ queries[i].astype(np.int64)
            if len(scores) > k:
                kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                places, scores = places[kept], scores[kept]
            found.append((places, scores))
        return found


def _matrix(packed: pd.Series) -> np.ndarray:
    """The vectors as rows, filled up with zeros; those of wide vectors are all zeros."""
    rows = [np.frombuffer(v, dtype=">i4") if v is not None else np.zeros(0, dtype=np.int64) for v in packed]
    matrix = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for i, row in enumerate(rows):
        matrix[i, : len(row)] = row
    return matrix


def _whole_scores(query: list[int], vectors: np.ndarray, wide: dict[int, list[int]]) -> np.ndarray:
    """The scores of all rows as numbers without a limit."""
    width = min(len(query), vectors.shape[1])
    scores = vectors[:, :width].astype(object) @ np.array(query[:width], dtype=object) if width else np.zeros(len(vectors), dtype=object)
    for place, row in wide.items():
        scores[place] = sum(a * b for a, b in zip(query, row))
    return scores


def _cell_search(k: int, scale: int):
    def search(cell: pd.DataFrame) -> pd.DataFrame:
        queries, rows = cell[cell["asks"]], cell[~cell["asks"]]
        both = _matrix(pd.concat([rows["vector"], queries["vector"]]))
        wide = {i: integers(v, scale) for i, v in enumerate(rows["wide"]) if v is not None}
        wide_queries = {i: integers(v, scale) for i, v in enumerate(queries["wide"]) if v is not None}
        ids, asking = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        squares = (np.abs(both).max(axis=0, initial=0).astype(float) ** 2).sum()
        index, asked = ImpactIndex(both[: len(rows)]), both[len(rows) :]
        is_wide_row = np.isin(np.arange(len(ids)), list(wide))
        found = []
        for start in range(0, len(asked) if len(ids) else 0, QUERIES_AT_ONCE):
            part = slice(start, start + QUERIES_AT_ONCE)
            own = asking[part, None] == ids[None, :]
            # Sums beyond the exact range of doubles are taken as whole numbers.
            best = index.search(asked[part].astype(float), k, own | is_wide_row) if squares < EXACT else [None] * len(own)
            for i, (query_id, ours, known) in enumerate(zip(asking[part], own, best), start):
                if known is None or i in wide_queries:
                    places = np.flatnonzero(~ours)
                    scores = _whole_scores(wide_queries.get(i, asked[i].tolist()), index.vectors, wide)[places]
                else:
                    places, scores = known
                    if wide:
                        others = np.array([p for p in wide if not ours[p]], dtype=np.int64)
                        more = [sum(a * b for a, b in zip(asked[i].tolist(), wide[p])) for p in others.tolist()]
                        places, scores = np.append(places, others), np.append(scores.astype(object), np.array(more, dtype=object))
                first = np.lexsort((ids[places], -scores))[:k] if scores.dtype != object else np.array(
                    sorted(range(len(places)), key=lambda j: (-scores[j], ids[places[j]]))[:k], dtype=np.int64  # noqa: B023
                )
                if any(not -(2**63) <= int(x) < 2**63 for x in scores[first]):
                    raise OverflowError("a score does not fit a long")
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[places][first], "score": scores[first].astype(np.int64)}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(found) if found else empty

    return search


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20, scale: int = SCALE, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query ``(vec_id, embedding)`` the ``k`` rows of the highest score."""

    def packed(df: DataFrame, asks: bool, name: str) -> DataFrame:
        vector = F.col("embedding")
        chosen = df.where(usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("x"))
        wide = is_wide(F.col("x"), scale)
        # The integers as bytes: four each, the highest first.
        digits = F.transform(quantised(F.col("x"), scale), lambda x: F.lpad(F.hex(F.pmod(x.cast("long"), F.lit(2**32))), 8, "0"))
        packed_digits = F.when(~wide, F.unhex(F.array_join(digits, "")))
        return staged(chosen.select("vec_id", packed_digits.alias("vector"), F.when(wide, F.col("x")).alias("wide"), F.lit(asks).alias("asks")), name)

    asked, listed = packed(queries.where("vec_id is not null"), True, "topk-queries"), packed(rows, False, "topk-rows")
    n_queries, n_rows = math.ceil(asked.count() / query_block) or 1, math.ceil(listed.count() / row_block) or 1
    own_block = lambda n: F.pmod(F.xxhash64("vec_id", "vector", "wide"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = asked.withColumn("q", own_block(n_queries)).withColumn("r", every(n_rows)).unionByName(
        listed.withColumn("r", own_block(n_rows)).withColumn("q", every(n_queries))
    )
    cells = cells.repartition(n_queries * n_rows, "q", "r")
    found = cells.groupBy("q", "r").applyInPandas(_cell_search(k, scale), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
