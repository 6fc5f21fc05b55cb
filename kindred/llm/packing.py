"""Best-fit packing of token sequences by bin completion, branch and bound.

A document is its ids, by a file of a byte-level vocabulary (``byte_bpe_50k.tiktoken`` has the ids of ``byte_bpe_50k.json``, whose added tokens
are one id each wherever a text holds them), and an end id. Documents longer than a sequence are cut into full sequences, the first
piece taking what is left over. Pieces are dealt into groups of some thousands, each packed on its own: sequences are filled one after the
other, each around the largest piece that is left. For that piece, the fillings of the remaining room are enumerated that no
other filling dominates, those that waste least first; the search goes on with the best, and returns to the others
while the waste so far leaves hope of fewer sequences than the best packing known, which is at first that of best-fit. A group is done
when it needs no more sequences than its tokens ask for, or after ``NODES`` steps with the best packing known.

A piece's group is drawn from its content and its place in its task, so copies do not meet in one group. Each group wastes less than
a sequence more than its share, one in about a thousand.

Defined results: a null text is like an empty one: the end id alone. Rows that are repeated are packed each. An empty table gives
an empty table. Other columns are ignored; sequence ids say nothing but which pieces share a sequence.
"""

from __future__ import annotations

import base64
import json
import math
import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 4096
NODES, FILLINGS, LOOKS = 20_000, 6, 400


@cache
def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Ids of a text by a file of ranks, and by the added tokens of the JSON file of the same name, if there is one."""
    import public_tokenizers
    import tiktoken

    added, full = {}, os.path.splitext(public_tokenizers.path(vocabulary))[0] + ".json"
    if os.path.exists(full):
        with open(full, encoding="utf-8") as file:
            added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    with open(public_tokenizers.path(vocabulary), "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return partial(encoding.encode, allowed_special=frozenset(added), disallowed_special=())


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def _pieces(vocabulary: str, capacity: int, end_id: int, groups: int, keep_ids: bool) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at = encoder(vocabulary), 0
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "group", *["ids"] * keep_ids]
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * keep_ids]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                tokens = np.array([*encode(text.as_py()), end_id], dtype="<u4")
                for n, (a, size) in enumerate(piece_bounds(len(tokens), capacity)):
                    part = tokens[a : a + size]
                    crc = zlib.crc32(part.tobytes())
                    at += 1
                    rows.append((doc_id, n, a, size, crc, (crc * 0x9E3779B1 + at * 0x85EBCA6B) % groups, *[part.astype(np.int64)] * keep_ids))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return cut


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the indexes of the pieces in each sequence."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # open sequences by the room they have
    used: list[int] = []  # the rooms that occur, in order
    packed = []
    for i in order:
        at = bisect_right(used, sizes[i] - 1)
        if at < len(used):
            room = used[at]
            sequence = rooms[room].pop()
            if not rooms[room]:
                used.pop(at)
        else:
            room, sequence = capacity, []
            packed.append(sequence)
        sequence.append(i)
        left = room - sizes[i]
        if left:
            if not rooms[left]:
                used.insert(bisect_right(used, left), left)
            rooms[left].append(sequence)
    return packed


def fillings(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, ...]]:
    """Up to ``FILLINGS`` undominated multisets of the lengths left that fit the room, by least waste.

    ``lengths`` falls. A filling to which a further piece could be added, or one of whose pieces could be replaced with a
    larger one, is dominated; those that remain after the others of equal sum are dropped in favour of the one
    with the largest pieces. Enumeration goes from large to small and stops after ``LOOKS`` nodes or at a full sequence.
    """
    best: dict[int, tuple[int, ...]] = {}
    looks = 0

    def extend(at: int, left: int, chosen: tuple[int, ...]) -> bool:
        nonlocal looks
        # The first length, in falling order, that fits.
        lo, hi = at, len(lengths)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if lengths[mid] <= left else (mid + 1, hi)
        at, added = lo, False
        while at < len(lengths):
            size = lengths[at]
            looks += 1
            if counts[size] > chosen.count(size):
                added = True
                if size == left:
                    best.setdefault(0, (*chosen, size))
                    return True
                if extend(at, left - size, (*chosen, size)):
                    return True
                if looks > LOOKS:
                    return False
            at += 1
        if not added:
            best.setdefault(left, chosen)
        return False

    extend(0, room, ())
    return [best[waste] for waste in sorted(best)[:FILLINGS]]


def complete_bins(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[list[int]]:
    """Pack pieces by bin completion. Returns the indexes of the pieces of each sequence."""
    incumbent = best_fit(sizes, capacity)
    fewest = math.ceil(sum(sizes) / capacity)
    if len(incumbent) <= fewest:
        return incumbent
    by_size: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        by_size.setdefault(size, []).append(i)
    counts = {size: len(found) for size, found in by_size.items()}
    lengths = sorted(counts, reverse=True)
    hopeful = (len(incumbent) - 1) * capacity - sum(sizes)  # the waste that a better packing may have

    def take(filling: tuple[int, ...], sign: int) -> None:
        for size in filling:
            before = counts[size]
            counts[size] = before - sign
            if counts[size] == 0:
                lengths.remove(size)
            elif before == 0:
                lengths.insert(len(lengths) - bisect_right(lengths[::-1], size), size)

    # Depth first: each level holds the filling in use and those that remain to be tried.
    path: list[list] = []
    waste, steps, best, rest = 0, 0, None, sum(sizes)

    def options() -> list[tuple[int, ...]]:
        largest = lengths[0]
        take((largest,), 1)
        found = [(largest, *f) for f in fillings(counts, lengths, capacity - largest)]
        take((largest,), -1)
        return found

    pending = options()
    while True:
        steps += 1
        chosen = None
        while pending:
            filling = pending.pop(0)
            if waste + capacity - sum(filling) <= hopeful:
                chosen = filling
                break
            pending.clear()  # the others waste more
        if chosen is None:
            if not path:
                break
            filling, pending = path.pop()
            take(filling, -1)
            rest += sum(filling)
            waste -= capacity - sum(filling)
        else:
            take(chosen, 1)
            rest -= sum(chosen)
            waste += capacity - sum(chosen)
            path.append([chosen, pending])
            if rest == 0:
                best = [f for f, _ in path]
                if len(best) <= fewest:
                    break
                hopeful = (len(best) - 1) * capacity - sum(sizes)
                pending = []
            else:
                pending = options()
        if steps >= nodes + len(incumbent):
            break
    if best is None:
        return incumbent
    return [[by_size[size].pop() for size in filling] for filling in best]


def _packed(capacity: int):
    def pack_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        sizes = group["length"].tolist()
        partial = [i for i, size in enumerate(sizes) if size < capacity]
        bins = [[partial[j] for j in found] for found in complete_bins([sizes[i] for i in partial], capacity)]
        bins += [[i] for i, size in enumerate(sizes) if size >= capacity]
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for n, found in enumerate(bins):
            at = 0
            for i in found:
                sequence[i], offset[i] = n, at
                at += sizes[i]
        group["sequence_id"] = (group["group"].to_numpy() << 32) + sequence
        group["offset"] = offset
        return group.drop(columns="group")

    return pack_group


def pack(documents: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece, and its ``ids`` if ``keep_ids``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    groups = math.ceil(documents.count() / group_pieces) or 1
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, group long" + ", ids array<long>" * keep_ids
    pieces = rows.mapInArrow(_pieces(vocabulary, capacity, end_id, groups, keep_ids), schema)
    packed = schema.replace(" group long,", "").replace(", group long", "") + ", sequence_id long, offset long"
    return pieces.groupBy("group").applyInPandas(_packed(capacity), packed)
