"""Shards by a k-d tree over document metadata, balanced in bytes.

A node is split along the dimension in which its documents spread widest, relative to the whole table, at the point
that gives each side its share of the bytes, until the leaves have the target size. The point is found exactly, for
all nodes of a level at once: a document's place along a dimension is a 63-bit number, its scaled coordinate followed
by bits of the text's checksum and of the id, and the weighted median is narrowed down 16 bits at a time from sums of
bytes per digit. So no node is ever sorted, a coordinate that a third of all rows share is split like any other, and
equal texts with equal metadata stay side by side.

Defined results: a null text has no bytes and counts 1, like an empty one, with the checksum of the empty text; null
metadata sort first; rows equal in id, text and metadata share a shard; an empty table gives an empty table. A leaf may
be empty if there are fewer documents than leaves. Columns that are not named are ignored or carried along.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.running import running_sum
from kindred.session import staged

DIMENSIONS = ("n_chars", "lang", "source")
SLOTS_PER_RANGE = 50_000
DIGIT_BITS, KEY_BITS, SCALE = 16, 64, 2**31 - 1


def size_bytes(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")))


def _coordinate(documents: DataFrame, name: str) -> Column:
    """A number in the order of the column: of strings, the first seven bytes. Nulls come first."""
    if dict(documents.dtypes)[name] == "string":
        digits = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 7)), 14, "0")
        return F.coalesce(F.conv(digits, 16, 10).cast("double"), F.lit(-1.0))
    return F.coalesce(F.col(name).cast("double"), F.lit(-1.0))


def _keyed(documents: DataFrame, dimensions: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """``keep``, the size and checksum, and a 63-bit place ``k<i>`` for each dimension, as a table."""
    tie = F.shiftleft(F.col("crc").bitwiseAND(F.lit(0xFFFF)), 16).bitwiseOR(F.xxhash64("doc_id").bitwiseAND(F.lit(0xFFFF)))
    places = [_coordinate(documents, d).alias(f"c{i}") for i, d in enumerate(dimensions)]
    rows = documents.select(F.col("doc_id"), *keep, size_bytes().alias("size"), checksum().alias("crc"), *places)
    rows = staged(rows.withColumn("tie", tie), "kd-rows")
    ends = rows.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(dimensions)) for n, f in (("lo", F.min), ("hi", F.max))])
    ends = ends.first()

    def place(i: int) -> Column:
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        scaled = F.floor((F.col(f"c{i}") - lo) / (hi - lo) * SCALE).cast("long") if lo is not None and hi > lo else F.lit(0).cast("long")
        return F.shiftleft(scaled, 32).bitwiseOR(F.col("tie")).alias(f"k{i}")

    others = [c for c in rows.columns if c != "tie" and c not in {f"c{i}" for i in range(len(dimensions))}]
    return rows.select(*others, *[place(i) for i in range(len(dimensions))])


def _cuts(rows: DataFrame, n_dims: int) -> DataFrame:
    """For every node ``lo`` with several ``leaves``: its dimension ``dim`` and the last place ``cut`` of its left side."""
    high = lambda f, i: F.shiftright(f(f"k{i}"), 32)
    nodes = rows.where("leaves > 1").groupBy("lo", "leaves").agg(
        F.sum("size").alias("bytes"), *[(high(F.max, i) - high(F.min, i)).alias(f"w{i}") for i in range(n_dims)]
    )
    widest = F.greatest(*[F.col(f"w{i}") for i in range(n_dims)]) if n_dims > 1 else F.col("w0")
    dim = F.coalesce(*[F.when(F.col(f"w{i}") == widest, i) for i in range(n_dims)])
    share = F.col("bytes") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    state = nodes.select("lo", dim.alias("dim"), share.alias("share"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    state = staged(state, "kd-state")
    key = F.element_at(F.array(*[F.col(f"k{i}") for i in range(n_dims)]), F.col("dim") + 1)
    for shift in range(KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        here = rows.where("leaves > 1").join(state, "lo").withColumn("key", key)
        if shift + DIGIT_BITS < KEY_BITS:
            here = here.where(F.shiftright("key", shift + DIGIT_BITS) == F.col("prefix"))
        digit = F.shiftright("key", shift).bitwiseAND(F.lit(2**DIGIT_BITS - 1))
        sums = here.groupBy("lo", "dim", "share", "prefix", "below", digit.alias("digit")).agg(F.sum("size").alias("mass"))
        upto = F.col("below") + F.sum("mass").over(Window.partitionBy("lo").orderBy("digit"))
        first = F.row_number().over(Window.partitionBy("lo").orderBy("digit"))
        passed = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("share")).withColumn("first", first).where("first = 1")
        state = staged(
            passed.select(
                "lo", "dim", "share", (F.shiftleft("prefix", DIGIT_BITS) + F.col("digit")).alias("prefix"),
                (F.col("upto") - F.col("mass")).alias("below"), "mass",
            ),
            "kd-state",
        ).drop(*(["mass"] if shift else []))
    nearer_without = F.col("share") - F.col("below") < F.col("below") + F.col("mass") - F.col("share")
    return state.select("lo", "dim", (F.col("prefix") - nearer_without.cast("int")).alias("cut"))


def kd_shards(documents: DataFrame, target_bytes: int | None = None, leaves: int | None = None,
              dimensions: Sequence[str] = DIMENSIONS, keep: Sequence[Column] = ()) -> DataFrame:
    """``(doc_id, *keep, size, crc, shard)`` per document. Give either the ``target_bytes`` of a shard or the number of
    ``leaves``. ``keep`` names more columns to carry along, under names of your choice."""
    rows = _keyed(documents, dimensions, keep)
    if leaves is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        leaves = max(1, math.ceil(total / target_bytes))
    rows = rows.withColumn("lo", F.lit(0)).withColumn("leaves", F.lit(leaves))
    left = F.floor(F.col("leaves") / 2).cast("int")
    key = F.element_at(F.array(*[F.col(f"k{i}") for i in range(len(dimensions))]), F.col("dim") + 1)
    for _ in range(math.ceil(math.log2(leaves))):
        goes_right = F.coalesce(key > F.col("cut"), F.lit(False)) & (F.col("leaves") > 1)
        split = rows.join(_cuts(rows, len(dimensions)), "lo", "left").withColumn("right", goes_right)
        split = split.withColumn("lo", F.when(F.col("right"), F.col("lo") + left).otherwise(F.col("lo")))
        split = split.withColumn("leaves", F.when(F.col("right"), F.col("leaves") - left).otherwise(F.greatest(left, F.lit(1))))
        rows = staged(split.drop("dim", "cut", "right"), "kd-level")
    return rows.withColumnRenamed("lo", "shard").drop("leaves", *[f"k{i}" for i in range(len(dimensions))])


def with_slots(sharded: DataFrame, rows_per_range: int = SLOTS_PER_RANGE) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard, without sorting a shard in one task."""
    ranges = math.ceil(sharded.count() / rows_per_range) or 1
    cut = sharded.withColumn("__one", F.lit(1)).withColumn("__range", F.pmod(F.xxhash64("doc_id", "crc"), F.lit(ranges)))
    order = ["doc_id", "crc", "size"]
    counted = running_sum(cut, "__one", ["shard"], "__range", order, "__upto")
    return counted.withColumn("slot", (F.col("__upto") - 1).cast("long")).drop("__one", "__range", "__upto")
