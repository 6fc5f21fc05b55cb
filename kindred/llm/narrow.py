"""Fewer rows on the way to a join: most of those that find no partner are left out where they are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each wanted key, of which three are set; most bitmaps, of 4 KB each: beyond that, more rows get through.
BITS, MOST = 16, 2048
SIZE = 1 << 15  # bits of one of Spark's bitmaps


def _bits(key: str) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(key), 15 * i).bitwiseAND(F.lit(SIZE - 1)).cast("int") for i in range(3)]


def narrowed(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``, a table of one column that is read twice.

    All rows with a wanted key stay, and about one in 200 of the others: a join must follow, but not a semi join, which Spark
    would do first. The wanted keys make a Bloom filter, in blocks that are broadcast: so a few wanted rows do not cause all others to be shuffled.
    """
    maps = min(MOST, max(1, -(-wanted.count() * BITS // SIZE)))
    block = lambda name: F.pmod(F.shiftrightunsigned(F.xxhash64(name), 45), F.lit(maps)).alias("__block")
    only = wanted.columns[0]
    set_bits = wanted.select(block(only), F.explode(F.array(*[b.cast("long") for b in _bits(only)])).alias("bit"))
    blocks = set_bits.groupBy("__block").agg(F.bitmap_construct_agg("bit").alias("__bits"))

    def held(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1

    found = rows.withColumn("__block", block(key)).join(F.broadcast(blocks), "__block")
    return found.where(reduce(Column.__and__, map(held, _bits(key)))).select(*rows.columns)
