"""Nested views of the ratings: a user's items as a map, an item's raters as a list.

A hot user or item would be one huge row, so each is cut into blocks of bounded size, with one row per
block. Nothing else in the engine needs the nested form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.blocks import Groups, with_block
from kindred.params import BLOCK_ROWS


def user_vectors(normed: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(user_id, block, vector)``: maps from item to its value in the user's unit vector."""
    blocks = F.ceil(F.col("n_items") / F.lit(block_rows))
    return (
        normed.withColumn("block", F.pmod(F.xxhash64("item_id"), blocks))
        .groupBy("user_id", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("item_id", "pre"))).alias("vector"))
    )


def item_raters(normed: DataFrame, groups: Groups) -> DataFrame:
    """``(item_id, block, raters)``: lists of ``(user_id, dev)``, ordered by user within a block."""
    return (
        with_block(normed, "user_id", groups)
        .groupBy("item_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("user_id", "dev"))).alias("raters"))
    )
