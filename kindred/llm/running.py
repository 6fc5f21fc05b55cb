"""Running sums along an order that is too long for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, value: str, groups: Sequence[str], bucket: str, order: Sequence[Column | str], out: str, before: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group up to and including this one.

    ``bucket`` must not decrease along ``order`` and must cut each group into pieces that one task can sort.
    Only one row per group and bucket is summed over the whole group. ``groups`` and ``bucket`` hold no nulls.
    With ``before``, pieces that begin at or above that sum are left out, and not sorted.
    """
    keys = [*groups, bucket]
    each = df.groupBy(*keys).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select(*keys, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    if before is not None:
        offsets = offsets.where(F.col("__before") < before)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = df.join(offsets, keys).withColumn(out, F.col("__before") + F.sum(value).over(inside))
    return summed.drop("__before")
