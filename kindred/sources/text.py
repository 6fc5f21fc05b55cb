"""Text scans and their inverse writers.

* ratings: ``user <tab> item <tab> rating``, further fields ignored
* personal ratings and catalog, one file: ``item,title,rating`` with an empty rating if not rated

A malformed line fails the job instead of turning into nulls, whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.params import PERSONAL_USER_ID, RATING_HI, RATING_LO
from kindred.sources.loading import parsed_ratings


def read_ratings(spark: SparkSession, path: str, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """``(user_id, item_id, rating)`` from tab-separated text. A line that cannot be read, or whose rating is not from ``lo`` to ``hi``, fails the job,
    whichever of its fields is asked for; :func:`kindred.sources.loading.load_ratings` collects such lines instead."""
    parsed = parsed_ratings(F.col("value"), lo, hi)
    fields = F.struct(*[parsed[name].alias(name) for name in ("user_id", "item_id", "rating")])
    kind = "struct<user_id:int,item_id:int,rating:double>"
    failed = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).cast(kind)
    return spark.read.text(path).select(F.when(parsed["reason"].isNull(), fields).otherwise(failed).alias("f")).select("f.*")


def write_ratings(ratings: DataFrame, path: str) -> None:
    """Write ratings so that :func:`read_ratings` reads them back."""
    ratings.select(F.concat_ws("\t", "user_id", "item_id", "rating").alias("value")).write.text(path)


def _catalog_lines(spark: SparkSession, path: str, lo: float, hi: float) -> DataFrame:
    """``(item_id, title, rating)``. The title runs from the first comma to the last one, so it may contain commas itself.
    What follows the last one is a rating from ``lo`` to ``hi``, or blank if the item is not rated. A line
    that is not like that fails the job, whichever of its fields is asked for."""
    line = F.col("value")
    first, last = F.substring_index(line, ",", 1), F.substring_index(line, ",", -1)
    between = F.length(line) - F.length(first) - F.length(last) - 2  # negative unless there are two commas
    title = F.trim(F.substring(line, F.length(first) + 2, F.greatest(between, F.lit(0))))
    item, rating, blank = F.trim(first).try_cast("int"), F.trim(last).try_cast("double"), F.trim(last) == ""
    valid = (between >= 0) & item.isNotNull() & (blank | F.coalesce(rating.between(lo, hi), F.lit(False)))
    fields = F.struct(item.alias("item_id"), title.alias("title"), rating.alias("rating"))
    kind = "struct<item_id:int,title:string,rating:double>"
    failed = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast(kind)
    return spark.read.text(path).select(F.when(valid, fields).otherwise(failed).alias("f")).select("f.*")


def read_personal(spark: SparkSession, path: str, user_id: int = PERSONAL_USER_ID, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """The rated lines as ratings ``(user_id, item_id, rating)`` of one personal user."""
    return (
        _catalog_lines(spark, path, lo, hi)
        .where(F.col("rating").isNotNull())
        .select(F.lit(user_id).cast("int").alias("user_id"), "item_id", "rating")
    )


def read_catalog(spark: SparkSession, path: str, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """All lines, rated or not, as ``(item_id, title)``."""
    return _catalog_lines(spark, path, lo, hi).select("item_id", "title")


def write_catalog(catalog: DataFrame, personal: DataFrame, path: str) -> None:
    """Write a catalog with one user's ratings so that the two readers above read them back."""
    lines = catalog.join(personal.select("item_id", "rating"), "item_id", "left").select(
        F.concat(
            F.col("item_id").cast("string"), F.lit(","), "title", F.lit(","),
            F.coalesce(F.col("rating").cast("string"), F.lit("")),
        ).alias("value")
    )
    lines.write.text(path)
