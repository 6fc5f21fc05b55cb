"""Mixing of sources to target weights by weighted fair queueing.

Each source sends its documents in a shuffled order, again and again up to ``epochs`` times. A copy of a document has
the virtual finish time (words its source has sent so far, this copy included) / (target of the source). All copies
are sorted by that time, and the sorted stream is cut where the total budget, the words of all documents, is spent.
A source that gets twice the target of another thus sends twice the words at any point of the stream.

Only built-in functions are used. Neither the order within a source nor the one of the stream is ever sorted in one
task: both are cut into ranges, summed up per range, and continued from the sums. One row per source, and one per
range, meet in a task.

Defined results: a null or empty text has size 0, is never taken, and counts nothing; a null source is a source of
its own, the last one; rows equal in id, source and text are one unit, taken together; ties in the finish time go by
source, shuffle key and copy; an empty table gives an empty table. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.running import running_sum
from kindred.session import staged

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RANGE = 20_000
WORDS_PER_RANGE = 2_000_000


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(seed: str) -> Column:
    """A key whose order is the shuffled order: 32 hexadecimal digits."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "text")]
    return F.md5(F.concat_ws("\x1f", F.lit(seed), *parts))


def source_targets(sources: DataFrame, weights: Sequence[int], epochs: int) -> DataFrame:
    """Add ``target`` to ``(absent, src, source_size)``, one row per source.

    Targets share the words of all sources by weight; none exceeds ``epochs`` times its source's size, and what is
    above that is shared again by weight. In the order of size by weight, the sources at their limit come first: the
    level of the others is what remains, divided by their weights, from the first source on whose limit is not below it.
    """
    place = F.row_number().over(Window.orderBy("absent", "src")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * epochs
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "absent", "src")
    earlier, later = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    level = (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    return (
        sources.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("level", level)
        .withColumn("level", F.max(reached).over(everywhere))
        .withColumn("target", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))))
        .drop("weight", "limit", "level")
    )


def mix_units(documents: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``(key, absent, src, size, source_size, target, copies)`` per unit of equal rows: how often the mix takes it."""
    rows = documents.select(
        shuffle_key(seed).alias("key"),
        F.col("source").isNull().cast("int").alias("absent"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        word_count("text").alias("size"),
    )
    unit = ["key", "absent", "src", "size"]
    units = staged(rows.groupBy(*unit).agg((F.col("size") * F.count(F.lit(1))).alias("mass")), "mix-units")
    known = units.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("mass"), F.lit(0)).alias("words")).first()

    ranges = math.ceil(known.n / ROWS_PER_RANGE) or 1
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    units = units.withColumn("range", F.floor(head * F.lit(ranges) / F.lit(2**32)).cast("int"))
    source = ["absent", "src"]
    cells = units.groupBy(*source, "range").agg(F.sum("mass").alias("cell"))
    sources = source_targets(cells.groupBy(*source).agg(F.sum("cell").alias("source_size")), weights, epochs)
    ordered = running_sum(units, "mass", source, "range", ["key"], "sent")
    per_cell = cells.join(sources, source).drop("cell")
    ordered = staged(ordered.join(per_cell, [*source, "range"]).drop("range"), "mix-order")

    turns = math.ceil(known.words / WORDS_PER_RANGE) or 1
    copies = (
        ordered.where("mass > 0")
        .select(*source, "key", "size", "mass", "sent", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("copy"))
        .withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("sent")) / F.col("target"))
        .withColumn("range", F.floor(F.col("finish") * turns).cast("long"))
        .drop("sent", "source_size", "target")
    )
    stream = running_sum(copies, "mass", [], "range", ["finish", *source, "key", "copy"], "spent", known.words)
    taken = stream.where(F.col("spent") <= known.words).groupBy(*unit).agg(F.count(F.lit(1)).alias("copies"))
    return ordered.drop("mass", "sent").join(taken, unit, "left").withColumn("copies", F.coalesce("copies", F.lit(0)))


def mixed(documents: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``(row, size, source_size, target, copies)`` for every document, ``row`` holding all its columns."""
    units = mix_units(documents, weights, epochs, seed).drop("size")
    rows = documents.select(
        F.struct("*").alias("row"),
        shuffle_key(seed).alias("key"),
        F.col("source").isNull().cast("int").alias("absent"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        word_count("text").alias("size"),
    )
    return rows.join(units, ["key", "absent", "src"]).select("row", "size", "source_size", "target", "copies")


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """The documents of the mix, with the columns of ``documents``; a repeated document comes as often as it is taken."""
    found = mixed(documents, weights, epochs, seed).where("copies > 0")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
