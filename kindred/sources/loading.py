"""Loading a ratings file in one pass: parsed, checked, counted and written as a table at the same time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kindred.params import RATING_HI, RATING_LO
from kindred.session import staged

# Why a line is refused; the first that applies.
REASONS = ("fields", "user_id", "item_id", "rating", "range")


def parsed_ratings(line: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> dict[str, Column]:
    """``user_id``, ``item_id``, ``rating`` of a tab-separated line, null where they cannot be read, and the ``reason`` to refuse it, null if there is none.

    A line needs three fields; further ones are ignored. Ids are 32-bit integers, and the rating is a number from ``lo`` to ``hi``.
    """
    fields = F.split(line, "\t", 4)
    part = lambda n, kind: F.trim(F.get(fields, F.lit(n))).try_cast(kind)
    user, item, rating = part(0, "int"), part(1, "int"), part(2, "double")
    broken = (F.size(fields) < 3, user.isNull(), item.isNull(), rating.isNull(), ~rating.between(lo, hi))
    reason = F.coalesce(*[F.when(wrong, F.lit(why)) for wrong, why in zip(broken, REASONS)])
    return {"user_id": user, "item_id": item, "rating": rating, "reason": reason}


@dataclass(frozen=True)
class Loaded:
    """``ratings`` as read, ``rejects`` as ``(reason, line)``, and how many lines there were of either, by reason of refusal."""

    name: str
    ratings: DataFrame
    rejects: DataFrame
    n_rows: int
    refused: dict[str, int]

    def require(self, expected: int | None = None) -> Loaded:
        """Fail if a line was refused, or if there are not as many ratings as expected. Nothing is read for it but a bad line to show."""
        if any(self.refused.values()):
            shown = self.rejects.orderBy("reason", "line").first()
            counts = ", ".join(f"{n} for {why}" for why, n in self.refused.items() if n)
            raise ValueError(f"{self.name}: malformed line: {shown.line!r} ({shown.reason}); refused lines: {counts}")
        if expected is not None and self.n_rows != expected:
            raise ValueError(f"invalid {self.name}: {self.n_rows} rows, expected {expected}")
        return self


def load_ratings(spark: SparkSession, path: str, name: str = "ratings", lo: float = RATING_LO, hi: float = RATING_HI) -> Loaded:
    """Read the file once: good lines and refused ones become two parts of a table, and are counted while it is written."""
    columns = parsed_ratings(F.col("value"), lo, hi)
    refused = F.col("reason").isNotNull()
    lines = spark.read.text(path).select(*[c.alias(n) for n, c in columns.items()], "value")
    rows = lines.select(
        "user_id", "item_id", "rating", "reason", F.when(refused, F.col("value")).alias("line"), refused.alias("refused")
    )
    seen = Observation(f"{name}-lines")
    counts = [F.count_if(F.col("reason") == why).alias(why) for why in REASONS]
    rows = rows.observe(seen, F.count_if(~F.col("refused")).alias("n_rows"), *counts)
    table = staged(rows, f"{name}-lines", partition_by=("refused",))
    found = seen.get
    return Loaded(
        name,
        table.where(~F.col("refused")).select("user_id", "item_id", "rating"),
        table.where("refused").select("reason", "line"),
        found["n_rows"],
        {why: found[why] for why in REASONS},
    )
