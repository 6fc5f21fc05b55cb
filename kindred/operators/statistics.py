"""Statistics of users that are kept, and brought up to date from what was added and removed.

All statistics of a user follow from how often the user gave each rating. These counts can be added up and taken away, so they are what is kept: a change of
some ratings is counted in the same way, and only the users that it concerns are computed again, from their counts. The ratings themselves
are not read again, and the statistics of all other users stay the rows they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.normalize import rating_counts, stats_of_counts
from kindred.params import RATING_HI, RATING_LO
from kindred.session import staged


@dataclass(frozen=True)
class FittedStatistics:
    """``counts``: ``(user_id, rating, n)``; ``stats``: ``(user_id, n_items, user_avg, norm)``, one row per user with ratings."""

    counts: DataFrame
    stats: DataFrame
    lo: float = RATING_LO
    hi: float = RATING_HI

    @classmethod
    def fit(cls, ratings: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI) -> FittedStatistics:
        """From all ratings, one row per user and item; both tables are written."""
        counts = staged(rating_counts(ratings), "rating-counts")
        return cls(counts, staged(stats_of_counts(counts, lo, hi), "user-stats"), lo, hi)

    def merge(self, added: DataFrame | None = None, removed: DataFrame | None = None) -> FittedStatistics:
        """The statistics of all ratings with those of ``added``, which are new, and without those of ``removed``, which are among them.

        A changed rating is one of each. Nobody is left with statistics who has no ratings left. Removing ratings that were not there fails."""
        signed = [(added, 1), (removed, -1)]
        deltas = [rating_counts(df).withColumn("n", F.col("n") * sign) for df, sign in signed if df is not None]
        if not deltas:
            return self
        delta = deltas[0] if len(deltas) == 1 else deltas[0].unionByName(deltas[1])
        delta = staged(delta, "rating-changes")
        touched = delta.select("user_id").distinct().hint("shuffle_hash")
        old = self.counts.join(touched, "user_id", "left_semi").unionByName(delta)
        total = F.sum("n")
        missing = F.raise_error(F.lit("ratings are to be removed that were not there")).cast("long")
        theirs = old.groupBy("user_id", "rating").agg(F.when(total >= 0, total).otherwise(missing).alias("n")).where(F.col("n") > 0)
        theirs = staged(theirs, "changed-counts")
        others = lambda table: table.join(touched, "user_id", "left_anti")
        return FittedStatistics(
            others(self.counts).unionByName(theirs),
            others(self.stats).unionByName(staged(stats_of_counts(theirs, self.lo, self.hi), "changed-stats")),
            self.lo,
            self.hi,
        )

    def compacted(self) -> FittedStatistics:
        """The same as two tables, after many merges."""
        return FittedStatistics(staged(self.counts, "rating-counts"), staged(self.stats, "user-stats"), self.lo, self.hi)
