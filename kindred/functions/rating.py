"""Scalar expressions on ratings. All are built-in column expressions and stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.params import RATING_HI, RATING_LO, SIMILARITY_DECIMALS


def scale(x: Column, y: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Distance from ``y`` to the rating bound on the side where ``x`` lies; 1 if ``x`` equals ``y``."""
    return F.when(x > y, F.lit(hi) - y).when(x < y, y - F.lit(lo)).otherwise(F.lit(1.0))


def normalized(rating: Column, mean: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Deviation of a rating from the user's mean, as a share of the room on that side: in [-1, 1]."""
    return (rating - mean) / scale(rating, mean, lo, hi)


def denormalized(mean: Column, dev: Column, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """The rating that lies ``dev`` away from the user's mean: in [lo, hi]."""
    return mean + dev * scale(mean + dev, mean, lo, hi)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, and 0 where there is nothing to divide by (zero or a missing join side)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def rounded_similarity(sim: Column, decimals: int = SIMILARITY_DECIMALS) -> Column:
    """``sim`` to a fixed number of decimals, in plain double arithmetic: ``round`` goes through
    decimal strings, which is slow for every pair of users."""
    unit = float(10**decimals)
    return F.rint(sim * unit) / unit


def similarity_units(sim: Column, decimals: int = SIMILARITY_DECIMALS) -> Column:
    """:func:`rounded_similarity` as a whole number of its last decimal, for shuffles: most of its bytes are zero."""
    return F.rint(sim * float(10**decimals)).try_cast("long")


def units_similarity(units: Column, decimals: int = SIMILARITY_DECIMALS) -> Column:
    return units / float(10**decimals)
