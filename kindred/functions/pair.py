"""A pair of user ids as one long: a single key is cheaper to hash, and sorts without a comparator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_key(u: Column, v: Column) -> Column:
    """The ordered pair: ``u`` in the upper and ``v`` in the lower half. Ids are 32-bit integers."""
    low = v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(u.cast("long"), 32).bitwiseOR(low)


def symmetric_pair_key(a: Column, b: Column) -> Column:
    """The same key for both orders of a pair."""
    return pair_key(F.least(a, b), F.greatest(a, b))


def first_of(pair: Column) -> Column:
    return F.shiftright(pair, 32).cast("int")


def second_of(pair: Column) -> Column:
    return F.shiftright(F.shiftleft(pair, 32), 32).cast("int")
