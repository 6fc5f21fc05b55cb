"""Similarity metrics of a user's own making, all of them from one join of the ratings with themselves.

A metric reads both users' vectors through *terms*: expressions over the two ratings of an item in common. Terms of ``sums`` are added up over the common
items, and a term of ``once`` is the same for all of them, for instance one made of the users' totals. What an item adds that only one of the
two has rated follows from such totals: the sum of the larger ratings over all items is that of both users' ratings less the sum of the smaller ones
over the common items. The value is an expression over the terms.

:func:`metric_pairs` collects the terms of all metrics that are asked for, each different one once, carries only the columns that they read through the join,
and adds them up in one aggregation, however many metrics there are. Users without a common item are not paired: their similarity is zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import first_of, safe_ratio, second_of
from kindred.functions.rating import rounded_similarity
from kindred.operators.blocks import Groups, pair_lists
from kindred.operators.similarity import most_matches, pairs_of_lists

Side = Callable[[str], Column]
Term = Callable[[Side, Side], Column]


@dataclass(frozen=True)
class Metric:
    """``value`` of the terms named in ``sums`` and ``once``.

    A term is a function of the two sides of a match; ``side("rating")`` is that side's column. Columns are those of the normalized ratings (``rating``, ``dev``,
    ``pre``, ``n_items``) and the user's aggregates named in ``users``. The first side is the user with the smaller id. The value must not depend on which is first.
    """

    value: Callable[[], Column]
    sums: Mapping[str, Term]
    once: Mapping[str, Term] = field(default_factory=dict)
    users: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


def _ratio(num: str, den: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: safe_ratio(F.col(num).cast("double"), den())


def _pearson() -> Column:
    n, x, y = F.col("overlap"), F.col("sum_first"), F.col("sum_second")
    # Where one of the two rates all common items the same, there is no correlation.
    spread = F.sqrt(F.greatest(n * F.col("squares_first") - x * x, F.lit(0.0))) * F.sqrt(F.greatest(n * F.col("squares_second") - y * y, F.lit(0.0)))
    return safe_ratio(n * F.col("products") - x * y, spread)


OVERLAP: dict[str, Term] = {"overlap": lambda a, b: F.lit(1)}

COSINE = Metric(lambda: F.col("dot"), {"dot": lambda a, b: a("pre") * b("pre")})
JACCARD = Metric(
    _ratio("overlap", lambda: F.col("sizes") - F.col("overlap")), OVERLAP, {"sizes": lambda a, b: a("n_items") + b("n_items")}
)
# The smaller rating of every item by the larger one; an item that only one has rated counts with zero for the other.
WEIGHTED_JACCARD = Metric(
    _ratio("smaller", lambda: F.col("rated") - F.col("smaller")),
    {"smaller": lambda a, b: F.least(a("rating"), b("rating"))},
    {"rated": lambda a, b: a("rating_sum") + b("rating_sum")},
    {"rating_sum": lambda: F.sum("rating")},
)
# The correlation of the ratings of the common items around the two users' means of these items.
PEARSON = Metric(
    _pearson,
    OVERLAP
    | {
        "products": lambda a, b: a("rating") * b("rating"),
        "sum_first": lambda a, b: a("rating"),
        "sum_second": lambda a, b: b("rating"),
        "squares_first": lambda a, b: a("rating") * a("rating"),
        "squares_second": lambda a, b: b("rating") * b("rating"),
    },
)
VECTOR_METRICS: dict[str, Metric] = {"cosine": COSINE, "jaccard": JACCARD, "weighted_jaccard": WEIGHTED_JACCARD, "pearson": PEARSON}


def named_metrics(metrics: Iterable[str] | Mapping[str, Metric]) -> dict[str, Metric]:
    return dict(metrics) if isinstance(metrics, Mapping) else {m: VECTOR_METRICS[m] for m in metrics}


@dataclass(frozen=True)
class _Plan:
    """The different terms of some metrics, and the columns they read."""

    sums: dict[str, Term]
    once: dict[str, Term]
    users: dict[str, Callable[[], Column]]
    columns: list[str]


def _collect(metrics: Iterable[Metric]) -> _Plan:
    sums: dict[str, Term] = {}
    once: dict[str, Term] = {}
    users: dict[str, Callable[[], Column]] = {}
    read: dict[str, None] = {}
    meaning: dict[str, str] = {}

    def side(name: str) -> Side:
        return lambda column: read.setdefault(column) or F.col(f"{column}_{name}")

    def add(kind: str, into: dict, given: Mapping, spelled: Callable) -> None:
        for name, made in given.items():
            if meaning.setdefault(name, f"{kind} {spelled(made)._jc}") != f"{kind} {spelled(made)._jc}":
                raise ValueError(f"two metrics give the term {name!r} different meanings")
            into[name] = made

    for metric in metrics:
        add("sum", sums, metric.sums, lambda t: t(side("l"), side("r")))
        add("once", once, metric.once, lambda t: t(side("l"), side("r")))
        add("user", users, metric.users, lambda made: made())
    return _Plan(sums, once, users, list(read))


def metric_rows(normed: DataFrame, metrics: Iterable[str] | Mapping[str, Metric]) -> tuple[DataFrame, dict]:
    """The ratings with the columns that the metrics read, and their terms as ``{name: (total, term)}``: what adds it up, and what of a match."""
    plan = _collect(named_metrics(metrics).values())
    rows = normed
    if plan.users:
        totals = normed.groupBy("user_id").agg(*[made().alias(name) for name, made in plan.users.items()])
        rows = normed.join(totals.hint("shuffle_hash"), "user_id")
    first, second = [lambda column, side=side: F.col(f"{column}_{side}") for side in ("l", "r")]
    made = lambda total, term: (total, lambda: term(first, second))
    terms = {name: made(F.sum, t) for name, t in plan.sums.items()} | {name: made(F.max, t) for name, t in plan.once.items()}
    return rows.select("item_id", "user_id", *plan.columns), terms


def metric_lists(normed: DataFrame, groups: Groups, metrics: Iterable[str] | Mapping[str, Metric]) -> tuple[DataFrame, dict]:
    """The lists of matches of :func:`metric_rows`, and the terms."""
    rows, terms = metric_rows(normed, metrics)
    return pair_lists(rows, groups, "user_id"), terms


def metric_pairs(normed: DataFrame, groups: Groups, metrics: Iterable[str] | Mapping[str, Metric]) -> DataFrame:
    """``(pair, <term>...)`` for ``u <= v`` with a common item, ``u = v`` included: the terms of all metrics from one join."""
    lists, terms = metric_lists(normed, groups, metrics)
    return pairs_of_lists(lists, terms, groups.self_matches, most_matches(normed, groups))


def metric_columns(metrics: Iterable[str] | Mapping[str, Metric]) -> dict[str, Column]:
    """The value of each metric over the columns of :func:`metric_pairs`, rounded as all similarities are."""
    return {name: rounded_similarity(metric.value()) for name, metric in named_metrics(metrics).items()}


def metric_similarities(pairs: DataFrame, metrics: Iterable[str] | Mapping[str, Metric]) -> DataFrame:
    """``(u, v, <metric>...)`` for the pairs ``u <= v`` with a common item, of which some metric is not zero."""
    columns = metric_columns(metrics)
    found = pairs.select("pair", *[c.alias(name) for name, c in columns.items()])
    some = F.lit(False)
    for name in columns:
        some = some | (F.col(name) != 0)
    return found.where(some).select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), *columns)
