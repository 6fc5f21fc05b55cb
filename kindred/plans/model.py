"""The tables that the similarity and the k-NN jobs share, each derived once per model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from copy import copy
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.blocks import Groups, dealt, in_part, measure_groups, member_lists, pair_lists, rest_of_lists, rounds_for, whole_lists
from kindred.operators.bounded import BoundedNeighbours, bounded_neighbours
from kindred.operators.metrics import Metric, metric_columns, metric_pairs, metric_rows, metric_similarities
from kindred.operators.neighbours import both_directions, nearest, nearest_of_lists
from kindred.operators.normalize import normalized_ratings, user_stats, with_user_avg
from kindred.operators.predict import (
    asked_lists,
    asked_of,
    error_steps,
    errors_by_k,
    errors_of_steps,
    evidence_lists,
    metric_weights,
    neighbour_evidence,
    neighbour_weights,
    predictions,
    ranked_evidence,
    ranked_evidence_of,
    rater_evidence,
    similar_evidence,
    similar_evidence_of,
    weighted_deviation,
    with_neighbour,
    with_similarity,
)
from kindred.operators.recommend import personal_predictions, personal_similarities, with_personal
from kindred.operators.similarity import (
    METRIC_TERMS,
    TERMS,
    added_counts,
    co_rated_pairs,
    co_rated_pairs_of,
    metric_column,
    pair_counts,
    pair_summary,
    pairs_of_lists,
    similarities,
    summary_of_counts,
)
from kindred.operators.statistics import FittedStatistics
from kindred.params import BLOCK_ROWS, RATING_HI, RATING_LO
from kindred.session import staged


def _products(lists: DataFrame) -> DataFrame:
    """What cosine similarities are added up from."""
    return lists.select("pair_first", "pair_second", F.transform("pre_r", lambda x: x * F.col("pre_l")).alias("product"))


def require_narrow_ids(*tables: DataFrame) -> None:
    for df in tables:
        if dict(df.dtypes)["user_id"] not in ("int", "smallint", "tinyint"):
            raise ValueError("user_id must be a 32-bit integer: two of them make the key of a pair")


@dataclass
class Model:
    """Training ratings, and the ratings to predict: ``(user_id, item_id, rating)`` each.

    The fitted tables (statistics, normalized ratings, group sizes) are made on first use or by
    :meth:`fit`. Everything else is a plan that is carried out when its result is asked for.
    """

    train: DataFrame
    test: DataFrame
    lo: float = RATING_LO
    hi: float = RATING_HI
    block_rows: int = BLOCK_ROWS
    pairs_kept: bool = False

    def __post_init__(self) -> None:
        require_narrow_ids(self.train, self.test)

    def fit(self) -> Model:
        self.normed, self.items, self.n_users  # noqa: B018
        return self

    @cached_property
    def stats(self) -> DataFrame:
        """One row per user, as a table: normalization, predictions and counts read it."""
        return staged(user_stats(self.train, self.lo, self.hi), "user-stats")

    @cached_property
    def _users(self):
        """The number of users, and the largest number of items of one."""
        return self.stats.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("n_items"), F.lit(0)).alias("most_items")).first()

    @property
    def n_users(self) -> int:
        return self._users.n

    @cached_property
    def normed(self) -> DataFrame:
        """The normalized ratings as a table: pairs and predictions read it several times. A user's rows, which are alike, are written together."""
        normed = normalized_ratings(self.train, self.stats, self.lo, self.hi)
        return staged(normed.sortWithinPartitions("user_id"), "normalized")

    @cached_property
    def items(self) -> Groups:
        """The items, with their raters in the training ratings on the left and the test rows on the right."""
        return measure_groups("item_id", self.train, self.test, self.block_rows)

    @cached_property
    def pairs(self) -> DataFrame:
        """The co-rated pairs, computed where they are used; see :meth:`keep_pairs`."""
        return co_rated_pairs(self.normed, self.items)

    def keep_pairs(self) -> Model:
        """The same model with its pairs written as a table, for jobs that read them more than once."""
        kept = copy(self)
        kept.pairs_kept = True
        kept.pairs = kept.needed_pairs = staged(self.pairs, "pairs")
        return kept

    @cached_property
    def test_users(self) -> DataFrame:
        """The users to predict for that have training ratings, as a table."""
        known = self.test.select("user_id").distinct().join(self.stats.select("user_id"), "user_id", "left_semi")
        return staged(known, "test-users")

    @cached_property
    def n_test_users(self) -> int:
        return self.test_users.count()

    @cached_property
    def n_test(self) -> int:
        return self.test.count()

    @property
    def needs_all_pairs(self) -> bool:
        return 2 * self.n_test_users > self.n_users

    @cached_property
    def needed_pairs(self) -> DataFrame:
        """The co-rated pairs that predictions read: those of the test users. If these are half of all users or more, pairing all
        users, each pair once, is less work."""
        if self.needs_all_pairs:
            return self.pairs
        theirs = self.train.join(self.test_users, "user_id", "left_semi")
        return co_rated_pairs_of(self.test_users, self.normed, measure_groups("item_id", theirs, self.train, self.block_rows))

    @cached_property
    def test_rows(self) -> DataFrame:
        return with_user_avg(self.test, self.stats)

    @cached_property
    def evidence(self) -> DataFrame:
        return rater_evidence(self.test, self.normed, self.items)

    @property
    def _most_listed(self) -> int:
        """What no user has more pairs than: most items times most raters."""
        return self._users.most_items * self.items.largest

    def _ranks_positive(self, k: int) -> bool:
        """Whether only positive similarities can be among the first ``k``: so many other users are always left with similarity zero."""
        return not self.pairs_kept and self.n_users - 1 - self._most_listed >= k

    def _rounds(self, entries: float) -> list[Callable[[Column], Column]]:
        """The parts of the users that lists with so many entries are sent in."""
        parts = rounds_for(entries)
        return [in_part(part, parts) for part in range(parts)]

    @property
    def _asker_rounds(self) -> list[Callable[[Column], Column]]:
        """The parts of the test users whose whole lists of matches, and lists of the raters of their items, are sent at once; none if that is not asked for."""
        rounds = self._rounds(2 * self.items.self_matches + self.items.join_matches)
        return rounds if len(rounds) > 1 and not self.pairs_kept and self.needs_all_pairs else []

    def _in_rounds(self, rated: DataFrame, found: Callable[[DataFrame, DataFrame, float], DataFrame], reduced: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``reduced(test rows, evidence)`` of each part of the test users, as a table: what was sent for one part is deleted before the next.

        ``found(lists, asked, entries)`` is the evidence from the whole lists of a part's users among ``rated``, and the raters of their items. So each pair comes from both sides, and all of
        a user's are in one round."""
        rounds = self._asker_rounds
        entries = (2 * self.items.self_matches + self.items.join_matches) / len(rounds)
        lists = staged(member_lists(rated, self.items, "user_id"), "member-lists")
        asked = staged(asked_lists(self.test, self.normed, self.items), "asked-lists")
        parts = []
        for chosen in rounds:
            evidence = found(whole_lists(lists, "user_id", chosen), asked_of(asked, chosen), entries)
            rows = with_user_avg(self.test.where(chosen(F.col("user_id"))), self.stats)
            parts.append(staged(reduced(rows, evidence), "round"))
        return reduce(DataFrame.unionByName, parts)

    def _near_in_rounds(self, k: int, reduced: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        def found(lists: DataFrame, asked: DataFrame, entries: float) -> DataFrame:
            return ranked_evidence_of(_products(lists), asked, k, entries, self._most_listed)

        return self._in_rounds(self.normed.select("item_id", "user_id", "pre"), found, reduced)

    def _nears_in_rounds(self, k: int) -> bool:
        return bool(self._asker_rounds) and self._ranks_positive(k) and self.items.join_matches <= float(self.n_test) * k

    def _deviations(self, rated: DataFrame, terms: Mapping, columns: Mapping[str, Column]) -> DataFrame:
        """The test rows with one weighted-deviation column per similarity of ``columns``, which are made of ``terms``."""
        if not self._asker_rounds:
            weighted = self._similar(pair_lists(rated, self.items, "user_id"), terms, columns)
            return weighted_deviation(self.test_rows, weighted, metric_weights(columns))

        def found(lists: DataFrame, asked: DataFrame, entries: float) -> DataFrame:
            return similar_evidence_of(lists, asked, terms, columns, entries, self._most_met)

        return self._in_rounds(rated, found, lambda rows, evidence: weighted_deviation(rows, evidence, metric_weights(columns)))

    def pair_summary(self) -> DataFrame:
        """:func:`kindred.operators.similarity.pair_summary` of all pairs."""
        rounds = [] if self.pairs_kept else self._rounds(self.items.self_matches)
        if len(rounds) <= 1:
            return pair_summary(self.pairs, self.n_users)
        pairs = self._pairs_in_rounds(self.normed.select("item_id", "user_id", "pre", "n_items"), TERMS, rounds, pair_counts)
        return summary_of_counts(added_counts(pairs), self.n_users)

    def _pairs_in_rounds(self, rated: DataFrame, terms: Mapping, rounds: list, reduced: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``reduced(pairs)`` of the pairs whose first user is in a part of the users, as a table; for one part after the other."""
        lists = staged(member_lists(rated, self.items, "user_id"), "member-lists")
        matches = self.items.self_matches / len(rounds)
        of_part = lambda chosen: pairs_of_lists(rest_of_lists(lists, "user_id", chosen=chosen), terms, matches, self._most_listed)
        return reduce(DataFrame.unionByName, [staged(reduced(of_part(chosen)), "round", compression="zstd") for chosen in rounds])

    def _matches(self, rated: DataFrame) -> DataFrame:
        """The lists of matches that cosine similarities are added up from, without those of users with themselves."""
        return _products(pair_lists(rated, self.items, "user_id", itself=False))

    def neighbours(self, k: int) -> DataFrame:
        if self._ranks_positive(k):
            lists = self._matches(self.normed.select("item_id", "user_id", "pre"))
            return nearest_of_lists(lists, self.items.self_matches, self._most_listed, k)
        return self._nearest(both_directions(similarities(self.pairs)), k)

    def _nearest(self, directed: DataFrame, k: int) -> DataFrame:
        """With what is known of the number of a user's pairs: the matches per user, and most items times most raters."""
        per_user = 2 * self.items.self_matches / max(self.n_users, 1)
        directed = dealt(directed, min(2 * self.items.self_matches, float(self.n_users) ** 2), "u")
        return nearest(directed, self.n_users, k, per_user, self._most_listed)

    def bounded_neighbours(self, k: int) -> BoundedNeighbours:
        """The same neighbours, without adding up the pairs that cannot be among them: for vectors with many items in common."""
        return bounded_neighbours(self.normed, self.n_users, k, self.block_rows)

    def test_neighbours(self, k: int) -> DataFrame:
        """The neighbours of the test users only."""
        directed = both_directions(similarities(self.needed_pairs))
        if self.n_test_users < self.n_users:
            directed = directed.join(self.test_users.withColumnRenamed("user_id", "u").hint("shuffle_hash"), "u", "left_semi")
        return self._nearest(directed, k)

    def metric_deviations(self, *metrics: str) -> DataFrame:
        """The test rows with one weighted-deviation column per metric."""
        if self.pairs_kept or not self.needs_all_pairs:
            weighted = with_similarity(self.evidence, self.needed_pairs, metrics, self.items.join_matches)
            return weighted_deviation(self.test_rows, weighted, metric_weights(metrics))
        read = {term for m in metrics for term in METRIC_TERMS[m]}
        columns = ["pre"] * ("dot" in read) + ["n_items"] * ("sizes" in read)
        rated = self.normed.select("item_id", "user_id", *columns)
        return self._deviations(rated, {t: TERMS[t] for t in TERMS if t in read}, {m: metric_column(m) for m in metrics})

    @cached_property
    def _most_met(self) -> int:
        """What no user has more matches and evidence than. A test user may have more test rows than ratings."""
        most_tested = self.test.groupBy("user_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        return (2 * self._users.most_items + most_tested) * self.items.largest

    def _similar(self, lists: DataFrame, terms: Mapping, columns: Mapping) -> DataFrame:
        evidence = evidence_lists(self.test, self.normed, self.items)
        entries = self.items.self_matches + self.items.join_matches
        return similar_evidence(lists, evidence, terms, columns, entries, self._most_met)

    def similarities(self, metrics: Iterable[str] | Mapping[str, Metric]) -> DataFrame:
        """``(u, v, <metric>...)`` for own and built-in metrics on both users' vectors, from one join."""
        rounds = self._rounds(self.items.self_matches)
        if len(rounds) == 1:
            return metric_similarities(metric_pairs(self.normed, self.items, metrics), metrics)
        rated, terms = metric_rows(self.normed, metrics)
        return self._pairs_in_rounds(rated, terms, rounds, lambda pairs: metric_similarities(pairs, metrics).sortWithinPartitions("u", "v"))

    def predict_by(self, metrics: Iterable[str] | Mapping[str, Metric]) -> DataFrame:
        """``(user_id, item_id, rating, <metric>...)`` for own and built-in metrics, all from one join of pairs and one of evidence."""
        columns = metric_columns(metrics)
        rated, terms = metric_rows(self.normed, metrics)
        return predictions(self._deviations(rated, terms, columns), list(columns), self.lo, self.hi).drop("user_avg")

    def neighbour_evidence(self, k: int) -> DataFrame:
        """``(user_id, item_id, dev, sim, pos)``: for each test row, those of its user's ``k`` neighbours who rated the item.

        They are looked up by the raters of the items, or by the neighbours of the users, whichever are fewer: never
        more rows than test rows times k."""
        by_neighbour = float(self.n_test) * k
        if self._ranks_positive(k) and self.needs_all_pairs and self.items.join_matches <= by_neighbour:
            rated = self.normed.select("item_id", "user_id", "pre", "dev")
            return ranked_evidence(self._matches(rated), self.test, rated, self.items, k, self._most_listed)
        near = self.test_neighbours(k)
        if self.items.join_matches <= by_neighbour:
            return with_neighbour(self.evidence, near)
        return neighbour_evidence(self.test, self.normed, near, by_neighbour)

    def neighbour_deviations(self, k_values: Sequence[int]) -> DataFrame:
        """The test rows with one weighted-deviation column ``k<k>`` per k, from one ranking."""
        if self._nears_in_rounds(max(k_values)):
            return self._near_in_rounds(max(k_values), lambda rows, evidence: weighted_deviation(rows, evidence, neighbour_weights(k_values)))
        return weighted_deviation(self.test_rows, self.neighbour_evidence(max(k_values)), neighbour_weights(k_values))

    def errors_by_k(self, max_k: int) -> DataFrame:
        """``(k, mae, n)`` for every k from 1 to ``max_k``, from one ranking."""
        if self._nears_in_rounds(max_k):
            steps = self._near_in_rounds(max_k, lambda rows, evidence: error_steps(rows, evidence, self.lo, self.hi))
            return errors_of_steps(self.test_rows, steps.groupBy("pos").agg(F.sum("change").alias("change")), max_k)
        return errors_by_k(self.test_rows, self.neighbour_evidence(max_k), max_k, self.lo, self.hi)

    def predict(self, *metrics: str) -> DataFrame:
        """``(user_id, item_id, rating, <metric>...)``"""
        return predictions(self.metric_deviations(*metrics), list(metrics), self.lo, self.hi).drop("user_avg")

    def predict_knn(self, *k_values: int) -> DataFrame:
        """``(user_id, item_id, rating, k<k>...)``"""
        names = [f"k{k}" for k in k_values]
        return predictions(self.neighbour_deviations(k_values), names, self.lo, self.hi).drop("user_avg")


@dataclass
class PersonalModel:
    """All ratings, and those of the one user who is to get recommendations."""

    ratings: DataFrame
    personal: DataFrame
    user_id: int
    lo: float = RATING_LO
    hi: float = RATING_HI
    fitted: FittedStatistics | None = None  # of all ratings; only the user's own are read for theirs then

    def __post_init__(self) -> None:
        require_narrow_ids(self.ratings, self.personal)

    @cached_property
    def mine(self) -> DataFrame:
        """The user's ratings as a table, with those that are among all ratings already."""
        known = self.ratings.where(F.col("user_id") == self.user_id)
        return staged(with_personal(known, self.personal), "personal-ratings")

    @cached_property
    def n_mine(self) -> int:
        return self.mine.count()

    @property
    def others(self) -> DataFrame:
        return self.ratings.where(F.col("user_id") != self.user_id)

    @cached_property
    def stats(self) -> DataFrame:
        if self.fitted is None:
            return staged(user_stats(self.others.unionByName(self.mine), self.lo, self.hi), "user-stats")
        known = self.ratings.where(F.col("user_id") == self.user_id)
        return staged(self.fitted.merge(added=self.mine, removed=known).stats, "user-stats")

    @cached_property
    def n_users(self) -> int:
        return self.stats.count()

    def neighbours(self, k: int) -> DataFrame:
        sims = personal_similarities(self.others, self.mine, self.n_mine, self.stats, self.user_id, self.lo, self.hi)
        return nearest(sims, self.n_users, k)

    def predict(self, *k_values: int) -> DataFrame:
        """``(item_id, k<k>...)`` for the items that the user has not rated."""
        near = staged(self.neighbours(max(k_values)), "personal-neighbours")
        return personal_predictions(self.others, self.mine, self.stats, near, self.user_id, k_values, self.lo, self.hi)


def named(predicted: DataFrame, column: str) -> DataFrame:
    """A single prediction column as ``prediction``."""
    return predicted.select("user_id", "item_id", "rating", F.col(column).alias("prediction"))
