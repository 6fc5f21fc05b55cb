"""Predictions: a user's mean plus the similarity-weighted mean deviation of the item's raters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import denormalized, first_of, pair_key, safe_ratio, second_of, symmetric_pair_key, units_similarity
from kindred.operators.blocks import Groups, dealt, group_join, group_lists_join, group_rows, meet, partitions_for
from kindred.operators.neighbours import positive_units
from kindred.operators.similarity import metric_column
from kindred.params import RATING_HI, RATING_LO


def rater_evidence(test: DataFrame, normed: DataFrame, groups: Groups) -> DataFrame:
    """``(user_id, item_id, rater, dev)``: for each row to predict, the raters of its item."""
    wanted = test.select("item_id", "user_id")
    raters = normed.select("item_id", F.col("user_id").alias("rater"), "dev")
    return group_join(raters, wanted, groups, ("rater", "user_id"))


def _keyed(evidence: DataFrame, pair: Column) -> DataFrame:
    return evidence.select("user_id", "item_id", "dev", pair.alias("pair"))


def with_similarity(
    evidence: DataFrame, pairs: DataFrame, metrics: Sequence[str] | Mapping[str, Column], n_evidence: float = 0
) -> DataFrame:
    """Attach the similarities of user and rater, one column per metric. A rater who shares no item
    with the user has no weight and is left out."""
    columns = metrics if isinstance(metrics, Mapping) else {m: metric_column(m) for m in metrics}
    sims = pairs.select("pair", *[column.alias(m) for m, column in columns.items()])
    keyed = _keyed(evidence, symmetric_pair_key(F.col("user_id"), F.col("rater")))
    return dealt(keyed, n_evidence, "pair").join(dealt(sims, n_evidence, "pair"), "pair")


def asked_lists(test: DataFrame, normed: DataFrame, groups: Groups) -> DataFrame:
    """:func:`rater_evidence` as lists ``(item_id, raters, devs, askers)``: each asker meets each rater. In hot groups, a row is a cell of their blocks."""
    raters = normed.select("item_id", F.col("user_id").alias("rater"), "dev")
    rows, keys = group_rows(raters, test.select("item_id", "user_id"), groups, ("rater", "user_id"))
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("rater").isNotNull(), F.struct("rater", "dev")))).alias("own"), F.sort_array(F.collect_list("user_id")).alias("askers"))
    both = lists.where((F.size("own") > 0) & (F.size("askers") > 0))
    return both.select("item_id", F.col("own.rater").alias("raters"), F.col("own.dev").alias("devs"), "askers")


def asked_of(lists: DataFrame, chosen: Callable[[Column], Column]) -> DataFrame:
    """``(user_id, item_id, raters, devs)`` of the chosen askers."""
    return lists.select(F.explode(F.filter("askers", chosen)).alias("user_id"), "item_id", "raters", "devs")


def similar_evidence_of(lists: DataFrame, asked: DataFrame, terms: Mapping, columns: Mapping[str, Column], entries: float, most: float) -> DataFrame:
    """:func:`similar_evidence` of some users, whose ``lists`` are whole and who are those of ``asked``."""
    evidence = asked.select(
        F.col("user_id").alias("pair_first"),
        F.col("raters").alias("pair_second"),
        "item_id",
        F.lit(True).alias("user_first"),
        F.lit(None).cast("double").alias("dev_one"),
        F.col("devs").alias("dev_all"),
    )
    return similar_evidence(lists, evidence, terms, columns, entries, most)


def evidence_lists(test: DataFrame, normed: DataFrame, groups: Groups) -> DataFrame:
    """:func:`rater_evidence` as lists for :func:`kindred.operators.blocks.meet`: ``(pair_first, pair_second, item_id, user_first, dev_one, dev_all)``.

    Raters whose id is not smaller than the user's are a list next to the user; users with a larger id than the rater are a list next to the rater."""
    wanted = test.select("item_id", "user_id")
    raters = normed.select("item_id", F.col("user_id").alias("rater"), "dev")
    after = lambda column, first: F.slice(column, first, F.size("own"))
    here = group_lists_join(raters, wanted, groups, ("rater", "user_id"))
    first = F.size(F.filter("own.rater", lambda r: r < F.col("user_id"))) + 1
    of_user = here.select(
        F.col("user_id").alias("pair_first"),
        after("own.rater", first).alias("pair_second"),
        "item_id",
        F.lit(True).alias("user_first"),
        F.lit(None).cast("double").alias("dev_one"),
        after("own.dev", first).alias("dev_all"),
    )
    there = group_lists_join(wanted, raters, groups, ("user_id", "rater"), swapped=True)
    first = F.size(F.filter("own.user_id", lambda u: u <= F.col("rater"))) + 1
    of_rater = there.select(
        F.col("rater").alias("pair_first"),
        after("own.user_id", first).alias("pair_second"),
        "item_id",
        F.lit(False).alias("user_first"),
        F.col("dev").alias("dev_one"),
        F.lit(None).cast("array<double>").alias("dev_all"),
    )
    return of_user.unionByName(of_rater).where(F.size("pair_second") > 0)


def similar_evidence(lists: DataFrame, evidence: DataFrame, terms: Mapping, columns: Mapping[str, Column], entries: float, most: float) -> DataFrame:
    """``(user_id, item_id, dev, <metric>...)``: the evidence with the similarities of user and rater, as :func:`with_similarity` attaches them.

    The matches of a pair and the evidence that needs its similarity are sent to one place as lists, so neither pairs nor evidence are shuffled row by row. ``terms`` are
    added up over the matches, and ``columns`` are expressions over them."""
    found, keys = meet(lists.unionByName(evidence, allowMissingColumns=True), entries, most)
    is_match = F.col("item_id").isNull()
    pair = Window.partitionBy(*keys)
    added = {name: total(F.when(is_match, term())).over(pair) for name, (total, term) in terms.items()}
    matched = found.withColumns({**added, "n_matches": F.count_if(is_match).over(pair)})
    return matched.where(~is_match & (F.col("n_matches") > 0)).select(
        F.when(F.col("user_first"), F.col("pair_first")).otherwise(F.col("pair_second")).alias("user_id"),
        "item_id",
        F.when(F.col("user_first"), F.col("dev_all")).otherwise(F.col("dev_one")).alias("dev"),
        *[column.alias(name) for name, column in columns.items()],
    )


def ranked_evidence(lists: DataFrame, test: DataFrame, rated: DataFrame, groups: Groups, k: int, most: float) -> DataFrame:
    """``(user_id, item_id, dev, sim, pos)`` as :func:`with_neighbour` gives it, where only positive similarities can be among the first ``k``, from
    the lists of matches without the users themselves. ``rated`` has the rows and columns that these are made of, ``dev`` among them.

    A user's similarities and the raters of the user's test items, as lists, are brought to one partition, where they are ranked and looked up: neither is sent
    again by pair, and a pair is sent to its second user only. ``most`` is the number of matches that a user has at most."""
    entries = 2 * groups.self_matches + groups.join_matches
    partitions = partitions_for(entries)
    positive, here = positive_units(lists, entries, most)
    # As many partitions by the same user: the union is not dealt out again, unless the pairs of a user are in several parts.
    sims = positive.select(F.col("pair_first").alias("u"), F.col("pair_second").alias("v"), "units")
    if len(here) > 1:
        sims = sims.repartition(partitions, "u")
    back = positive.select(pair_key(F.col("pair_second"), F.col("pair_first")).alias("pair"), "units").repartition(partitions, first_of(F.col("pair")))
    sims = sims.unionByName(back.select(first_of(F.col("pair")).alias("u"), second_of(F.col("pair")).alias("v"), "units"))
    wanted = test.select("item_id", F.col("user_id").alias("asker"))
    found = group_lists_join(rated, wanted, groups, ("user_id", "asker"), tasks=groups.self_tasks)
    sent = found.select(F.col("asker").alias("u"), "item_id", F.col("own.user_id").alias("raters"), F.col("own.dev").alias("devs"))
    return _ranked(sims, sent.repartition(partitions, "u"), k)


def ranked_evidence_of(lists: DataFrame, asked: DataFrame, k: int, entries: float, most: float) -> DataFrame:
    """:func:`ranked_evidence` of some users, whose ``lists`` are whole and who are those of ``asked``: no pair is sent again."""
    partitions = partitions_for(entries)
    positive, here = positive_units(lists, entries, most)
    sims = positive.select(F.col("pair_first").alias("u"), F.col("pair_second").alias("v"), "units")
    if len(here) > 1:
        sims = sims.repartition(partitions, "u")
    return _ranked(sims, asked.select(F.col("user_id").alias("u"), "item_id", "raters", "devs").repartition(partitions, "u"), k)


def _ranked(sims: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    asked = sent.select("u", "item_id", "devs", F.posexplode("raters").alias("at", "v")).select("u", "v", "item_id", F.get("devs", F.col("at")).alias("dev"))
    rows = sims.select("u", "v", "units", F.lit(True).alias("listed")).unionByName(asked, allowMissingColumns=True)
    known = rows.withColumn("units", F.max("units").over(Window.partitionBy("u", "v"))).where("units is not null")
    # The rows of a neighbour share a place; ranks are dense, since every neighbour has some.
    placed = known.withColumn("pos", F.dense_rank().over(Window.partitionBy("u").orderBy(F.desc("units"), "v")).cast("long"))
    return placed.where(F.col("listed").isNull() & (F.col("pos") <= k)).select(
        F.col("u").alias("user_id"), "item_id", "dev", units_similarity(F.col("units")).alias("sim"), "pos"
    )


def with_neighbour(evidence: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Attach the rater's place among the user's neighbours; other raters are left out."""
    placed = neighbours.select(pair_key(F.col("u"), F.col("v")).alias("pair"), "sim", "pos")
    return _keyed(evidence, pair_key(F.col("user_id"), F.col("rater"))).join(placed, "pair")


def neighbour_evidence(test: DataFrame, normed: DataFrame, neighbours: DataFrame, n_evidence: float = 0) -> DataFrame:
    """``(user_id, item_id, dev, sim, pos)``: for each row to predict, those of its user's neighbours who rated the item.

    As many rows are looked up as the test rows have neighbours, however many raters their items have."""
    asked = test.select("user_id", "item_id").join(neighbours.select(F.col("u").alias("user_id"), "v", "sim", "pos"), "user_id")
    raters = normed.select(F.col("user_id").alias("v"), "item_id", "dev")
    return dealt(asked, n_evidence, "v", "item_id").join(dealt(raters, n_evidence, "v", "item_id"), ["v", "item_id"]).drop("v")


def metric_weights(metrics: Iterable[str]) -> dict[str, Column]:
    return {m: F.col(m) for m in metrics}


def neighbour_weights(k_values: Sequence[int]) -> dict[str, Column]:
    return {f"k{k}": F.when(F.col("pos") <= k, F.col("sim")).otherwise(F.lit(0.0)) for k in k_values}


def weighted_sums(evidence: DataFrame, keys: list[str], weights: dict[str, Column]) -> DataFrame:
    """Sums of weight times deviation and of absolute weight, for several weights in one pass."""
    sums = []
    for name, weight in weights.items():
        sums += [F.sum(weight * F.col("dev")).alias(f"{name}_num"), F.sum(F.abs(weight)).alias(f"{name}_den")]
    return evidence.groupBy(*keys).agg(*sums)


def errors_by_k(
    test: DataFrame, evidence: DataFrame, max_k: int, lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """``(k, mae, n)`` for every k from 1 to ``max_k``, from neighbour evidence up to that k and test rows with ``user_avg``.

    Along the rank of the neighbours, the prediction of a test row changes only where one of them rated the item: there, running sums
    give the new prediction, and the difference of its error to the one before. Added up by rank, and then over the ranks, the differences are the
    sum of all errors for every k. So the plan and its rows do not depend on how many k are asked for; only one row per rank is
    summed up in one task. Without neighbours, the prediction is the user's mean.
    """
    return errors_of_steps(test, error_steps(test, evidence, lo, hi), max_k)


def error_steps(test: DataFrame, evidence: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """``(pos, change)``: what the sum of all errors changes by at a rank. Those of several parts of the test rows add up."""
    keys = ["user_id", "item_id"]
    along = Window.partitionBy(*keys).orderBy("pos")
    to_here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = evidence.select(
        *keys,
        "pos",
        F.sum(F.col("sim") * F.col("dev")).over(to_here).alias("num"),
        F.sum(F.abs("sim")).over(to_here).alias("den"),
    )
    rows = test.select(*keys, "rating", "user_avg")
    predicted = denormalized(F.col("user_avg"), safe_ratio(F.col("num"), F.col("den")), lo, hi)
    errors = sums.join(rows.hint("shuffle_hash"), keys).withColumn("error", F.abs(F.col("rating") - predicted))
    change = F.col("error") - F.coalesce(F.lag("error").over(along), _first_error())
    return errors.select("pos", change.alias("change")).groupBy("pos").agg(F.sum("change").alias("change"))


def _first_error() -> Column:
    return F.abs(F.col("rating") - F.col("user_avg"))


def errors_of_steps(test: DataFrame, steps: DataFrame, max_k: int) -> DataFrame:
    """:func:`errors_by_k` from the steps of all test rows, one for each rank."""
    start = test.agg(F.sum(_first_error()).alias("first"), F.count(F.lit(1)).alias("n"))
    ranks = start.select("first", "n", F.explode(F.sequence(F.lit(1), F.lit(max_k))).alias("k"))
    found = ranks.join(steps, F.col("k") == F.col("pos"), "left")
    total = F.col("first") + F.sum(F.coalesce("change", F.lit(0.0))).over(Window.orderBy("k"))
    return found.select("k", F.try_divide(total, F.col("n")).alias("mae"), "n")


def weighted_deviation(test: DataFrame, evidence: DataFrame, weights: dict[str, Column]) -> DataFrame:
    """The rows of ``test`` with one column per weight; 0 where no rater has any weight."""
    keys = ["user_id", "item_id"]
    joined = test.join(weighted_sums(evidence, keys, weights), keys, "left")
    return joined.select(
        *test.columns, *[safe_ratio(F.col(f"{w}_num"), F.col(f"{w}_den")).alias(w) for w in weights]
    )


def predictions(
    deviations: DataFrame, names: list[str], lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """Turn the deviation columns ``names`` into ratings around ``user_avg``."""
    return deviations.withColumns(
        {name: denormalized(F.col("user_avg"), F.col(name), lo, hi) for name in names}
    )
