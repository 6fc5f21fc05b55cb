"""Toxicity scores from weak supervision.

1. Terms (words, and beginnings of words, since insults are inflected) that stand out in documents labelled toxic make voters, next to a few voters for
   patterns of writing. A voter says toxic, clean or nothing about a text.
2. A generative label model is fitted to the votes alone, by expectation maximization: the share of toxic texts and what
   each voter says of either kind. Voters that agree more than that explains are correlated, and each counts for its part of the group it forms.
3. A linear classifier is trained on the posterior labels; its score is the result.

Fitting uses at most ``SAMPLE`` labelled rows, chosen by a hash of the id, never those whose crc32(doc_id) mod ``FOLDS`` is 0. What is
collected of them is bounded by that number and ``TERMS``. Scoring reads every text as a whole, and nothing but the text.

Defined results: null and empty texts are texts without terms, and are scored. Rows are scored one by one, so repeated rows
get equal scores. Labels without a document, null labels and null ids are ignored; equal texts with equal labels count once. With no labelled row, or labels of one kind only, the score is
the share of toxic labels, 0 without labels. Empty tables give empty tables. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import staged

FOLDS = 5
SAMPLE = 12_000  # labelled rows that the fit may use
TERMS = 256  # terms that become voters
LEAST_DOCUMENTS = 4  # toxic documents of the sample that a term must occur in
SEVERAL = (2, 3, 4, 6, 9)
LEAST_PRECISION = 0.5  # share of a term's documents that must be toxic
CHANCE = 0.2  # expected number of voters that stand out by chance
PREFIXES = (4, 5, 6, 7)
ROUNDS = 30
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def terms_of(text: str) -> set[str]:
    """The distinct words of a text, and with a ``*`` the beginnings of the longer ones."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


PATTERNS = (  # voters for patterns of writing: they say toxic, or nothing
    re.compile(r"[!?]{3,}"),
    re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{2,}){3,}"),
    re.compile(r"[a-z][@$*#!]{1,3}[a-z]"),
    re.compile(r"\b(?:you|du|tu|vous|eres)\b[^.\n]{0,20}\b(?:are|bist|es|êtes|un|una|ein|a)\b", re.I),
)


@dataclass(frozen=True)
class Model:
    """Weights of the voters' votes, and a constant."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    constant: float

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(votes(texts, self.terms) @ np.array(self.weights) + self.constant)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def votes(texts: list[str], terms: tuple[str, ...]) -> np.ndarray:
    """1 for toxic, -1 for clean, 0 for nothing. The columns: one per term; one per number in ``SEVERAL``, for so many different words
    that a term covers; one per pattern; and one that says clean of texts without any term."""
    place = {t: i for i, t in enumerate(terms)}
    beginnings = [(n, {t[:-1]: i for t, i in place.items() if t[-1] == "*" and len(t) == n + 1}) for n in PREFIXES]
    beginnings = [(n, known) for n, known in beginnings if known]
    heads = {t.rstrip("*")[: PREFIXES[0]] for t in terms}
    found = np.zeros((len(texts), len(terms) + len(SEVERAL) + len(PATTERNS) + 1), dtype=np.int8)
    for row, text in enumerate(texts):
        hits = 0
        for word in {w for w in WORD.findall(text.lower()) if w[: PREFIXES[0]] in heads}:
            covering = [place[word]] if word in place else []
            covering += [known[word[:n]] for n, known in beginnings if len(word) > n and word[:n] in known]
            if covering:
                hits += 1
                found[row, covering] = 1
        for i, number in enumerate(SEVERAL):
            found[row, len(terms) + i] = hits >= number
        for i, pattern in enumerate(PATTERNS):
            found[row, len(terms) + len(SEVERAL) + i] = pattern.search(text) is not None
        found[row, -1] = -(hits == 0)
    return found


def label_model(voted: np.ndarray, weight: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Posterior probability that a text with such votes is toxic, for each row of votes, which stands for ``weight`` texts.

    Every voter has its own rates of votes for toxic and for clean texts. Voters that are correlated beyond the classes
    share one voice: a voter's evidence is divided by the sum of its residual correlations. ``anchor`` is where the
    search begins, the share of toxic labels for these votes.
    """
    values = [voted == v for v in (-1, 0, 1)]
    posterior = np.clip(anchor, 0.02, 0.98)
    share = 1 / residual_correlations(voted.astype(float), weight, posterior).sum(1)
    for _ in range(ROUNDS):
        toxic, clean = weight * posterior, weight * (1 - posterior)
        prior = np.clip(toxic.sum() / weight.sum(), 1e-4, 1 - 1e-4)
        evidence = np.full(len(voted), np.log(prior) - np.log1p(-prior))
        for value in values:
            up = (toxic @ value + 0.05) / (toxic.sum() + 0.15)
            down = (clean @ value + 0.05) / (clean.sum() + 0.15)
            evidence += value @ (share * (np.log(up) - np.log(down)))
        before, posterior = posterior, _sigmoid(evidence)
        if np.abs(posterior - before).max() < 1e-4:
            break
    return posterior


def residual_correlations(voted: np.ndarray, weight: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Correlations of the voters that the classes do not explain; those below 0.3 are set to 0."""
    expected = sum(np.outer(p, (weight * p) @ voted / max((weight * p).sum(), 1e-9)) for p in (posterior, 1 - posterior))
    rest = (voted - expected) * np.sqrt(weight / weight.sum())[:, None]
    spread = np.sqrt((rest**2).sum(0)) + 1e-9
    found = np.abs((rest / spread).T @ (rest / spread))
    found[found < 0.3] = 0
    np.fill_diagonal(found, 1)
    return found


def linear_classifier(x: np.ndarray, weight: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ w)
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, x.T @ (weight * (p - y)) + ridge * w)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def tail_log(k: int, n: int, p: float) -> float:
    """Logarithm of an upper bound of the probability of ``k`` or more hits in ``n`` draws (Chernoff)."""
    if k <= n * p:
        return 0.0
    miss = (n - k) * log((n - k) / (n * (1 - p))) if k < n else 0.0
    return -(k * log(k / (n * p)) + miss)


def choose_terms(found: list[tuple[str, int, int]], toxic: int, clean: int, tested: int) -> tuple[str, ...]:
    """Of ``(term, toxic documents, clean documents)``, those least likely to stand out by chance among the terms tested, and
    none that a chosen beginning covers."""
    share = toxic / (toxic + clean)
    ranked = sorted((tail_log(t, t + c, share), term) for term, t, c in found)
    chosen: list[str] = []
    for chance, term in ranked:
        covered = any(k[-1] == "*" and term.rstrip("*").startswith(k[:-1]) for k in chosen)
        if chance < log(CHANCE / max(tested, 1)) and not covered and len(chosen) < TERMS:
            chosen.append(term)
    return tuple(chosen)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for term in terms_of(text):
                counts.setdefault(term, [0, 0])[toxic] += 1
        columns = [pa.array(counts.keys(), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(text, toxic)`` of at most about ``sample`` labelled documents outside the held-out fold, as a table; copies count once."""
    usable = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    total = usable.count()
    if total > sample:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit((1 << 20) * sample // total))
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The sample has a bounded number of ids, whatever the size of the tables.
    return staged(chosen.join(F.broadcast(usable), "doc_id").select("text", "toxic").distinct(), "toxicity-sample")


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(documents, labels, sample)
    toxic, total = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if toxic in (0, total):
        share = toxic / total if total else 0.0
        return Model((), (0.0,) * (len(SEVERAL) + len(PATTERNS) + 1), 30.0 if share else -30.0)
    counts = rows.mapInArrow(_term_batches, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    counts = staged(counts.where(F.col("t") + F.col("c") >= LEAST_DOCUMENTS), "toxicity-terms")
    standing_out = counts.where((F.col("t") >= LEAST_DOCUMENTS) & (F.col("t") >= (F.col("t") + F.col("c")) * LEAST_PRECISION))
    found = standing_out.orderBy(F.desc(F.col("t") * F.col("t") / (F.col("c") + 1)), "term").limit(16 * TERMS).collect()
    terms = choose_terms([tuple(r) for r in found], toxic, total - toxic, counts.count())

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [v.tobytes() for v in votes(batch.column("text").to_pylist(), terms)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("toxic")], ["votes", "toxic"])

    # At most as many rows as the sample has.
    seen = rows.mapInArrow(vote, "votes binary, toxic int").groupBy("votes").agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("toxic"))
    seen = seen.orderBy("votes").collect()
    voted = np.stack([np.frombuffer(r.votes, dtype=np.int8) for r in seen])
    weight = np.array([r.n for r in seen], dtype=float)
    posterior = label_model(voted, weight, np.array([r.toxic for r in seen]))
    weights, constant = linear_classifier(voted.astype(float), weight, posterior)
    return Model(terms, tuple(weights.tolist()), constant)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``(row, score)`` for every document, ``row`` holding all its columns but the text, unchanged, and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text").to_pylist()
            scores = [model.scores([t or "" for t in texts[i : i + 256]]) for i in range(0, len(texts), 256)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["row", "score"])

    rows = documents.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def without_toxic(documents: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents that score below the limit."""
    return score(documents, model).where(F.col("score") < limit).select("row.*")
