"""Secret scans driven by a trigram index.

For every rule, a Boolean query over trigrams is derived from its regular expression: trigrams without which no match
is possible. An inverted index over those trigrams lists the documents that hold each of them; per rule the lists are
intersected and united, and only the documents that remain are searched with the expression itself. A rule that
requires no trigram is searched for in every document.

Only built-in functions are used. The index covers the trigrams that some rule asks for; a text is searched for them
as a whole, in lower case, so that letters of either case are found.

Spans are in code points, the end exclusive. Expressions match from the left without overlaps, and a match whose
secret is too short is dropped after that, so that it still hides what it covers.

Defined results: a null text is like an empty one: no spans. Documents equal in id and text get equal spans, each.
Empty tables give empty tables. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product
from re import _constants as C  # type: ignore[attr-defined]
from re import _parser  # type: ignore[attr-defined]

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import staged


@dataclass(frozen=True)
class Rule:
    """``head`` then ``secret``, a match if the secret has ``least`` characters. ``any_case``: the letters of ``head``."""

    kind: str
    head: str
    secret: str
    least: int
    any_case: bool = False
    base: bool = False

    @property
    def pattern(self) -> str:
        return ("(?i)" if self.any_case else "") + f"({self.head})({self.secret})"


# The three base rules, in the order in which ties are listed.
BASE_RULES = (
    Rule("assign", r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 8, True, True),
    Rule("access", "", r"AKIA[A-Z0-9]+", 16, False, True),
    Rule("hex", "", r"[0-9a-f]+", 32, False, True),
)
# Public formats of well-known credentials.
MORE_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", 35),
    Rule("stripe", r"[rs]k_live_", r"[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20),
    Rule("private_key", r"-----BEGIN ", r"(?:[A-Z]+ )*PRIVATE KEY-----", 10),
)
RULES = BASE_RULES + MORE_RULES

MOST_STRINGS = 16  # a part of an expression that stands for more strings than this is taken to stand for any


def _strings(items: Sequence) -> list[list[str] | None]:
    """The expression as a sequence of parts: the lower-cased strings that a part can be, or None for any."""
    parts: list[list[str] | None] = []
    for op, value in items:
        if op is C.LITERAL:
            parts.append([chr(value).lower()])
        elif op is C.IN:
            parts.append(_of_class(value))
        elif op is C.SUBPATTERN:
            parts += _strings(value[-1])
        elif op is C.BRANCH:
            branches = [_joined(_strings(branch)) for branch in value[1]]
            parts.append([s for b in branches for s in b] if all(b is not None for b in branches) else None)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] == 1 and (once := _joined(_strings(value[2]))) is not None:
            parts.append(["", *once] if value[0] == 0 else once)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] >= 1:
            parts += [*_strings(value[2]), None]
        else:
            parts.append(None)
    return parts


def _of_class(items: Sequence) -> list[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            found.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return sorted(found)


def _joined(parts: Sequence[list[str] | None]) -> list[str] | None:
    """All strings that the parts make together, or None if there are too many."""
    found = [""]
    for part in parts:
        if part is None or len(found) * len(part) > MOST_STRINGS:
            return None
        found = ["".join(p) for p in product(found, part)]
    return found


def trigram_query(pattern: str) -> list[list[str]]:
    """Sets of trigrams of which a matching text holds at least one in full; ``[]`` if nothing can be demanded.

    The runs of consecutive parts with few strings are joined. The run that demands most is used.
    """
    runs: list[list[list[str]]] = [[]]
    for part in _strings(_parser.parse(pattern)):
        if part is None:
            runs.append([])
        elif _joined([*runs[-1], part]) is None:
            runs.append([part])
        else:
            runs[-1].append(part)
    queries = []
    for run in runs:
        clauses = [sorted({s[i : i + 3] for i in range(len(s) - 2)}) for s in _joined(run) or [""]]
        if all(clauses):
            queries.append([list(c) for c in sorted(set(map(tuple, clauses)))])
    return max(queries, key=lambda q: min(map(len, q)), default=[])


def _key() -> Column:
    return F.xxhash64(F.col("row.doc_id"), F.col("row.text"))


def trigram_index(documents: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """``(trigram, key)``: the posting lists of the trigrams."""
    texts = documents.select(_key().alias("key"), F.lower("row.text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return texts.select("key", F.explode(F.array_compact(held)).alias("trigram")).distinct()


def candidates(postings: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """``(key, kinds)``: the rules whose trigram query the postings of a document satisfy."""
    clauses = [(kind, n, t, len(c)) for kind, q in queries.items() for n, c in enumerate(q) for t in c]
    asked = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("kind", "clause", "trigram", "needs"), c)]) for c in clauses]))
    table = postings.sparkSession.range(1).select(asked.alias("c")).select("c.*")
    satisfied = postings.join(F.broadcast(table), "trigram").groupBy("key", "kind", "clause", "needs").agg(F.count(F.lit(1)).alias("n"))
    return satisfied.where("n = needs").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


# Marks around matches. Where a text has these characters itself, another one of the same length stands in.
OPEN, MIDDLE, CLOSE, PLAIN = "\x01", "\x02", "\x03", "\x04"


def pieces_of(rule: Rule, text: Column) -> Column:
    """The text cut before each match, with marks after the head and the secret of the match."""
    plain = F.translate(text, OPEN + MIDDLE + CLOSE, PLAIN * 3)
    return F.split(F.regexp_replace(plain, F.lit(rule.pattern), F.lit(f"{OPEN}$1{MIDDLE}$2{CLOSE}")), OPEN)


def spans_of(rule: Rule, order: int, pieces: Column) -> Column:
    """Array of ``(start, order, end, kind)``, by start: the matches of one rule."""
    head = lambda p: F.char_length(F.substring_index(p, MIDDLE, 1))
    secret = lambda p: F.char_length(F.substring_index(F.substring_index(p, CLOSE, 1), MIDDLE, -1))
    start = F.struct(F.char_length(F.element_at(pieces, 1)).alias("at"), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + head(piece) + secret(piece)
        span = F.struct(state["at"].alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        more = F.when(secret(piece) >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((state["at"] + F.char_length(piece) - 2).alias("at"), more.alias("found"))

    return F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, step, lambda s: s["found"])


def _run_of_one_class(rule: Rule) -> Rule:
    """A rule that is one class repeated, as the same rule that only matches runs that are long enough."""
    one_class = re.fullmatch(r"\[[^]]+\]\+", rule.secret) and not rule.head
    return replace(rule, secret=f"{rule.secret[:-1]}{{{rule.least},}}") if one_class else rule


def scan(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(row, spans)`` for every document: ``row`` holds all its columns, ``spans`` is an array of
    ``(start, rank, end, kind)`` in that order."""
    rows = documents.select(F.struct("*").alias("row"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q}
    rows = rows.withColumn("key", _key())
    if indexed:
        trigrams = sorted({t for q in indexed.values() for c in q for t in c})
        rows = rows.join(staged(candidates(trigram_index(rows, trigrams), indexed), "secret-candidates"), "key", "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    text, nothing = F.col("row.text"), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    pieces, found = [], []
    for order, rule in enumerate(rules):
        searched = _run_of_one_class(rule)
        wanted = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.rlike(text, F.lit(searched.pattern))
        pieces.append(F.when(wanted, pieces_of(searched, text)).alias(rule.kind))
        found.append(F.coalesce(spans_of(rule, order, F.col(f"pieces.{rule.kind}")), nothing))
    cut = rows.select("row", F.struct(*pieces).alias("pieces"))
    any_found = reduce(lambda a, b: a | b, [F.col(f"pieces.{r.kind}").isNotNull() for r in rules])
    spans = F.when(any_found, F.array_sort(F.concat(*found))).otherwise(nothing)
    return cut.select("row", spans.alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
