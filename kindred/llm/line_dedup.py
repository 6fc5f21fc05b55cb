"""Line dedup by a segment-partition edit join.

A line is a maximal run without line feeds, compared without white space at its ends. Lines are linked if they are equal or
within ``MAX_EDITS`` edits of each other; of each component of linked lines the first occurrence stays, by id, place in
the text, and text, and all others are removed. Links count only between lines of at least ``LEAST_CHARS`` characters: two edits in
a short line make another line of it. Shorter lines are removed only if they are equal.

Within t edits, one of t + 1 segments of the one line must appear in the other, near the same place. So every distinct line
is cut into t + 1 segments that are indexed with its length, and probes the index of each length from its own down to t less with
the substrings that can match: of segment i, those shifted by at most i edits on the left and t - i on the right. Pairs
that meet, and that agree in the counts of some letters and in smaller pieces as far as the edits allow, are verified with a banded edit distance that keeps a column of the band as bits of one number. The lists of segments that
very many lines share are not paired up: see :func:`kindred.llm.graph.linked_lists`.

Only built-in functions are used. A line is known by a 64-bit hash; among 10 million different lines, the chance that any two
have the same one is 3e-6.

Defined results: blank lines stay; a null text stays null and an empty one empty; a text whose lines are all removed becomes empty (see
``drop_emptied``); rows equal in id and text are one document, and its removals apply to each of them. An empty table gives
an empty table. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.graph import linked_lists
from kindred.llm.narrow import narrowed
from kindred.session import staged

MAX_EDITS = 2
LEAST_CHARS = 30
LETTERS = "entaoirs"
BLANKS = " \t\r\v\f"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, pos, line)`` of the lines that are not blank."""
    cut = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.col("line")
    # Trimming looks at every character, so lines that have no blanks at their ends are spared it.
    blank = reduce(Column.__or__, [end(line, F.lit(c)) for c in BLANKS for end in (F.startswith, F.endswith)])
    return cut.withColumn("line", F.when(blank, _trimmed(line)).otherwise(line)).where("line <> ''")


def segment_bounds(length: Column, part: int, edits: int) -> tuple[Column, Column]:
    """Where segment ``part`` of a line begins, from 1, and its length: the last segments take up the remainder."""
    parts = edits + 1
    base = F.floor(length / parts).cast("int")
    short = F.lit(parts) - F.pmod(length, F.lit(parts))  # so many segments are one shorter than the others
    return (base * part + F.greatest(F.lit(part) - short, F.lit(0)) + 1).cast("int"), base + (F.lit(part) >= short).cast("int")


def _probe_shifts(edits: int) -> list[tuple[int, int, int]]:
    """``(less, part, shift)``: for a line ``less`` characters shorter, by how much segment ``part`` may be shifted in the longer one.

    With ``part`` segments before it and no match among them, at least ``part`` edits lie on the left; at most
    ``edits - part`` may lie on the right.
    """
    found = []
    for less in range(edits + 1):
        for part in range(edits + 1):
            for shift in range(-edits, edits + 1):
                if abs(shift) <= part and abs(shift - less) <= edits - part:
                    found.append((less, part, shift))
    return found


def _entry(length: Column, part: int, line: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(part), F.substring(line, start, size))


def letter_counts(line: Column) -> Column:
    """How often each of eight letters occurs, up to 255, a byte each. An edit changes two of the counts by one at most."""
    each = [F.least(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))), F.lit(255)) for c in LETTERS]
    return reduce(Column.bitwiseOR, [F.shiftleft(count.cast("long"), 8 * i) for i, count in enumerate(each)])


def counts_differ(a: Column, b: Column) -> Column:
    """The sum of the differences of the letter counts."""
    byte = lambda x, i: F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))
    return reduce(Column.__add__, [F.abs(byte(a, i) - byte(b, i)) for i in range(len(LETTERS))])


def distinct_lines(lines: DataFrame, edits: int) -> DataFrame:
    """``(node, n, length, probe...)`` per distinct line: how often it occurs, and the index entries to probe.

    Those of a line's own length without a shift are its own entries."""
    line, length = F.col("line"), F.col("length")
    sized = lines.select(F.xxhash64("line").alias("node"), "line", F.char_length("line").alias("length"))
    entries = []
    for i, (less, part, shift) in enumerate(_probe_shifts(edits)):
        start, size = segment_bounds(length - less, part, edits)
        # A start before the line stands for no substring: its entry is one that no index has.
        entry = F.when(start + shift >= 1, _entry(length - less, part, line, start + shift, size)).otherwise(F.col("node"))
        entries.append(entry.alias(f"probe{i}"))
    rows = sized.select("node", "length", *entries)
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in rows.columns[1:]])


def segment_lists(lines: DataFrame, edits: int, least_chars: int) -> DataFrame:
    """``(item, node)``: for each entry of the index that another line probes, all lines that have or probe it."""
    long_lines = lines.where(F.col("length") >= least_chars)
    shifts = _probe_shifts(edits)
    own = F.array(*[F.col(f"probe{i}") for i, (less, _, shift) in enumerate(shifts) if not less and not shift])
    probes = F.array_distinct(F.array(*[F.col(f"probe{i}") for i in range(len(shifts))]))
    index = long_lines.select(F.explode(own).alias("item"), F.col("node").alias("other"))
    index = index.groupBy("item").agg(F.min("other").alias("lo"), F.max("other").alias("hi"))
    # Lists are not sorted: their entries, most of which nobody else probes, are looked up in a hash table.
    met = long_lines.select(F.explode(probes).alias("item"), "node").join(index.hint("shuffle_hash"), "item").where("lo <> node or hi <> node")
    return met.select("item", F.explode(F.array("node", "lo")).alias("node")).distinct()


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _unlike(ends: Column) -> Column:
    """The character arrays ``a``, the longer, and ``b`` of a struct from their first difference on, turned round."""
    place = F.array_position(F.zip_with(ends["a"], ends["b"], lambda x, y: ~x.eqNullSafe(y)), True)
    rest = lambda s, x: F.reverse(F.slice(x, F.when(s["place"] == 0, F.size(x) + 1).otherwise(s["place"]).cast("int"), F.size(x)))
    placed = F.struct(ends["a"].alias("a"), ends["b"].alias("b"), place.alias("place"))
    return _bound(placed, lambda s: F.struct(rest(s, s["a"]).alias("a"), rest(s, s["b"]).alias("b")))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the character arrays ``a``, the longer, and ``b`` are at most ``edits`` edits apart.

    What both begin or end with has no part in the distance, and is left out.
    """
    ends = _bound(F.struct(a.alias("a"), b.alias("b")), _unlike)
    return _bound(ends, lambda first: _bound(_unlike(first), lambda s: F.when(F.size(s["b"]) == 0, F.size(s["a"]) <= edits).otherwise(_banded(s["a"], s["b"], edits))))


def _banded(a: Column, b: Column, edits: int) -> Column:
    """:func:`within_edits` of arrays that are not empty.

    One column of the band around the diagonal is held as two numbers of ``2 * edits + 1`` bits: where the distance grows
    and where it falls from one cell to the next. Each character of ``b`` moves the band down by one, with a few operations
    on whole columns. The distance is followed along the band's lower edge, where it never falls, and along the last row at the
    end, for ``edits`` columns at most: once it is beyond twice the edits, it stays too large.
    """
    top = 2 * edits
    band = F.lit((1 << (top + 1)) - 1).cast("long")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    state = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << (top - edits)).cast("long").alias("up"), zero.alias("down"), F.least(F.lit(edits), F.size(a)).alias("distance")
    )
    lower_edge = F.size(a) - edits

    def step(s: Column, i: Column) -> Column:
        return F.when(s["distance"] > 2 * edits, s).otherwise(_advanced(_same(s, i)))

    def _same(s: Column, i: Column) -> Column:
        here = F.get(b, i)
        same = F.lit(0).cast("long")
        for bit in range(top + 1):
            hit = F.get(a, i + (bit - edits)) == here
            same = same + F.when(hit, F.lit(1 << bit).cast("long")).otherwise(zero)
        edge = F.when(i < lower_edge, F.lit(-1)).otherwise(F.lit(top - 1) - (i - lower_edge))
        return F.struct(s["up"].alias("up"), s["down"].alias("down"), s["distance"].alias("distance"), same.alias("same"), edge.alias("edge"))

    def _advanced(s: Column) -> Column:
        return F.transform(F.array(s), _next)[0]

    def _next(s: Column) -> Column:
        up, down, same = s["up"], s["down"], s["same"]
        zero_diagonal = (((same.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(same).bitwiseOR(down)).bitwiseAND(band)
        return F.transform(F.array(F.struct(up.alias("up"), down.alias("down"), s["distance"].alias("distance"), s["edge"].alias("edge"), zero_diagonal.alias("d0"))), _last)[0]

    def _last(s: Column) -> Column:
        up, down, d0, edge = s["up"], s["down"], s["d0"], s["edge"]
        grows = down.bitwiseOR(F.bitwise_not(d0.bitwiseOR(up))).bitwiseAND(band)
        falls = d0.bitwiseAND(up)
        shifted = F.shiftright(d0, 1)
        on_edge = F.when(F.shiftright(d0, top).bitwiseAND(one) == 1, 0).otherwise(1)
        at = lambda bits: F.when(edge >= 0, F.call_function("shiftright", bits, F.greatest(edge, F.lit(0))).bitwiseAND(one)).otherwise(zero).cast("int")
        distance = s["distance"] + F.when(edge < 0, on_edge).otherwise(at(grows) - at(falls))
        return F.struct(
            falls.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(grows))).bitwiseAND(band).alias("up"),
            shifted.bitwiseAND(grows).alias("down"),
            distance.alias("distance"),
        )

    places = F.sequence(F.lit(0), F.size(b) - 1)
    return F.aggregate(places, state, step, lambda s: s["distance"] <= edits)


def line_pieces(line: Column, length: Column, edits: int) -> Column:
    """A line cut into four times as many pieces as there may be edits, without the characters that are left over."""
    size = F.floor(length / (4 * edits)).cast("int")
    return F.array(*[F.substring(line, size * i + 1, size) for i in range(4 * edits)])


def pieces_match(longer: Column, length: Column, pieces: Column, edits: int) -> Column:
    """Whether all but ``edits`` of the ``pieces`` of a shorter line of that length occur in the longer one, at most as many characters off:
    every edit spoils one piece at most. Few pairs that are not close get beyond this."""
    count = 4 * edits
    size = F.floor(length / count).cast("int")
    found = []
    for i in range(count):
        window = F.substring(longer, F.greatest(size * i + 1 - edits, F.lit(1)), size + 2 * edits)
        found.append(F.contains(window, F.get(pieces, F.lit(i))))
    # One of any edits + 1 pieces must occur: most pairs are ruled out by a few of them.
    some = [reduce(Column.__or__, found[i : i + edits + 1]) for i in range(0, count - edits, edits + 1)]
    return reduce(Column.__and__, [*some, reduce(Column.__add__, [f.cast("int") for f in found], F.lit(0)) >= count - edits])


def line_texts(nodes: DataFrame, documents: DataFrame, edits: int) -> DataFrame:
    """``(node, line, letters, length, pieces)`` of the lines in ``nodes``."""
    nodes = staged(nodes.distinct(), "line-nodes")
    rows = narrowed(_lines(documents).select(F.xxhash64("line").alias("node"), "line"), "node", nodes)
    texts = rows.groupBy("node").agg(F.first("line").alias("line")).join(nodes, "node")
    texts = texts.withColumn("letters", letter_counts(F.col("line"))).withColumn("length", F.char_length("line"))
    return staged(texts.withColumn("pieces", line_pieces(F.col("line"), F.col("length"), edits)), "line-texts")


def described(lists: DataFrame, texts: DataFrame) -> DataFrame:
    """The lists with the lines themselves as a part of the trait."""
    return lists.drop("trait").join(texts, "node").select("item", "node", "component", F.struct("letters", "length", "line", "pieces").alias("trait"))


def pair_marks(line: Column) -> Column:
    """A mark, a long, for each first, second, ... occurrence of two neighbouring characters, or of the last one and the end of the line.

    An edit spoils two of them at most."""
    chars = F.split(line, "")
    pairs = F.array_sort(F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))), lambda x, y: F.xxhash64(x, y)))

    def numbered(pairs: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(pairs) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(pairs, i) != F.get(pairs, i - 1)))
        return _bound(F.concat(starts, F.array(F.size(pairs))), lambda starts: _runs(pairs, starts))

    def _runs(pairs: Column, starts: Column) -> Column:
        run = lambda r: F.transform(
            F.sequence(F.get(starts, r), F.get(starts, r + 1) - 1), lambda i: F.xxhash64(F.get(pairs, i), i - F.get(starts, r))
        )
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(starts) - 2), run))

    return F.array_distinct(_bound(pairs, numbered))


def _longer_first(a: Column, b: Column) -> tuple[Callable[[str], Column], Callable[[str], Column]]:
    """The parts of the longer and of the shorter of two lines."""
    swap = a["length"] < b["length"]
    return (lambda c: F.when(swap, b[c]).otherwise(a[c])), (lambda c: F.when(swap, a[c]).otherwise(b[c]))


def may_be_close(a: Column, b: Column, edits: int) -> Column:
    longer, shorter = _longer_first(a, b)
    lengths = F.abs(a["length"] - b["length"]) <= edits
    letters = counts_differ(a["letters"], b["letters"]) <= 2 * edits
    return lengths & letters & pieces_match(longer("line"), shorter("length"), shorter("pieces"), edits)


def close_pairs(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The pairs ``(a, b)`` of lines that are within ``edits`` edits."""
    side = lambda name: texts.select(F.col("node").alias(name), F.struct("letters", "length", "line", "pieces").alias(f"line_{name}"))
    a, b = F.col("line_a"), F.col("line_b")
    longer, shorter = _longer_first(a, b)
    near = within_edits(F.split(longer("line"), ""), F.split(shorter("line"), ""), edits)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(may_be_close(a, b, edits)).where(near).select("a", "b")


def removed_lines(documents: DataFrame, edits: int = MAX_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(doc_id, text_hash, removed)``: the places of the removed lines, for the documents that have any."""
    distinct = staged(distinct_lines(_lines(documents), edits), "distinct-lines")
    lists = staged(segment_lists(distinct, edits, least_chars), "segment-lists")
    # Few lines share an entry: only of these the letters are counted, and the texts fetched.
    texts = line_texts(lists.select("node"), documents, edits)
    lists = staged(lists.join(texts.select("node", F.col("letters").alias("trait")), "node"), "traits")
    may_link = lambda a, b: counts_differ(a, b) <= 2 * edits
    verify, describe = lambda pairs: close_pairs(pairs, texts, edits), lambda left: described(left, texts)
    marks = lambda trait: pair_marks(trait["line"])
    found = linked_lists(lists, verify, may_link, describe, lambda a, b: may_be_close(a, b, edits), marks, 2 * edits)
    groups = distinct.select("node", "n").join(found, "node", "left").where("n > 1 or component is not null")
    groups = groups.select("node", F.coalesce("component", "node").alias("component"))
    places = _lines(documents).select("doc_id", "text_hash", "pos", F.xxhash64("line").alias("node")).join(staged(groups, "line-groups"), "node")
    places = staged(places.drop("node"), "repeated-lines")
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "pos", "text_hash")
    firsts = places.groupBy("component").agg(F.min(place).alias("first"))
    rest = places.withColumn("place", place).join(firsts, "component").where("place <> first").select("doc_id", "text_hash", "pos")
    return rest.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("removed"))


def dedup_lines(documents: DataFrame, edits: int = MAX_EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(row, text, n_lines, n_removed)`` per document: ``row`` holds its columns, ``text`` what is left of its text."""
    removed = staged(removed_lines(documents, edits, least_chars), "removed-lines")
    rows = documents.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_hash"))
    same = rows["row.doc_id"].eqNullSafe(removed["doc_id"]) & (rows["text_hash"] == removed["text_hash"])
    # Whole texts are on the left: they are not sorted, but looked up in a hash table of the removed places.
    joined = rows.join(removed.hint("shuffle_hash"), same, "left")
    cut = joined.select("row", "removed", F.split("row.text", "\n").alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    left = F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    return cut.select(
        "row",
        F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(left).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
    )


def without_repeated_lines(documents: DataFrame, drop_emptied: bool = True) -> DataFrame:
    """The documents with what is left of their texts; those that lost all their words are left out if ``drop_emptied``."""
    found = dedup_lines(documents)
    if drop_emptied:
        found = found.where((F.col("n_removed") == 0) | (_trimmed(F.translate("text", "\n", "")) != ""))
    columns = [F.col("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in documents.columns]
    return found.select(*columns)
