"""Merkle manifest of a dataset, as a tree of resumable hash states.

Every document is a leaf: the hash of its columns. Per source, leaves ascend by id. Runs of 16 consecutive nodes have a parent, the hash of their
digests as text, until one node is left, the source's subroot; a last run may be shorter, and a single leaf is its own subroot. The
subroots, by source, are the leaves of one more tree, and its top is the root of the dataset.

A parent retains a copy of its hash state before each child slot. To fold a changed child into it, the state before that slot is resumed with the
replacement and the siblings on the right; those on the left are not read again.

On Spark, a tree is built in rounds of ``LEVELS`` levels: 4,096 consecutive nodes make a cell, and only the top of a cell goes on to the next
round. Up to five cells, of one tree or of several small ones, make a group of a shuffle and are hashed at once. So a source with a
third of all documents is many cells, and no group grows with the data. Positions come from a range sort, which is written as a table: counts per range and source give where each range begins. Folding goes the other way, cell by cell:
the tops' ways to the root, which are short, are found first.

Defined results: a null id sorts first and is never tampered with; a null source is a source of its own, the first one; null columns are hashed as ``-``, an
empty text as ``0:``. Rows equal in id and content are leaves next to each other; which of two such rows has which place is left open, and rows with
one id are ordered by their hash. An empty table gives an empty table. Columns other than the five are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm import sha256
from kindred.params import BROADCAST_ROWS
from kindred.session import staged

FANOUT = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EACH = 5
GROUP = 16_384

STEP = "struct<slot:int,state:binary,siblings:string>"
PARENT = "group long, tree long, cell long, level int, place int, children binary, states binary, digest binary"
PATH = f"tree long, base long, pos long, path array<{STEP}>, top binary"
FOLDED = "doc_id {}, leaf binary, subroot binary, proof string, folded binary"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The hash of a document's columns; ``text`` stands in for its own text."""
    values = {name: F.col(name) for name in FIELDS} | ({"text": text} if text is not None else {})
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values.values()]), 256))


def tampered_text() -> Column:
    """What the verification is tried on: every fifth document, by checksum of its id, comes with its letters A-Z in lower case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EACH == 0, lower).otherwise(F.col("text"))


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``tree``, the number of their group, their ``pos`` within it, its size ``n`` and the number ``base`` of rows before it; and
    ``(group, tree)``.

    Groups are numbered in their order. The rows are sorted by ranges and written with their number within the range. What is known of a range
    and a group, and of a group, is counted; nothing but these counts is ever summed over many ranges.
    """
    sort = [group, *order, "__deal"]
    dealt = rows.withColumn("__deal", F.rand(11))  # equal rows may be in different ranges
    ranged = dealt.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__id", F.monotonically_increasing_id())
    ranged = ranged.withColumns({"__range": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND((1 << 33) - 1)})
    sorted_rows = staged(ranged.drop("__deal", "__id"), "merkle-sorted")
    known = F.col(group).isNotNull().cast("int").alias("__known"), F.coalesce(group, F.lit("")).alias("__group")
    rows = sorted_rows.select("*", *known)
    cells = rows.groupBy("__known", "__group", "__range").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    cells = staged(cells, "merkle-ranges")
    groups = cells.groupBy("__known", "__group").agg(F.sum("__n").alias("n"), F.min(F.struct("__range", "__first")).alias("__start"))
    # Groups are in the order of the ranges: number them by where they start, with one count per range.
    starts = groups.groupBy("__start.__range").agg(F.count(F.lit(1)).alias("__many")).withColumnRenamed("__range", "__at")
    starts = starts.withColumn("__before", F.sum("__many").over(_running("__at")) - F.col("__many")).drop("__many")
    numbered = groups.withColumn("__at", F.col("__start.__range")).join(starts, "__at")
    within = _running("__start.__first", "__at")
    numbered = numbered.withColumn("tree", F.col("__before") + F.count(F.lit(1)).over(within) - 1)
    totals = cells.groupBy("__range").agg(F.sum("__n").alias("__all"))
    totals = totals.select(F.col("__range").alias("__at"), (F.sum("__all").over(_running("__range")) - F.col("__all")).alias("__rows"))
    numbered = numbered.join(totals, "__at").withColumn("base", F.col("__rows") + F.col("__start.__first"))
    trees = staged(numbered.select("__known", "__group", "tree", "n", "base"), "merkle-trees")
    cells = cells.withColumn("__before", F.sum("__n").over(_running("__range", "__known", "__group")) - F.col("__n"))
    cells = cells.join(trees, ["__known", "__group"]).select("__known", "__group", "__range", "__first", "__before", "tree", "n", "base")
    keys = ["__known", "__group", "__range"]
    small = cells.count() <= BROADCAST_ROWS
    found = rows.join(F.broadcast(cells) if small else cells.hint("shuffle_hash"), keys)
    pos = F.col("__before") + F.col("__row") - F.col("__first")
    named = trees.select(F.when(F.col("__known") == 1, F.col("__group")).alias(group), "tree")
    return found.withColumn("pos", pos).drop(*keys, "__first", "__before", "__row"), named


def _running(order: str, *groups: str):
    from pyspark.sql import Window

    return Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _joined(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, 32)


def runs_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For nodes in rows of these sizes: the first child and the number of children of each parent, and where the parents of each row begin."""
    many = -(-sizes // FANOUT)
    begins = np.cumsum(many) - many
    place = np.arange(many.sum()) - np.repeat(begins, many)
    first = np.repeat(np.cumsum(sizes) - sizes, many) + place * FANOUT
    return first, np.minimum(np.repeat(sizes, many) - place * FANOUT, FANOUT), begins


def parents_of(digests: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(states, digests)`` of parents, given their first child and number of children; ``states`` is ``(parents, FANOUT, 32)``, before each child."""
    blocks = sha256.as_blocks(sha256.hex_text(digests))
    now, states = sha256.start(len(first)), np.zeros((len(first), FANOUT, 32), dtype=np.uint8)
    for slot in range(counts.max(initial=0)):
        has = np.flatnonzero(counts > slot)
        states[has, slot] = sha256.as_bytes(now[:, has])
        now[:, has] = sha256.resume(now[:, has], blocks[:, first[has] + slot])
    return states, sha256.as_bytes(sha256.resume(now, sha256.last_block(counts)))


def fold(states: np.ndarray, replacements: np.ndarray, siblings: np.ndarray, after: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The parents' digests with one child replaced each, from the states ``(n, 32)`` before that child.

    ``right`` tells how many siblings follow, which are those from ``siblings[after]`` on. ``right[1]`` is the number of all children.
    """
    many, sizes = right
    now = sha256.resume(sha256.as_states(states), sha256.as_blocks(sha256.hex_text(replacements)))
    blocks = sha256.as_blocks(sha256.hex_text(siblings))
    for step in range(int(many.max(initial=0))):
        has = np.flatnonzero(many > step)
        now[:, has] = sha256.resume(now[:, has], blocks[:, after[has] + step])
    return sha256.as_bytes(sha256.resume(now, sha256.last_block(sizes)))


def fold_distinct(places: np.ndarray, values: np.ndarray, folder) -> np.ndarray:
    """``folder(places, values)``, once for equal pairs of a place and a value."""
    keyed = np.concatenate([places.astype(np.int64)[:, None].view(np.uint8), values], axis=1)
    _, first, which = np.unique(np.ascontiguousarray(keyed).view(np.void(b"\0" * 40).dtype).ravel(), return_index=True, return_inverse=True)
    return folder(places[first], values[first])[which]


def _cells_of(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The first row and the size of each cell, and the cell of each row; the rows are sorted."""
    new = ((rows["tree"] != rows["tree"].shift()) | (rows["cell"] != rows["cell"].shift())).to_numpy()
    which = np.cumsum(new) - 1
    return rows[new], np.bincount(which), which


def _raise(rows: pd.DataFrame) -> pd.DataFrame:
    """The parents of some cells: ``LEVELS`` levels of them, or fewer if a cell is a whole tree."""
    rows = rows.sort_values(["tree", "pos"])
    cells, sizes, _ = _cells_of(rows)
    nodes, whole, names = _joined(rows["digest"]), (cells["n"] <= FANOUT**LEVELS).to_numpy(), np.arange(len(cells))
    out, level = [], 0
    while level < LEVELS:
        on = ~whole[names] | (sizes > 1)
        nodes, sizes, names = nodes[np.repeat(on, sizes)], sizes[on], names[on]
        if not len(sizes):
            break
        first, counts, begins = runs_of(sizes)
        states, digests = parents_of(nodes, first, counts)
        owner = np.repeat(names, np.diff(np.append(begins, len(first))))
        place = np.arange(len(first)) - np.repeat(begins, np.diff(np.append(begins, len(first))))
        for name, at, i, n in zip(owner.tolist(), place.tolist(), first.tolist(), counts.tolist()):
            out.append((name, level, at, nodes[i : i + n].tobytes()))
        made = [s[:n].tobytes() for s, n in zip(states, counts.tolist())]
        out[len(out) - len(first) :] = [(*o, s, d.tobytes()) for o, s, d in zip(out[len(out) - len(first) :], made, digests)]
        nodes, sizes, level = digests, -(-sizes // FANOUT), level + 1
    found = pd.DataFrame(out, columns=["owner", "level", "place", "children", "states", "digest"])
    owner = found.pop("owner").to_numpy(dtype=np.int64)
    for i, name in enumerate(("group", "tree", "cell")):
        found.insert(i, name, cells[name].to_numpy()[owner])
    return found


class _Level:
    """The parents on one level of some cells; ``begins`` has the place of a cell's first parent, -1 for a cell without this level."""

    def __init__(self, parents: pd.DataFrame, cells: pd.DataFrame):
        parents = parents.sort_values(["tree", "cell", "place"])
        self.counts = parents["children"].map(len).to_numpy() // 32
        self.first = np.cumsum(self.counts) - self.counts
        self.children = _joined(parents["children"])
        self.states = _joined(parents["states"])  # as many as children
        self.text = sha256.hex_text(self.children).tobytes().decode()
        at = parents.reset_index(drop=True).reset_index().query("place == 0").rename(columns={"index": "begin"})
        self.begins = cells[["tree", "cell"]].merge(at[["tree", "cell", "begin"]], "left")["begin"].fillna(-1).to_numpy(dtype=np.int64)

    def has(self, cell: np.ndarray) -> np.ndarray:
        return self.begins[cell] >= 0

    def child(self, cell: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parent of the node at ``place`` of its cell, and the node's place among all children."""
        parent = self.begins[cell] + place // FANOUT
        return parent, self.first[parent] + place % FANOUT

    def fold(self, child: np.ndarray, values: np.ndarray) -> np.ndarray:
        parent = np.searchsorted(self.first, child, "right") - 1
        counts = self.counts[parent]
        return fold(self.states[child], values, self.children, child + 1, np.stack([counts - 1 - (child - self.first[parent]), counts]))

    def siblings(self, parent: int, child: int) -> str:
        start, end = self.first[parent] * 64, (self.first[parent] + self.counts[parent]) * 64
        return self.text[start : child * 64] + self.text[child * 64 + 64 : end]


def _ready(nodes: pd.DataFrame, parents: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray, list[_Level], pd.DataFrame]:
    """The sorted nodes of a group, their cells, the cell of each node, the levels, and by cell the way of its top to the root."""
    nodes = nodes.sort_values(["tree", "pos"], ignore_index=True)
    cells, _, which = _cells_of(nodes)
    levels = [_Level(rows, cells) for level, rows in parents.groupby("level") if level >= 0]
    tops = cells[["tree", "cell"]].merge(parents.loc[parents["level"] < 0, ["tree", "cell", "path", "top"]], "left")
    tops["path"] = [list(p) if p is not None and not isinstance(p, float) else [] for p in tops["path"]]
    return nodes, cells, which, levels, tops


def _paths(nodes: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    """Each node's way to the root: slots, states and siblings."""
    nodes, cells, which, levels, tops = _ready(nodes, parents)
    out = []
    for tree, base, pos, cell in zip(nodes["tree"], nodes["base"], nodes["pos"], which):
        place, path = pos % FANOUT**LEVELS, []
        for level in levels:
            if level.has(cell):
                parent, child = level.child(cell, place)
                path.append({"slot": place % FANOUT, "state": level.states[child].tobytes(), "siblings": level.siblings(parent, child)})
                place //= FANOUT
        above = [{name: step[name] for name in ("slot", "state", "siblings")} for step in tops["path"][cell]]
        out.append((tree, base, pos, path + above, tops["top"][cell]))
    return pd.DataFrame(out, columns=["tree", "base", "pos", "path", "top"])


def _fold_all(nodes: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    """Fold each leaf of some cells to the root of the dataset, and hash the siblings on its way."""
    nodes, cells, which, levels, tops = _ready(nodes, parents)
    places = nodes["pos"].to_numpy() % FANOUT**LEVELS
    values, at = _joined(nodes["candidate"]).copy(), places.copy()
    for level in levels:
        has = np.flatnonzero(level.has(which))
        values[has] = fold_distinct(level.child(which[has], at[has])[1], values[has], level.fold)
        at[has] //= FANOUT
    paths = tops["path"]
    for depth in range(max(map(len, paths), default=0)):
        steps = {cell: path[depth] for cell, path in enumerate(paths) if len(path) > depth}
        slots, states, many = (np.zeros(len(cells), dtype=np.int64) for _ in range(3))
        states = np.zeros((len(cells), 32), dtype=np.uint8)
        for cell, step in steps.items():
            slots[cell], many[cell] = step["slot"], len(step["siblings"]) // 64
            states[cell] = np.frombuffer(step["state"], dtype=np.uint8)
        begins = np.cumsum(many) - many
        siblings = np.frombuffer(bytes.fromhex("".join(s["siblings"] for s in steps.values())), dtype=np.uint8).reshape(-1, 32)
        resumed = lambda c, v: fold(states[c], v, siblings, begins[c] + slots[c], np.stack([many[c] - slots[c], many[c] + 1]))  # noqa: B023, E731
        has = np.flatnonzero(np.isin(which, list(steps)))
        values[has] = fold_distinct(which[has], values[has], resumed)
    later = ["".join(step["siblings"] for step in path) for path in paths]
    rest: dict[tuple[int, int], str] = {}
    proofs = []
    for cell, place in zip(which.tolist(), places.tolist()):
        own = [level for level in levels if level.has(cell)]
        key = cell, place // FANOUT
        if key not in rest:  # the same for all children of a parent
            rest[key] = "".join(level.siblings(*level.child(cell, place // FANOUT ** (i + 1))) for i, level in enumerate(own[1:])) + later[cell]
        first = own[0].siblings(*own[0].child(cell, place)) if own else ""
        proofs.append(hashlib.sha256((first + rest[key]).encode()).hexdigest())
    return pd.DataFrame(
        {"doc_id": nodes["doc_id"], "leaf": nodes["digest"], "subroot": tops["top"].to_numpy()[which], "proof": proofs, "folded": [v.tobytes() for v in values]}
    )


def _grouped(rows: DataFrame, round_: int) -> DataFrame:
    """Add ``group`` to rows with a ``cell``: cells that are near each other share one, so that it has a bounded number of nodes."""
    size = FANOUT**LEVELS
    first = F.floor(F.col("base") / F.lit(size**round_)) + F.col("cell") * size
    return rows.withColumn("group", F.floor(first / F.lit(GROUP)).cast("long"))


def _cells(nodes: DataFrame, round_: int) -> DataFrame:
    return _grouped(nodes.withColumn("cell", F.floor(F.col("pos") / F.lit(FANOUT**LEVELS)).cast("long")), round_)


@dataclass
class Tree:
    """Trees over ``nodes``, round by round: the nodes of each round, the parents made of them, and the tops ``(tree, digest)``."""

    nodes: list[DataFrame]
    parents: list[DataFrame]
    tops: DataFrame

    def cell_paths(self, above: DataFrame) -> DataFrame:
        """``(group, tree, base, cell, path, top)`` for the cells of the first round, given the ways ``(tree, path, top)`` of the tops."""
        found = None
        for round_, (nodes, parents) in reversed(list(enumerate(zip(self.nodes, self.parents)))):
            ends = nodes.where((F.col("pos") == 0) & (F.col("n") <= FANOUT**LEVELS)).select("tree", "base", F.lit(0).cast("long").alias("cell"))
            here = ends.join(above, "tree")
            if found is not None:
                here = here.unionByName(found.withColumnRenamed("pos", "cell"))
            here = _grouped(here, round_)
            if round_ == 0:
                return here
            found = staged(with_parents(nodes, parents, here).applyInPandas(_paths, PATH), "merkle-paths")
        raise AssertionError("a tree has a round")


def with_parents(nodes: DataFrame, parents: DataFrame, paths: DataFrame):
    """The nodes of each group with the parents of its cells and, as rows of level -1, the ways of their tops."""
    rows = parents.drop("digest").unionByName(paths.drop("base").withColumn("level", F.lit(-1)), allowMissingColumns=True)
    return nodes.drop("n").groupBy("group").cogroup(rows.groupBy("group"))


def build(nodes: DataFrame) -> Tree:
    """From ``(tree, pos, n, base, digest)``: ``n`` is the number of nodes of the tree, and ``base`` that of the nodes of the trees before it."""
    every, made, tops = [], [], None
    size = FANOUT**LEVELS
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        nodes = _cells(nodes, len(every))
        groups = nodes.select("group", "tree", "cell", "pos", "n", "digest").groupBy("group")
        parents = staged(groups.applyInPandas(_raise, PARENT), "merkle-parents")
        every.append(nodes)
        made.append(parents)
        highest = parents.groupBy("tree", "cell").agg(F.max(F.struct("level", "digest")).alias("last"))
        ends = nodes.where(F.col("pos") % size == 0).select("tree", "cell", "n", "base", "digest").join(highest, ["tree", "cell"], "left")
        ends = staged(ends.select("tree", "cell", "n", "base", F.coalesce("last.digest", "digest").alias("digest")), "merkle-tops")
        done = ends.where(F.col("n") <= size).select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        if largest <= size:
            return Tree(every, made, tops)
        rest = ends.where(F.col("n") > size)
        nodes = rest.select("tree", F.col("cell").alias("pos"), F.ceil(F.col("n") / F.lit(size)).cast("long").alias("n"), "base", "digest")
        largest = -(-largest // size)


def manifest(documents: DataFrame, candidate_text: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every document.

    ``candidate_text`` is the text that is to be verified against the manifest, the document's own if none is given: its leaf is folded into
    the states along its way, and ``verified`` tells if that gives the root.
    """
    rows = documents.select(*FIELDS).select("doc_id", "source", leaf().alias("digest"), leaf(candidate_text).alias("candidate"))
    leaves, sources = placed(rows, "source", ["doc_id", "digest"])
    by_source = build(leaves.drop("source"))
    zero = F.lit(0).cast("long")
    subroots = by_source.tops.select(zero.alias("tree"), F.col("tree").alias("pos"), F.lit(sources.count()).cast("long").alias("n"), zero.alias("base"), "digest")
    whole = build(staged(subroots, "merkle-subroots"))
    nothing = whole.tops.select("tree", F.lit(None).cast(f"array<{STEP}>").alias("path"), F.lit(None).cast("binary").alias("top"))
    ways = with_parents(whole.nodes[0], whole.parents[0], whole.cell_paths(nothing)).applyInPandas(_paths, PATH)
    ways = ways.select(F.col("pos").alias("tree"), "path").join(by_source.tops.withColumnRenamed("digest", "top"), "tree")
    paths = by_source.cell_paths(staged(ways, "merkle-ways"))
    kind = dict(documents.dtypes)["doc_id"]
    folded = with_parents(by_source.nodes[0], by_source.parents[0], paths).applyInPandas(_fold_all, FOLDED.format(kind))
    as_text = lambda c: F.lower(F.hex(c))
    root = whole.tops.select(as_text("digest")).scalar()
    return folded.select(
        "doc_id", as_text("leaf").alias("leaf"), as_text("subroot").alias("subroot"), root.alias("root"),
        F.col("proof").alias("proof_sha256"), as_text("folded").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
