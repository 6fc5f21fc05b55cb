"""Near-duplicate documents by bottom-k sketches.

Words are the runs of non-space characters, A-Z in lower case; a document is the set of its shingles of five words. One hash
function orders all shingles, and the sketch of a document is the ``SKETCH`` smallest hashes of its set. Inverted lists of
the retained values generate the pairs that overlap, the sketch of a pair's union estimates their similarity, and
the pairs that might be similar enough are compared on their full sets of words.

* Equal texts are one class, which the lists hold once. Components are over classes.
* A pair at the threshold shares three quarters of the union's sketch on average, and at least ``SHARED`` of it, 22 of 48,
  but with a probability of about one in a million. So a value needs to be listed for a document only if it is among the
  rarest of its sketch: if two documents share 22 values, they share one of the 27 rarest of either. This keeps the
  passages that many documents share out of the lists, whatever their number, and it caps nothing.
* Sets of at most 48 shingles are their own sketch, so nothing is estimated for them.
* The lists of large groups of copies are not paired up: see
  :func:`kindred.llm.graph.settled_lists` and :func:`cluster_links`.

Defined results: a text that is null or has no words has an empty set and is linked with nothing; one with fewer than five
words has its whole sequence as its only shingle; a component's id is its smallest id, null if all its ids are null.
Rows equal in id and text are kept or dropped together, and reduced to one by :func:`without_near_duplicates`. Shingles are
counted by 64-bit hashes, and compared as words when a link is confirmed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.graph import settled_lists
from kindred.llm.narrow import narrowed
from kindred.session import staged

WORDS, SKETCH, SHARED = 5, 48, 22
SIMILARITY = 75  # percent
PIECE_BYTES = 1 << 17
ROWS = 256  # texts whose sets are in memory at a time
BLOCK, COLUMNS = 256, 4096
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
FACTORS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for pieces of up to ``n`` bytes."""
    size = 2 << max(17, int(n).bit_length())
    if size not in _tables:
        _tables[size] = (_powers(BASE, size), _powers(pow(BASE, -1, 2**64), size))
    return _tables[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the texts ``data[offsets[i]:offsets[i + 1]]``: the hash of every word, and at which word each text begins.

    A word's hash is a polynomial in its bytes, taken from running sums over a piece of about 128 KB. Pieces are cut
    at white space, so memory does not grow with the length of a text.
    """
    hashes, starts_at = [], []
    p, end = int(offsets[0]), int(offsets[-1])
    while p < end:
        q, step = min(p + PIECE_BYTES, end), PIECE_BYTES
        while q < end and not (gaps := np.flatnonzero(SPACE[data[q : q + step]])).size:
            q = min(q + step, end)
        if q < end:
            q += int(gaps[0])
        piece = LOWER[data[p:q]]
        solid = ~SPACE[piece]
        cuts = offsets[np.searchsorted(offsets, p) : np.searchsorted(offsets, q)] - p
        before = np.concatenate([[False], solid[:-1]])
        before[cuts] = False
        first = np.flatnonzero(solid & ~before)
        after = np.concatenate([solid[1:], [False]])
        after[cuts[cuts > 0] - 1] = False
        last = np.flatnonzero(solid & ~after) + 1
        up, down = _tables_for(len(piece))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], dtype=np.uint64)])
        hashes.append(_mixed((sums[last] - sums[first]) * down[first]))
        starts_at.append(first + p)
        p = q
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_at), offsets)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its set of shingles."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    with np.errstate(over="ignore"):
        words, bounds = word_hashes(data, offsets)
        n = max(0, len(words) - WORDS + 1)
        sums = np.zeros(n, np.uint64)
        for i, factor in enumerate(FACTORS):
            sums += words[i : i + n] * factor
        shingles = _mixed(sums).view(np.int64)
        for start, end in zip(bounds[:-1], bounds[1:]):
            if end - start >= WORDS:
                yield np.unique(shingles[start : end - WORDS + 1])
            elif end > start:
                whole = (words[start:end] * FACTORS[: end - start]).sum(dtype=np.uint64, keepdims=True) + np.uint64(end - start)
                yield _mixed(whole).view(np.int64)
            else:
                yield np.zeros(0, np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, whole.num_rows, ROWS)):
        counts, sizes, values = [], [], []
        for found in shingle_sets(batch.column("text")):
            counts.append(len(found))
            values.append(found[:SKETCH].copy())  # a view would keep the whole set in memory
            sizes.append(len(values[-1]))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        sketches = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), sketches], ["doc_id", "key", "n_shingles", "sketch"]
        )


def text_key() -> Column:
    return F.unhex(F.md5("text"))


def sketches(documents: DataFrame) -> DataFrame:
    """``(doc_id, key, n_shingles, sketch)``: ``key`` is the class of the text, ``sketch`` its smallest hashes in order."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_sketch_batches, "doc_id long, key binary, n_shingles long, sketch array<long>")


def needed(size: Column) -> Column:
    return F.greatest(F.ceil(size * F.lit(SHARED) / F.lit(SKETCH)), F.lit(1)).cast("int")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """``(item, node, trait)``: of every sketch, the rarest values that a similar one must share at least one of. The trait is the
    number of shingles."""
    values = classes.select("key", F.explode("sketch").alias("item"))
    shared = values.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = values.join(shared, "item").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("common"))
    ranked = ranked.join(classes.select("key", "n_shingles", F.size("sketch").alias("size")), "key")
    # The values that no other sketch has are the rarest: they use up places of the prefix.
    kept = ranked.withColumn("places", F.size("common") - needed(F.col("size")) + 1).where("places > 0")
    entries = kept.select(F.explode(F.slice("common", 1, F.col("places"))).alias("c"), F.col("key").alias("node"), F.col("n_shingles").alias("trait"))
    return entries.select("c.item", "node", "trait")


def _words(text: bytes) -> list[bytes]:
    return WORD_BYTES.findall(bytes(text).translate(bytes(LOWER)))


def word_shingles(text: bytes) -> set:
    words = _words(text)
    return set(zip(*[words[i:] for i in range(WORDS)])) if len(words) >= WORDS else ({tuple(words)} if words else set())


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked, last, left = [], None, set()
        for a, b in zip(batch.column("text_a"), batch.column("text_b")):
            a, b = a.as_buffer().to_pybytes(), b.as_buffer().to_pybytes()
            if a != last:
                last, left = a, word_shingles(a)
            right = word_shingles(b)
            common = len(left & right)
            linked.append(100 * common >= SIMILARITY * (len(left) + len(right) - common))
        chosen = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])


def sizes_may_link(a: Column, b: Column) -> Column:
    """Sets of which one is too much larger than the other are not similar."""
    return (a * 100 >= b * SIMILARITY) & (b * 100 >= a * SIMILARITY)


def similar_pairs(pairs: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes that are similar: estimated from the sketch of the union, confirmed on the full sets."""
    ends = staged(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "pair-ends")
    compared = narrowed(classes.select("key", "sketch"), "key", ends)
    side = lambda name: compared.select(F.col("key").alias(name), F.col("sketch").alias(f"s_{name}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
    likely = staged(sized.where(both >= needed(F.size(union))).select("a", "b"), "likely-pairs")
    texts = class_texts(likely.select(F.explode(F.array("a", "b")).alias("key")), documents)
    return with_texts(likely, texts).mapInArrow(_confirm_batches, "a binary, b binary")


def class_texts(keys: DataFrame, documents: DataFrame) -> DataFrame:
    """``(key, text)`` of the classes in ``keys``."""
    keys = staged(keys.distinct(), "wanted-keys")
    texts = narrowed(documents.select(text_key().alias("key"), "text"), "key", keys).groupBy("key").agg(F.first("text").alias("text"))
    return staged(texts.join(keys, "key"), "class-texts")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with both texts."""
    text = lambda name: texts.select(F.col("key").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.join(text("a"), "a").join(text("b"), "b")


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each of the sets ``left`` has in common with each of the sets ``right``: a product of matrices of
    ``COLUMNS`` shingles at a time, of those that occur in two sets at least."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    again = times[column] > 1
    owner, column = owner[again], (np.cumsum(times > 1) - 1)[column[again]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [start, start + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[owner[part], column[part] - start] = 1
        common += held[left] @ held[right].T
    return common


def _cell_links(cell: pd.DataFrame) -> pd.DataFrame:
    """Links between the two blocks of a cell, or within its one block: a forest of them."""
    keys, block = cell["node"].tolist(), cell["block"].to_numpy()
    sets = list(shingle_sets(pa.array(cell["text"], pa.string())))
    left, right = np.flatnonzero(block == cell["lo"].iloc[0]), np.flatnonzero(block == cell["hi"].iloc[0])
    sizes = np.array([len(s) for s in sets], dtype=float)
    linked = common_counts(sets, left, right) * (100 + SIMILARITY) >= SIMILARITY * (sizes[left][:, None] + sizes[right][None, :])
    root = list(range(len(keys)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    for a, b in zip(*(x.tolist() for x in np.nonzero(linked))):
        a, b = find(int(left[a])), find(int(right[b]))
        if a != b:
            root[b] = a
            edges.append((keys[a], keys[b]))
    return pd.DataFrame(edges, columns=["a", "b"])


def cluster_links(clusters: DataFrame, documents: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect what is similar within each cluster, compared on full sets.

    A cluster of more than ``BLOCK`` texts is cut into blocks, and each pair of blocks is a task of its own, of bounded size. Only
    a forest of the links leaves it.
    """
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    members = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = members.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "block")
    texts = class_texts(clusters.select(F.col("node").alias("key")), documents).withColumnRenamed("key", "node")
    return cells.join(texts, "node").groupBy("cluster", "lo", "hi").applyInPandas(_cell_links, "a binary, b binary")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``(doc_id, key, n_shingles, class, component_id, kept)`` per document. Unlike the id, the class is a component's own."""
    rows = staged(sketches(documents), "sketches")
    classes = rows.where("n_shingles > 0").groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    classes = staged(classes, "classes")
    lists = staged(inverted_lists(classes), "inverted-lists")
    verify = lambda pairs: similar_pairs(pairs, classes, documents)
    found = settled_lists(lists, verify, sizes_may_link, lambda clusters: cluster_links(clusters, documents)).withColumnRenamed("node", "key")
    named = rows.drop("sketch").join(found, "key", "left").withColumn("class", F.coalesce("component", "key"))
    ids = named.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("first_id")).otherwise(F.col("doc_id"))
    joined = named.join(ids, "class", "left").withColumn("component_id", own)
    return joined.select("doc_id", "key", "n_shingles", "class", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each group, with all its columns; of documents without words, one per id and text.

    Groups are told apart by their class: several can have the same smallest id, or none. A class has its own keys, so the id and
    the key of the document that stays name it.
    """
    found = near_duplicates(documents).where("kept")
    groups = found.groupBy("class", F.when(F.col("n_shingles") == 0, F.col("doc_id")).alias("wordless"))
    chosen = groups.agg(F.first("component_id").alias("component_id"), F.min("key").alias("key")).select("component_id", "key")
    counted = found.groupBy("component_id", "key").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    same = lambda x, y: x["component_id"].eqNullSafe(y["component_id"]) & x["key"].eqNullSafe(y["key"])
    chosen = chosen.alias("x").join(counted.alias("y"), same(chosen, counted)).select("x.component_id", "x.key", "y.repeated")
    chosen = staged(chosen, "kept-documents")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("component_id"), text_key().alias("key"))
    kept = rows.join(chosen, same(rows, chosen)).select("row", rows["component_id"], rows["key"], "repeated")
    if chosen.where("repeated").isEmpty():
        return kept.select("row.*")
    once = kept.where("repeated").dropDuplicates(["component_id", "key"])
    return kept.where("not repeated").select("row.*").unionAll(once.select("row.*"))
