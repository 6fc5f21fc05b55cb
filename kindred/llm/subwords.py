"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The texts of an Arrow batch are cut into words at places that no piece of the vocabulary crosses: before a run of spaces, and around
characters that are in no longer piece. The words that have not been seen yet lie in one flat array of symbols. In each round, the smallest
rank among the adjacent pairs of every word is found (a segmented minimum), the pairs of that rank are merged at the same time, from the
left and without overlap, and the array is compacted; words without a pair that is a piece leave it. When none is left, all are encoded.

Merging one after the other could differ from that in one case: if a merged symbol and its neighbour make a pair of the same or a smaller
rank, that pair comes before the next one of the round. Where this can happen, only the leftmost pair of the word is merged in the round.
So the ids are those of the library for every text. Words of more than ``LONG`` characters are merged with a heap of pairs instead:
their rounds would be as many as their merges. The ids are the same.

Decoding gathers the bytes of all ids of a batch at once.

No rows are shuffled. A task holds the vocabulary and the ids of the words of about ``LEXICON`` characters, so that frequent words are encoded
once; a batch is worked on in slices of ``SLICE_CHARS`` characters. A longer text is cut at spaces. Only one word can take more memory, about 100 bytes
for each of its characters.

Defined results: a null text is encoded like an empty one, as no ids, and decoded to an empty text. Rows are treated one by one, so ties, repeated
rows and an empty table need no rule. Other columns are carried along in ``row``, whatever their names.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LONG = 512
LEXICON = 4_000_000
SLICE_CHARS = 4_000_000
NEVER = np.iinfo(np.int32).max
CHARACTERS = 0x110000
UNKNOWN = -1

# As the library does it, every byte that is not part of a character becomes a character of its own.
codecs.register_error("replace_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every run, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Pairs:
    """From two symbols to the symbol that they merge into and its rank, for arrays of pairs; a hash table with open addresses."""

    def __init__(self, merges: dict[tuple[int, int], int], rank: np.ndarray):
        bits = max(4, (4 * len(merges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.merged = np.full(1 << bits, -1, dtype=np.int32)
        self.rank = np.append(rank, NEVER).astype(np.int32)  # -1 is no symbol
        left, right = (np.array([p[i] for p in merges], dtype=np.int64) for i in (0, 1))
        keys, merged = (left << 32) | right, np.array(list(merges.values()), dtype=np.int32)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] == -1
            _, first = np.unique(place, return_index=True)
            put = np.zeros(len(keys), dtype=bool)
            put[first] = True
            put &= free
            self.keys[place[put]], self.merged[place[put]] = keys[put], merged[put]
            keys, merged, place = keys[~put], merged[~put], (place[~put] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(merged, rank)``; -1 and ``NEVER`` where the two do not merge. A symbol -1 merges with nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        merged = np.full(len(keys), -1, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        place = self._place(keys[at])
        while len(at):
            found = self.keys[place]
            hit = found == keys[at]
            merged[at[hit]] = self.merged[place[hit]]
            on = ~hit & (found != -1)
            at, place = at[on], (place[on] + 1) & self.mask
        return merged, self.rank[merged]


class Vocabulary:
    """A SentencePiece BPE model with byte fallback, a dummy prefix, and no other normalization than spaces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): i for i in plain}
        if model.normalize("a  Å b") != f"{SPACE}a{SPACE}{SPACE}Å{SPACE}b":
            raise ValueError("the model changes texts in other ways than by spaces and a prefix")
        self.byte_id = np.zeros(256, dtype=np.int32)
        spelled = [b""] * len(ids)
        for i in ids:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_id[value], spelled[i] = i, bytes([value])
        for piece, i in pieces.items():
            spelled[i] = piece.replace(SPACE, " ").encode()
        self.spelled = pa.array(spelled, pa.large_binary())
        self.is_byte = np.array([model.is_byte(i) for i in ids])

        # Characters of longer pieces that are no pieces themselves are symbols after the last id, which never come out.
        alphabet = sorted({c for p in pieces for c in p} - pieces.keys())
        symbols = pieces | {c: len(ids) + n for n, c in enumerate(alphabet)}
        self.symbol = np.full(CHARACTERS, UNKNOWN, dtype=np.int32)
        for c, s in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = s
        self.n_ids = len(ids)
        scores = np.array([model.get_score(i) for i in plain])
        rank = np.full(len(ids) + len(alphabet), NEVER, dtype=np.int32)
        rank[plain] = np.unique(-scores, return_inverse=True)[1]  # equal scores have equal ranks
        self.merges = {
            (symbols[p[:n]], symbols[p[n:]]): i for p, i in pieces.items() for n in range(1, len(p)) if p[:n] in symbols and p[n:] in symbols
        }
        self.rank, self.pairs = rank, Pairs(self.merges, rank)

        self.symbol[ord(" ")] = self.symbol[ord(SPACE)]
        # Bytes of characters that no longer piece holds: a word by themselves.
        longer = {c for p in pieces if len(p) > 1 for c in p}
        self.alone = np.array([b < 128 and chr(b) not in longer and chr(b) != " " for b in range(256)])
        self.whole = any(SPACE in p.lstrip(SPACE) for p in pieces)  # then words cannot be cut off at spaces
        self.cut = re.compile("(?<=[^ ▁])[ ▁]")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.n, self.characters = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), 0

    def parts(self, text: str) -> Iterator[str]:
        """The text with its prefix, in parts that no word crosses."""
        start, prefix = 0, " "
        while start < len(text):
            end = len(text)
            if end - start > SLICE_CHARS and not self.whole:
                cut = self.cut.search(text, start + SLICE_CHARS)
                end = cut.start() if cut else end
            yield prefix + text[start:end].replace(SPACE, " ")
            start, prefix = end, ""

    def words_of(self, parts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All words of the parts, and the number of words of each part."""
        texts = pa.array(parts, pa.large_string())
        size = int(np.frombuffer(texts.buffers()[1], dtype=np.int64)[len(parts)])
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(parts) + 1]
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[:size]
        starts = np.zeros(size + 1, dtype=bool)
        if not self.whole:
            space, alone = data == 32, self.alone[data]
            starts[:-1] = (space & ~np.append(False, space[:-1])) | alone
            starts[1:] |= alone
        starts[ends] = True
        at = np.flatnonzero(starts)
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), texts.buffers()[2])
        return words, np.diff(np.searchsorted(at, ends))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        out = [np.zeros(0, dtype=np.int32)]
        counts = np.zeros(len(texts), dtype=np.int64)
        parts: list[str] = []
        owners: list[int] = []
        waiting = 0

        def drain() -> None:
            nonlocal parts, owners, waiting
            words, n_words = self.words_of(parts)
            coded = words.dictionary_encode()
            numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            n = self.n[numbers]
            out.append(self.ids[runs((np.cumsum(self.n) - self.n)[numbers], n)])
            before = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(n_words))]
            np.add.at(counts, owners, np.diff(before))
            parts, owners, waiting = [], [], 0

        for i, text in enumerate(texts):
            for part in self.parts(text or ""):
                parts.append(part)
                owners.append(i)
                waiting += len(part)
                if waiting >= SLICE_CHARS:
                    drain()
        if parts:
            drain()
        return np.concatenate(out), counts

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The place of each of the different words in the lexicon; those that are not in it are encoded first."""
        if self.characters > LEXICON:
            self.forget()
        new = [w for w in words if w not in self.number]
        if new:
            ids, n = self.encode_words(new)
            self.number.update(zip(new, range(len(self.n), len(self.n) + len(new))))
            self.n, self.ids = np.append(self.n, n), np.append(self.ids, ids)
            self.characters += sum(map(len, new))
        return np.array([self.number[w] for w in words], dtype=np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one word after the other, and the number of ids of each word."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        symbols, word = self.symbol[points], np.repeat(np.arange(len(words)), lengths)
        # What is not in the vocabulary at all carries its character below -1.
        symbols = np.where(symbols == UNKNOWN, -2 - points, symbols)
        long = lengths[word] > LONG
        done = [self.merge_rounds(symbols[~long], word[~long])]
        for i in np.flatnonzero(lengths > LONG):
            merged = self.merge_by_heap(symbols[word == i] if len(words) > 1 else symbols)
            done.append((merged, np.full(len(merged), i)))
        symbols, word = (np.concatenate([d[j] for d in done]) for j in (0, 1))
        order = np.argsort(word, kind="stable")
        return self._as_ids(symbols[order], word[order], len(words))

    def _as_ids(self, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Spell symbols that are no pieces in bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.n_ids))
        spelled = {}
        if len(odd):
            of_symbol = {int(self.symbol[c]): c for c in np.flatnonzero(self.symbol >= self.n_ids)}
            for s in np.unique(symbols[odd]).tolist():
                spelled[s] = self.byte_id[np.frombuffer(chr(-2 - s if s < 0 else of_symbol[s]).encode(), dtype=np.uint8)]
        size = np.ones(len(symbols), dtype=np.int64)
        size[odd] = [len(spelled[s]) for s in symbols[odd].tolist()]
        ids = np.repeat(symbols, size)
        if len(odd):
            first = (np.cumsum(size) - size)[odd]
            ids[runs(first, size[odd])] = np.concatenate([spelled[s] for s in symbols[odd].tolist()])
        return ids.astype(np.int32), np.bincount(word, weights=size, minlength=n_words).astype(np.int64)

    def merge_rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(symbols, word)`` after all merges; ``word`` does not decrease, and merges stay within a word."""
        known = np.maximum(symbols, -1)
        follow = np.append(np.where(word[1:] == word[:-1], known[1:], -1), -1) if len(word) else known
        merged, rank = self.pairs(known, follow)
        done = []
        while len(symbols):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            open_ = least < NEVER
            if not open_.all():
                done.append((symbols[~open_], word[~open_]))
                symbols, word, merged, rank, least = (a[open_] for a in (symbols, word, merged, rank, least))
                continue
            # The pairs of least rank, every second one where they overlap.
            at = np.flatnonzero(rank == least)
            begins = np.append(True, np.diff(at) > 1)
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))) % 2 == 0]
            made = merged[at]
            padded, place = np.append(np.maximum(symbols, -1), [-1, -1]), np.append(word, [-1, -1])
            touch = np.append(False, np.diff(at) == 2)  # the symbol before is made in this round too
            touch &= word[at] == word[at - 2]
            before = np.where(touch, np.append(-1, made[:-1]), np.where(place[at - 1] == word[at], padded[at - 1], -1))
            after = np.where(place[at + 2] == word[at], padded[at + 2], -1)
            left, left_rank = self.pairs(before, made)
            right, right_rank = self.pairs(made, after)
            early = np.minimum(left_rank, right_rank) <= least[at]
            if early.any():
                # A new pair could come before the next one: only the leftmost one of such a word is merged.
                again = np.isin(word[at], word[at[early]])
                alone = ~again | np.append(True, word[at][1:] != word[at][:-1])
                at, made, touch, left, left_rank, right, right_rank = (a[alone] for a in (at, made, touch, left, left_rank, right, right_rank))
            joined = np.append(touch[1:], False)  # the symbol after is made in this round too
            symbols[at] = made
            merged[at] = np.where(joined, np.append(left[1:], -1), right)
            rank[at] = np.where(joined, np.append(left_rank[1:], NEVER), right_rank)
            lone = ~touch & (place[at - 1] == word[at])
            merged[at[lone] - 1], rank[at[lone] - 1] = left[lone], left_rank[lone]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, word, merged, rank = (a[keep] for a in (symbols, word, merged, rank))
        if not done:
            return symbols, word
        symbols, word = (np.concatenate([d[j] for d in done]) for j in (0, 1))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def merge_by_heap(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges within one word, the least rank first and the leftmost of equal ones, with a heap of pairs."""
        n = len(symbols)
        merged, rank = self.pairs(np.maximum(symbols[:-1], -1), np.maximum(symbols[1:], -1))
        at = np.flatnonzero(merged >= 0)
        heap = ((rank[at].astype(np.int64) << 40) | at).tolist()
        heapq.heapify(heap)
        made: dict[int, tuple[int, int]] = {}  # the symbols that a pair was found for, if it was found after the start
        sym, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << 40) - 1
        while heap:
            top = heapq.heappop(heap)
            i = top & mask
            j = after[i]
            if sym[i] is None or j >= n:
                continue
            into = self.merges.get((sym[i], sym[j]))
            if into is None or self.rank[into] != top >> 40:
                continue  # one of the two has been merged since
            sym[i], sym[j], after[i] = into, None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    pair = self.merges.get((sym[a], sym[b]))
                    if pair is not None:
                        heapq.heappush(heap, (int(self.rank[pair]) << 40) | a)
        return np.array([s for s in sym if s is not None], dtype=np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; the space before the first piece is not part of it."""
        spelled = self.spelled.take(pa.array(ids))
        ends = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[np.cumsum(counts)]
        data = memoryview(spelled.buffers()[2])
        texts, start, first = [], 0, 0
        for end, n in zip(ends, counts):
            prefixed = n and not self.is_byte[ids[first]] and data[start : start + 1] == b" "
            texts.append(str(data[start + bool(prefixed) : end], "utf-8", "replace_each_byte"))
            start, first = end, first + n
        return texts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _slices(batch: pa.RecordBatch, size: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, so that memory does not follow the number of rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    slices = np.cumsum(sizes) // size
    cuts = np.flatnonzero(np.append(True, np.diff(slices) > 0)) if len(slices) else []
    for start, end in zip(cuts, [*cuts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def _encoder(path: str | None, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path or default_model())
        for whole in batches:
            for batch in _slices(whole):
                ids, counts = known.encode(batch.column("text").to_pylist())
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                columns = [batch.column("row"), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(pa.array(known.decode(ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"][: len(columns)])

    return run


def _decoder(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path or default_model())
        for batch in batches:
            lists = batch.column("ids")
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], dtype=np.int64)
            texts = known.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return run


def encode(documents: DataFrame, model: str | None = None, decoded: bool = False) -> DataFrame:
    """``(row, ids)`` for every document, ``row`` holding all its columns; with ``decoded``, also the text that the ids decode to.

    ``model`` is the path of a model file that all executors can read; without it, the public one of 32,000 pieces is taken.
    """
    rows = documents.select(F.struct("*").alias("row"), "text")
    schema = f"row {documents.schema.simpleString()}, ids array<int>" + (", decoded string" if decoded else "")
    return rows.mapInArrow(_encoder(model, decoded), schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``(row, text)`` from ``(row, ids)``; null ids are decoded to an empty text."""
    row = encoded.schema["row"].dataType.simpleString()
    return encoded.select("row", "ids").mapInArrow(_decoder(model), f"row {row}, text string")
