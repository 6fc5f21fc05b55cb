"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into the text blocks between block-level tags. A block is described by its number of words and the share of them
within links, by the same two numbers of its neighbours, and by where it stands: in a heading, in an element that is
there for something else than the article (menu, header, footer, sidebar, notice, advert, form, comment; known by its tag, or by the
words of its class, id and role, which say less of a wrapper that holds most of the page, and nothing of article and main elements), or within or outside the article of a page that marks one. A decision tree, trained on ``EXAMPLES``,
tells blocks of the main text from others; these are joined in page order.

The tree is small and is sent along with the tasks; a page is parsed once and never leaves its task.

Defined results: a null or empty page, and one without main text, gives an empty text. Scripts, styles, comments and other raw
content are dropped, also if they never end. Embedded content and controls (svg, video, button and the like) are dropped with all they hold; one whose
end tag is missing holds nothing. Character references are decoded once, after the tags are gone. All white
space in a block, no-break spaces included, turns into single spaces. Repeated pages are extracted each; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of HTML.
RAW = frozenset("script style title textarea".split())
DROPPED = frozenset("noscript template svg math iframe object select button audio video canvas".split())
BOXES = frozenset("button select textarea iframe title".split())
FOREIGN = frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
ASIDE = frozenset("nav header footer aside form menu dialog fieldset head label".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice"
    " notification popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead topbar footer"
    " bottom share sharing social related recommended teaser newsletter subscribe subscription signup login search form toolbar widget"
    " tags legal copyright complementary contentinfo alert disclaimer paywall".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond discussion disqus reviews".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']+|\"[^\"<]*\"|'[^'<]*')*+)/?>"
    rf"|<(/?)({'|'.join(sorted(RAW | DROPPED))})(?=[\s/>])([^>]*)>|</?[a-zA-Z][^>]*>|<[!?][^>]*>",
    re.S | re.I,
)
# Where the text of a raw element ends; within svg and math at their end, too.
RAW_END = {(name, inner): re.compile(rf"</({name}{'|svg|math' * inner})(?=[\s/>])", re.I) for name in RAW for inner in (False, True)}
ATTRIBUTE = re.compile(r"(?<![^\s\"'=])([^\s\"'=]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
HINTS = re.compile(r"\b(?:class|id|role)\Z", re.I)
CACHED = 2000  # characters; longer attributes are read each time
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

WRAPPED = 0.5
PARAGRAPH = 10
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "aside", "place")
# Labelled blocks, in the order of FEATURES, then 1 for main text. Link shares are in percent. Aside is 1 in an element that is not part
# of the article, and WRAPPED if nothing but the class words of a wrapper say so, which holds most of the page. The place is 2 within a marked
# article, 0 outside the article of a page that marks one, and 1 on pages that mark none.
EXAMPLES = (
    # Paragraphs of marked articles, long and short, with and without links.
    (120, 0, 12, 0, 90, 0, 0, 0, 2, 1), (45, 4, 120, 0, 60, 0, 0, 0, 2, 1), (8, 0, 90, 0, 70, 3, 0, 0, 2, 1), (3, 0, 60, 0, 40, 0, 0, 0, 2, 1),
    (1, 0, 30, 0, 25, 0, 0, 0, 2, 1), (60, 20, 40, 0, 30, 10, 0, 0, 2, 1), (25, 30, 80, 5, 90, 0, 0, 0, 2, 1), (14, 0, 0, 0, 0, 0, 0, 0, 2, 1),
    (400, 1, 9, 0, 8, 50, 0, 0, 2, 1), (6, 40, 70, 0, 85, 0, 0, 0, 2, 1), (7, 14, 4, 0, 2, 0, 0, 0, 2, 1), (10, 50, 12, 0, 0, 0, 0, 0, 2, 1),
    (2, 0, 5, 100, 60, 0, 0, 0, 2, 1), (15, 60, 20, 0, 3, 100, 0, 0, 2, 1), (1, 0, 4, 100, 0, 0, 0, 0, 2, 1), (5, 0, 3, 100, 2, 100, 0, 0, 2, 1),
    # Headings of marked articles.
    (9, 0, 6, 100, 80, 0, 1, 0, 2, 1), (4, 0, 110, 0, 75, 0, 1, 0, 2, 1), (12, 0, 5, 0, 3, 0, 1, 0, 2, 1), (7, 100, 0, 0, 140, 0, 1, 0, 2, 1),
    # Lists of links within an article: related stories, next and previous.
    (6, 100, 90, 0, 5, 100, 0, 0, 2, 0), (3, 100, 3, 100, 4, 100, 0, 0, 2, 0), (8, 90, 6, 100, 0, 0, 0, 0, 2, 0), (12, 85, 40, 0, 10, 100, 0, 0, 2, 0),
    (2, 100, 70, 0, 2, 100, 0, 0, 2, 0), (20, 95, 15, 100, 18, 100, 0, 0, 2, 0), (4, 100, 30, 0, 25, 0, 0, 0, 2, 0),
    # Paragraphs and headings of pages that mark no article.
    (80, 0, 10, 0, 70, 0, 0, 0, 1, 1), (40, 10, 60, 0, 30, 5, 0, 0, 1, 1), (16, 0, 50, 0, 45, 0, 0, 0, 1, 1), (12, 0, 70, 0, 0, 0, 0, 0, 1, 1),
    (4, 0, 60, 0, 50, 0, 0, 0, 1, 1), (6, 0, 4, 100, 65, 0, 1, 0, 1, 1), (5, 0, 90, 0, 40, 0, 1, 0, 1, 1), (2, 0, 14, 0, 0, 0, 0, 0, 1, 1),
    (25, 20, 3, 100, 55, 0, 0, 0, 1, 1), (14, 0, 0, 0, 2, 0, 0, 0, 1, 1), (11, 0, 0, 0, 0, 0, 0, 0, 1, 1), (9, 30, 40, 0, 35, 0, 0, 0, 1, 1),
    # What else there is on them: menus, link lists, and short lines next to those.
    (1, 100, 0, 0, 1, 100, 0, 0, 1, 0), (4, 100, 3, 100, 5, 100, 0, 0, 1, 0), (9, 90, 60, 0, 8, 100, 0, 0, 1, 0), (3, 0, 4, 100, 2, 100, 0, 0, 1, 0),
    (5, 0, 6, 100, 0, 0, 0, 0, 1, 0), (2, 0, 0, 0, 1, 100, 0, 0, 1, 0), (7, 70, 5, 100, 4, 100, 0, 0, 1, 0), (30, 80, 20, 90, 25, 85, 0, 0, 1, 0),
    # Paragraphs, headings and short lines in a wrapper that is named after something else, then menus and link lists in it.
    (80, 0, 10, 0, 70, 0, 0, WRAPPED, 1, 1), (40, 10, 60, 0, 30, 5, 0, WRAPPED, 1, 1), (16, 0, 50, 0, 45, 0, 0, WRAPPED, 1, 1), (6, 0, 4, 100, 65, 0, 1, WRAPPED, 1, 1),
    (4, 0, 60, 0, 50, 0, 0, WRAPPED, 1, 1), (12, 0, 70, 0, 0, 0, 0, WRAPPED, 1, 1), (14, 0, 0, 0, 2, 0, 0, WRAPPED, 1, 1), (60, 20, 40, 0, 30, 10, 0, WRAPPED, 2, 1),
    (90, 0, 12, 0, 40, 0, 0, WRAPPED, 2, 1), (7, 0, 60, 0, 40, 0, 1, WRAPPED, 2, 1), (1, 100, 0, 0, 1, 100, 0, WRAPPED, 1, 0), (9, 90, 60, 0, 8, 100, 0, WRAPPED, 1, 0),
    (3, 0, 4, 100, 2, 100, 0, WRAPPED, 1, 0), (30, 80, 20, 90, 25, 85, 0, WRAPPED, 1, 0), (6, 100, 90, 0, 5, 100, 0, WRAPPED, 2, 0), (25, 0, 80, 0, 0, 0, 0, WRAPPED, 0, 0),
    # Headings of related stories.
    (6, 100, 5, 100, 8, 100, 1, 0, 1, 0), (9, 100, 70, 0, 20, 0, 1, 0, 2, 0), (8, 100, 25, 0, 22, 0, 1, 0, 0, 0),
    # Menus, headers, footers, sidebars, notices, adverts, forms and reader comments, some of them long.
    (1, 100, 0, 0, 1, 100, 0, 1, 1, 0), (5, 0, 1, 100, 9, 0, 0, 1, 0, 0), (14, 0, 60, 0, 0, 0, 0, 1, 0, 0), (90, 0, 40, 0, 30, 0, 0, 1, 2, 0),
    (35, 10, 120, 0, 10, 0, 0, 1, 2, 0), (6, 0, 10, 0, 50, 0, 1, 1, 2, 0), (200, 0, 8, 0, 15, 0, 0, 1, 1, 0), (60, 0, 50, 0, 70, 0, 0, 1, 0, 0),
    (3, 100, 4, 100, 5, 100, 0, 1, 0, 0), (18, 30, 5, 0, 7, 0, 0, 1, 1, 0), (4, 0, 70, 0, 80, 0, 0, 1, 2, 0), (2, 0, 60, 0, 40, 0, 0, 1, 2, 0),
    (9, 0, 6, 100, 80, 0, 1, 1, 1, 0), (45, 0, 80, 0, 60, 0, 0, 1, 1, 0), (16, 0, 50, 0, 45, 0, 0, 1, 1, 0), (120, 0, 12, 0, 90, 0, 0, 1, 2, 0),
    (7, 100, 0, 0, 140, 0, 1, 1, 2, 0), (3, 100, 4, 100, 200, 0, 0, 1, 1, 0),
    # What else stands outside a marked article.
    (4, 0, 1, 100, 12, 0, 0, 0, 0, 0), (25, 0, 80, 0, 0, 0, 0, 0, 0, 0), (70, 0, 90, 0, 10, 0, 0, 0, 0, 0), (5, 100, 5, 100, 5, 100, 0, 0, 0, 0),
    (8, 0, 0, 0, 60, 0, 1, 0, 0, 0), (150, 2, 20, 0, 30, 0, 0, 0, 0, 0), (3, 0, 60, 0, 40, 0, 0, 0, 0, 0), (40, 0, 100, 0, 90, 0, 0, 0, 0, 0),
)


def trained_tree(rows: tuple = EXAMPLES, depth: int = 6) -> tuple | int:
    """A decision tree ``(feature, limit, at most, above)`` or a class, by the split that leaves the least Gini impurity.

    Ties go to the earlier feature and the smaller limit, so the same table always gives the same tree.
    """
    positive = sum(r[-1] for r in rows)
    if depth == 0 or positive in (0, len(rows)):
        return int(2 * positive > len(rows))

    def impurity(part: list) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    splits = []
    for feature in range(len(FEATURES)):
        values = sorted({r[feature] for r in rows})
        for lo, hi in zip(values, values[1:]):
            limit = (lo + hi) / 2
            left, right = [r for r in rows if r[feature] <= limit], [r for r in rows if r[feature] > limit]
            splits.append((round(impurity(left) + impurity(right), 9), feature, limit))
    if not splits:
        return int(2 * positive > len(rows))
    _, feature, limit = min(splits)
    return (
        feature,
        limit,
        trained_tree(tuple(r for r in rows if r[feature] <= limit), depth - 1),
        trained_tree(tuple(r for r in rows if r[feature] > limit), depth - 1),
    )


def classify(tree: tuple | int, features: tuple) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


@lru_cache(maxsize=50_000)
def _hinted(attributes: str) -> int:
    """2 for an element of reader comments, 1 for another that is not part of the article, 0 for others."""
    words = set()
    for found in ATTRIBUTE.finditer(attributes):
        value = found[2] or found[3] or found[4] or ""
        if HINTS.search(found[1]):
            words.update(WORD.findall(CAMEL.sub(" ", value).lower()))
    return 2 if words & COMMENT_WORDS else 1 if words & ASIDE_WORDS else 0


def _tokens(html: str) -> list[tuple[int, int, str, str, str]]:
    """``(start, end, slash of an end tag, name, attributes)`` of tags and comments; a raw element is one token, with its text."""
    tokens = []
    at = foreign = 0
    while found := TOKEN.search(html, at):
        at = found.end()
        slash, name, attributes = found[1] or found[4] or "", (found[2] or found[5] or "").lower(), found[3] or found[6] or ""
        if (name in RAW or name in DROPPED) and attributes and not (attributes[0].isspace() or attributes[0] == "/"):
            name = ""  # another element, whose name goes on
        if name in FOREIGN:
            if slash:
                foreign = max(foreign - 1, 0)
            elif attributes.endswith("/"):
                name = ""  # empty
            else:
                foreign += 1
        elif name in RAW and not slash and not (foreign and attributes.endswith("/")):
            end = RAW_END[name, foreign > 0].search(html, at)
            if end and end[1].lower() != name:
                at = end.start()
            else:
                at = html.find(">", end.end()) + 1 if end else 0
                at = at or len(html)
        tokens.append((found.start(), at, slash, name, attributes))
    return tokens


def _end_same(open_tags: list[tuple], name: str) -> None:
    """An item, a cell or a paragraph ends where the next one begins."""
    if name in ("p", "li", "option", "td", "th", "tr", "dt", "dd") and open_tags and open_tags[-1][0] == name:
        open_tags.pop()


def _pop(open_tags: list[tuple], name: str) -> tuple | None:
    """Closes the last open element of that name, and those within it."""
    for at in range(len(open_tags) - 1, -1, -1):
        if open_tags[at][0] == name:
            closed = open_tags[at]
            del open_tags[at:]
            return closed
    return None


def _subtrees(tokens: list[tuple[int, int, str, str, str]]) -> dict[int, int]:
    """The end tags of the elements that are dropped with all they hold, by their start tags.

    One that is still open when an element around it ends has lost its end tag. It counts as empty, so that it takes nothing along.
    """
    ends: dict[int, int] = {}
    open_tags: list[tuple[str, int]] = []
    for i, (_, _, slash, name, _) in enumerate(tokens):
        if not name or name in RAW or name in VOID:
            continue
        if not slash:
            _end_same(open_tags, name)
            open_tags.append((name, i))
        elif (closed := _pop(open_tags, name)) and name in DROPPED:
            ends[closed[1]] = i
    return ends


def text_blocks(html: str) -> list[tuple[str, int, float, int, float, int]]:
    """``(text, words, percent of them in links, heading, aside, in the article)`` of each block that has text."""
    blocks: list[tuple[str, int, float, int, bool, tuple[int, int], int]] = []
    open_tags: list[tuple[str, tuple[int, int]]] = []  # name, and the last elements with hints of comments and of other asides
    hints: dict[int, tuple[str, int, int]] = {}  # by the number of the start tag: name, as in _hinted, and the last such element before
    titled: set[int] = set()  # the elements with hints of comments that hold an h1 or main
    parts: list[str] = []
    linked: list[str] = []

    def last_hints() -> tuple[int, int]:
        return open_tags[-1][1] if open_tags else (-1, -1)

    def flush() -> None:
        words = unescape("".join(parts)).split()
        if words:
            names = [name for name, _ in open_tags]
            start = max((i for i, name in enumerate(names) if name in MAIN), default=-1)
            # An article begins anew: an unclosed menu before it does not reach into it, but a thread of comments does.
            aside = any(i >= start and name in ASIDE for i, name in enumerate(names))
            share = 100.0 * len(unescape("".join(linked)).split()) / len(words)
            blocks.append((" ".join(words), len(words), share, int(any(n in HEADINGS for n in names)), aside, last_hints(), int(start >= 0)))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        parts.append(text)
        if any(name == "a" for name, _ in open_tags):
            linked.append(text + " ")

    tokens = _tokens(html)
    ends = _subtrees(tokens)
    at, last = 0, -1
    for i, (start, end, slash, name, attributes) in enumerate(tokens):
        if i > last and start > at:
            add(html[at:start])
        at = end
        if i <= last or not name:
            continue
        if name in RAW or name in DROPPED:
            if name in BOXES:
                flush()
            last = ends.get(i, last)
            continue
        if name in BLOCK:
            flush()
        if slash:
            _pop(open_tags, name)
        elif name not in VOID:
            hint = (_hinted if len(attributes) < CACHED else _hinted.__wrapped__)(attributes) if attributes else 0
            if name in ("html", "body", "main") or name == "article" and hint == 1:
                hint = 0
            _end_same(open_tags, name)
            thread, other = last_hints()
            if name in ("h1", "main"):
                while thread >= 0 and thread not in titled:
                    titled.add(thread)
                    thread = hints[thread][2]
                thread = last_hints()[0]
            if name in MAIN:
                other = -1
            if hint == 2:
                hints[i], thread = (name, hint, thread), i
            elif hint:
                hints[i], other = (name, hint, other), i
            open_tags.append((name, (thread, other)))
    if at < len(html):
        add(html[at:])
    flush()
    if not hints:
        return [(*block[:4], int(block[4]), block[6]) for block in blocks]
    wrappers = _wrappers([(words * (100 - share) / 100, last) for _, words, share, _, aside, last, _ in blocks if not aside], hints, titled)
    strong = _within(set(hints) - wrappers, hints)
    weak = _within({tag for tag in wrappers if hints[tag][0] != "article"}, hints)
    return [(*block[:4], 1 if block[4] or strong & {*block[5]} else WRAPPED if weak & {*block[5]} else 0, block[6]) for block in blocks]


def _within(tags: set[int], hints: dict[int, tuple[str, int, int]]) -> set[int]:
    """The tags, and the elements with hints of the same kind within them."""
    found: set[int] = set()
    for tag, (_, _, before) in hints.items():  # in page order
        if tag in tags or before in found:
            found.add(tag)
    return found


def _wrappers(rows: list[tuple[float, tuple[int, int]]], hints: dict[int, tuple[str, int, int]], titled: set[int]) -> set[int]:
    """The elements whose class words say little, as they hold most of the page. ``rows`` has the unlinked words of the blocks and the
    last elements with hints around them.

    A thread of comments may be longer than the article, so it must hold the page's title or every paragraph to be a wrapper, and it does
    not count when others are compared. An article named after comments is one of many unless it holds most of what is left.
    """

    def held(rows: list[tuple[float, tuple[int, int]]]) -> dict[int, float]:
        sums = dict.fromkeys([*hints, -1], 0.0)
        for words, last in rows:
            for tag in last:
                sums[tag] += words
        for tag in reversed(hints):
            sums[hints[tag][2]] += sums[tag]
        return sums

    def most(rows: list[tuple[float, tuple[int, int]]]) -> set[int]:
        sums, total = held(rows), sum(words for words, _ in rows)
        return {tag for tag in hints if 2 * sums[tag] > total}

    def without(threads: set[int]) -> list[tuple[float, tuple[int, int]]]:
        inner = _within(threads, hints)
        return [(words, last) for words, last in rows if last[0] not in inner]

    comments = {tag for tag, (_, hint, _) in hints.items() if hint == 2}
    articles = {tag for tag in comments if hints[tag][0] == "article"}
    paragraphs = [(1.0, last) for words, last in rows if words >= PARAGRAPH] or [(1.0, last) for words, last in rows if words]
    counts = held(paragraphs)
    threads = comments - articles - titled - {tag for tag in most(rows) if counts[tag] == len(paragraphs)}
    threads |= articles - most(without(threads))
    return most(without(threads)) - threads


def main_text(html: str, tree: tuple | int) -> str:
    blocks = text_blocks(html)
    marked = any(inside and aside < 1 for _, _, _, _, aside, inside in blocks)
    edge = ("", 0, 0.0, 0, 0, 0)
    kept = []
    for before, block, after in zip([edge, *blocks], blocks, [*blocks[1:], edge]):
        text, words, links, heading, aside, inside = block
        features = (words, links, before[1], before[2], after[1], after[2], heading, aside, 2 * inside if marked else 1)
        if classify(tree, features):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per page."""
    tree = trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "", tree) for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
