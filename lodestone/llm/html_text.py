"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its
word count and link density, those of its two neighbours, and where it stands:
within an article, within something that announces itself as no content (a
menu, a form, an element named sidebar or comments ...), or as a heading. A
decision tree, grown here from the small labelled table below, tells blocks of
the article from the rest.

Place decides alone in elements whose tag, role or whole name says that they are no
content, and outside of the article on a page that has one. A name that only holds such a
word (``has-sidebar``, ``share-price``) is a hint: words and links decide there, and an article
inside such an element is one like any other.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: names of HTML elements, and names that announce no content --
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
ARTICLE_TAGS = frozenset(["article", "main"])
OTHER_TAGS = frozenset("aside button dialog footer form head menu nav option search title".split())
OTHER_NAMES = frozenset(
    "ad ads adbox advert advertisement alert author-bio banner breadcrumb breadcrumbs byline-share comment "
    "comments consent cookie cookies copyright disclaimer disqus feedback footer legal login menu modal "
    "nav navbar navigation newsletter notice notification pager pagination popup promo promotion "
    "recommended related respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toolbar widget".split()
)
# Words beside these in a name that leave its meaning as it is, and names of content, which make it a hint.
PLAIN_PARTS = frozenset(
    "area articles bar bottom box button buttons block container entries form global group inner item items left links list "
    "main page panel posts primary right row section secondary site slot stories top unit user wrap wrapper".split()
)
CONTENT_NAMES = frozenset(
    "article article-body article-content body-content content entry entry-content hentry main-content post post-body "
    "post-content story story-body".split()
)
# Of these, an article may have its own, with its title in it.
HEADER_NAMES = frozenset("header masthead".split())
OTHER_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Only what a browser reads as raw text runs to the end of a page that does not close it.
    r"|<(script|style)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?<=/)>"
    # One that is not closed before the next of its kind, or a choice before text begins, is a tag alone.
    r"|<(noscript|template|svg|math|iframe|object|canvas|textarea|audio|video)(?=[\s/>])"
    r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>(?:[^<]++|<(?!\2[\s/>]))*?</\2\s*>"
    r"|<select(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>"
    r"(?:[^<]++|<(?!/?(?:select|p|div|h[1-6]|article|section|main|ul|ol|table|form)[\s/>]))*+</select\s*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^<>]*)>"
    r"|<[!?/][^<>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "article",  # 1 within an article, 0 if the page has none, -1 outside of it
    "other",    # 1 within an element that announces no content, a half where its name hints at that
    "heading",
)
# Labelled blocks in the order of FEATURES, with 1 for blocks of the article.
LABELLED = (
    # articles: titles, paragraphs, lists, captions, single words, a paragraph that is a link
    (9, 0, 4, 0, 60, 0, 1, 0, 1, 1), (12, 0, 25, 0, 110, 0, 1, 0, 1, 1), (3, 0, 80, 0, 55, 0, 1, 0, 1, 1),
    (60, 0, 9, 0, 45, 0, 1, 0, 0, 1), (110, .05, 12, 0, 90, 0, 1, 0, 0, 1), (2, 0, 90, 0, 30, 0, 1, 0, 0, 1),
    (1, 0, 1, 0, 1, 0, 1, 0, 0, 1), (500, 0, 40, 0, 14, 0, 1, 0, 0, 1), (30, .3, 45, .1, 14, .6, 1, 0, 0, 1),
    (14, 0, 60, 0, 14, .1, 1, 0, 0, 1), (45, .1, 30, .3, 9, 1, 1, 0, 0, 1), (6, 1, 70, 0, 65, 0, 1, 0, 0, 1),
    (5, 0, 2, 0, 3, .35, 1, 0, 0, 1), (8, .4, 20, .2, 0, 0, 1, 0, 0, 1), (4, .5, 60, .1, 60, 0, 1, 0, 0, 1), (20, .6, 33, 0, 41, .1, 1, 0, 0, 1),
    # lists of links inside an article
    (4, 1, 70, 0, 5, 1, 1, 0, 0, 0), (5, 1, 4, 1, 6, 1, 1, 0, 0, 0), (6, 1, 5, 1, 3, 1, 1, 0, 0, 0),
    (3, 1, 6, 1, 8, .95, 1, 0, 0, 0),
    # menus, adverts, forms, notices, comments, inside an article or not, however long
    (1, 1, 0, 0, 1, 1, -1, 1, 0, 0), (1, 1, 1, 1, 1, 1, -1, 1, 0, 0), (2, 1, 1, 1, 9, 0, -1, 1, 0, 0),
    (9, 0, 1, 1, 12, 0, -1, 1, 0, 0), (18, .1, 110, 0, 0, 0, -1, 1, 0, 0), (14, 0, 60, 0, 0, 0, -1, 1, 0, 0),
    (40, 0, 60, 0, 50, 0, 1, 1, 0, 0), (75, 0, 14, 0, 80, 0, 1, 1, 0, 0), (3, 0, 80, 0, 40, 0, 1, 1, 1, 0),
    (25, .2, 90, 0, 3, 0, 1, 1, 0, 0), (120, 0, 4, 0, 6, 0, -1, 1, 0, 0), (35, 0, 3, 1, 40, 0, 0, 1, 0, 0),
    (60, 0, 35, 0, 8, 1, 0, 1, 0, 0), (4, 0, 1, 1, 35, 0, 0, 1, 1, 0), (1, 1, 1, 1, 30, 0, 0, 1, 0, 0),
    # where a name hints at no content: text with few links is content, short or linked blocks are not
    (40, 0, 60, 0, 50, 0, 1, .5, 0, 1), (15, 0, 30, 0, 30, .1, 1, .5, 0, 1), (90, .1, 4, 1, 60, 0, 1, .5, 0, 1),
    (12, 0, 70, 0, 3, 1, 1, .5, 0, 1), (60, .05, 8, 0, 45, 0, 0, .5, 0, 1), (24, .1, 50, 0, 30, 0, 0, .5, 0, 1),
    (130, 0, 3, 1, 4, 1, 0, .5, 0, 1), (20, 0, 40, 0, 3, 0, 0, .5, 0, 1),
    (3, .9, 60, 0, 40, 0, 1, .5, 0, 0), (2, 0, 50, 0, 3, 1, 1, .5, 0, 0), (9, .8, 60, 0, 5, 1, 1, .5, 0, 0),
    (5, 0, 3, 1, 45, 0, 1, .5, 1, 0), (30, .9, 40, 0, 30, .9, 1, .5, 0, 0), (4, 1, 4, 1, 60, 0, 0, .5, 0, 0),
    (5, 0, 50, 0, 4, .9, 0, .5, 0, 0), (3, 0, 60, 0, 60, 0, 0, .5, 1, 0), (25, .8, 6, 1, 60, 0, 0, .5, 0, 0),
    # outside of an article on a page that has one
    (9, 0, 2, 1, 12, 0, -1, 0, 0, 0), (40, 0, 110, 0, 6, 1, -1, 0, 0, 0), (90, 0, 30, 0, 20, 0, -1, 0, 0, 0),
    (5, 0, 9, 0, 60, 0, -1, 0, 1, 0), (22, .9, 40, 0, 5, 1, -1, 0, 0, 0), (3, 1, 3, 1, 3, 1, -1, 0, 0, 0),
    # pages without an article: text is long or has text around it
    (60, 0, 8, 0, 45, 0, 0, 0, 0, 1), (45, .1, 60, 0, 80, 0, 0, 0, 0, 1), (24, 0, 50, 0, 3, 1, 0, 0, 0, 1),
    (150, .2, 3, 1, 4, 1, 0, 0, 0, 1), (16, .05, 40, 0, 30, 0, 0, 0, 0, 1), (9, 0, 45, 0, 60, 0, 0, 0, 0, 1),
    (6, 0, 2, 1, 60, 0, 0, 0, 1, 1), (4, 0, 60, 0, 45, 0, 0, 0, 1, 1), (11, 0, 5, 1, 110, 0, 0, 0, 1, 1),
    (5, 0, 45, 0, 25, .1, 0, 0, 0, 1), (3, 0, 70, 0, 50, 0, 0, 0, 0, 1),
    (1, 1, 1, 1, 1, 1, 0, 0, 0, 0), (3, 1, 0, 0, 4, 1, 0, 0, 0, 0), (30, .9, 3, 1, 40, 1, 0, 0, 0, 0),
    (5, 0, 1, 1, 3, 1, 0, 0, 0, 0), (8, 0, 60, 0, 0, 0, 0, 0, 0, 0), (4, 0, 3, 1, 6, .5, 0, 0, 1, 0),
    (2, .5, 20, 0, 2, 1, 0, 0, 0, 0), (12, .7, 60, 0, 5, 1, 0, 0, 0, 0), (6, 0, 2, 0, 4, 0, 0, 0, 0, 0),
)
TREE_DEPTH = 6


def grow(rows: np.ndarray, depth: int = TREE_DEPTH) -> tuple:
    """A tree of ``(feature, bound, below, above)`` and leaves ``(label,)`` by least Gini impurity."""
    marks = rows[:, -1]
    if depth == 0 or marks.min() == marks.max():
        return (int(marks.mean() >= 0.5),)

    def impurity(part):
        share = part.mean()
        return len(part) * share * (1 - share)

    best = None
    for feature in range(rows.shape[1] - 1):
        values = np.unique(rows[:, feature])
        for bound in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] < bound
            cost = impurity(marks[low]) + impurity(marks[~low])
            if best is None or cost < best[0] - 1e-12:
                best = cost, feature, float(bound), low
    if best is None:
        return (int(marks.mean() >= 0.5),)
    _, feature, bound, low = best
    return feature, bound, grow(rows[low], depth - 1), grow(rows[~low], depth - 1)


def varied(labelled: tuple) -> np.ndarray:
    """The table with, for rows outside of the content, other sizes of the block and its neighbours."""
    rows = list(labelled)
    for row in labelled:
        if row[6] == -1 or row[7] == 1:
            rows += [
                (own, row[1], before, row[3], after, row[5], *row[6:])
                for own in (1, 12, 400) for before in (0, 8, 90, 400) for after in (0, 8, 90, 400)
            ]
    return np.array(rows, float)


@cache
def _tree(labelled: tuple) -> tuple:
    return grow(varied(labelled))


def _is_content(tree: tuple, row: tuple) -> bool:
    while len(tree) > 1:
        feature, bound, below, above = tree
        tree = below if row[feature] < bound else above
    return bool(tree[0])


@cache
def _named(token: str) -> int:
    """-2 for a name that announces no content, -1 for one that hints at it, 1 for one of content, else 0."""
    low = token.lower()
    if low in CONTENT_NAMES:
        return 1
    parts = {p.lower() for p in _NAME_PART.findall(token)}
    if low in OTHER_NAMES:
        return -2
    if parts & OTHER_NAMES:
        return -2 if parts <= OTHER_NAMES | PLAIN_PARTS else -1
    return 0


def _place(tag: str, attributes: str, in_article: bool) -> int:
    """1 for an element that starts an article, -2 for one that is no content, -1 for a hint at that, else 0."""
    if tag in OTHER_TAGS or (tag == "header" and not in_article):
        return -2
    if "=" in attributes or "hidden" in attributes:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        bare = _ATTRIBUTE.sub(" ", attributes).lower().split()
        if "hidden" in bare or found.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")
        ):
            return -2
        if tag not in ("html", "body", "article", "main") and tag not in HEADINGS:
            tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
            if found.get("role", "") in OTHER_ROLES:
                return -2
            said = [_named(t) for t in tokens]
            if min(said, default=0) < 0:
                # A name of content beside another makes that a hint, and a hint nothing.
                return min(min(said) + (1 in said), 0)
            if not in_article and any({p.lower() for p in _NAME_PART.findall(t)} & HEADER_NAMES for t in tokens):
                return -2
        elif tag in ARTICLE_TAGS and {p.lower() for p in _NAME_PART.findall(found.get("class", ""))} & {
            "comment", "teaser", "related"
        }:
            return -2
        if found.get("role") in ("main", "article") or found.get("itemprop") == "articleBody":
            return 1
    return int(tag in ARTICLE_TAGS)


class _Open:
    """The open block elements, with how many of them are articles, no content, or hint at that."""

    def __init__(self):
        self.stack: list[tuple[str, int, int]] = []
        self.count: Counter = Counter()
        self.article = self.other = self.hints = 0

    def push(self, tag: str, place: int) -> None:
        self.stack.append((tag, place, self.hints))
        self.count[tag] += 1
        self.article += place == 1
        self.other += place == -2
        # What surrounds an article hints at nothing inside it.
        self.hints = 0 if place == 1 else self.hints + (place == -1)

    def pop(self) -> str:
        tag, place, self.hints = self.stack.pop()
        self.count[tag] -= 1
        self.article -= place == 1
        self.other -= place == -2
        return tag

    def outside(self) -> float:
        return 1 if self.other else 0.5 if self.hints else 0

    def close(self, tag: str) -> None:
        if self.count[tag]:
            while self.pop() != tag:
                pass


def blocks(page: str) -> list[tuple[str, float, int, float, int]]:
    """Flat blocks ``(text, link share, article, other, heading)`` of a page in order."""
    found: list = []
    parts: list[tuple[str, bool]] = []
    state, at, link, heading, articles = _Open(), 0, 0, 0, False

    def flush():
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = " ".join(p for p, a in parts if a)
                share = min(1.0, len(linked.split()) / len(text.split())) if linked else 0.0
                found.append((text, share, int(state.article > 0), state.outside(), int(heading > 0)))
            parts = []

    # No tag ends behind the last ">".
    for token in _TOKEN.finditer(page, 0, page.rfind(">") + 1):
        if token.start() > at:
            parts.append((page[at:token.start()], link > 0))
        at = token.end()
        closing, tag, attributes = (
            (token[3], token[4], token[5]) if token[4] else (token[6], token[7], token[8])
        )
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            link = 0 if closing else 1
        elif tag == "br":
            parts.append((" ", link > 0))
        elif tag in BLOCK_TAGS:
            flush()
            link = 0
            if tag in HEADINGS:
                heading = 0 if closing else 1
            if closing:
                state.close(tag)
                continue
            if state.count["p"]:
                state.close("p")
            if state.count["option"] and tag != "option":
                state.close("option")
            if tag in ("li", "option", "dt", "dd", "tr", "td", "th") and state.stack and state.stack[-1][0] == tag:
                state.pop()
            if tag == "body":
                state.close("head")
            if tag not in VOID_TAGS:
                place = _place(tag, attributes, state.article > 0)
                articles |= place == 1 and not state.other
                state.push(tag, place)
    parts.append((page[at:], link > 0))
    flush()
    return [(t, share, a if articles else 0, o, h) if a or not articles else (t, share, -1, o, h)
            for t, share, a, o, h in found]


def described(found: list[tuple]) -> list[tuple]:
    """The features of every block, in the order of FEATURES."""
    sizes = [(len(text.split()), share) for text, share, *_ in found]
    around = [(0, 0.0), *sizes, (0, 0.0)]
    return [
        (*own, *around[i], *around[i + 2], *found[i][2:]) for i, own in enumerate(sizes)
    ]


def main_text(page: str | None, labelled: tuple = LABELLED) -> str:
    """The blocks of the article, each on a line of its own."""
    found, tree = blocks(page or ""), _tree(labelled)
    return "\n".join(b[0] for b, row in zip(found, described(found), strict=True) if _is_content(tree, row))


def _texts(batches, labelled: tuple) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(value.as_py(), labelled) for value in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def extract(pages: DataFrame, labelled: tuple = LABELLED) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    A null, empty or text-free page has an empty text; rows repeated are read
    each. Pages are independent, so nothing is shuffled, and the tree is small.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    texts = rows.mapInArrow(partial(_texts, labelled=labelled), "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
