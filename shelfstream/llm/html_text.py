"""HTML extraction: flat text blocks judged by a decision tree from word counts and link densities.

A page is cut into flat blocks at its block-level tags.  Every block has its number of words, the share of them inside
links, the same two figures of its neighbours, whether it is a heading, and where it and the next one stand: inside an
article or main element (1), inside an element that names itself a menu, footer, advert, form, comment section or the like
(-1), or neither.
A small decision tree, grown on a labelled table of blocks, tells content from the rest.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
END_OR_QUOTE = re.compile(r">|=\s*([\"'])")
LONG_NUMBER = re.compile(r"&#(?:0+(?=[0-9])|[0-9]{8,}(;?))")
ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is no text of the page.
RAW = set("script style noscript template textarea title svg iframe object select option button canvas head".split())
CONTAINERS = set(
    "html body div section article main nav aside header footer form ul ol dl table tbody thead tr td th figure "
    "blockquote fieldset details dialog center menu".split()
)
BLOCKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption legend summary".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
JUMPED_TO = HEADINGS | {"section", "p"}
VOID = set("br hr img input meta link area base col embed source track wbr".split())
#: Elements, roles and class or id words that mark what is not the article.
OUTSIDE_TAGS = set("nav aside footer form menu dialog".split())
OUTSIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice "
    "notification alert newsletter subscribe subscription signup popup modal overlay menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar side widget footer header masthead comment comments commentlist disqus reply replies respond related "
    "recommended share sharing social login search hidden toolbar pagination pager tags skip legal copyright "
    "reactions kommentare commentaires comentarios commenti reviews responses feedback".split()
)
#: Of these, what may hold articles of its own: remarks, cards and adverts.
REPEATING_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side widget comment comments "
    "commentlist disqus reply replies respond related recommended reactions kommentare commentaires comentarios commenti reviews "
    "responses feedback nav navbar navigation footer popup modal cookie cookies consent".split()
)
#: Parts of a class name that only say what an element has beside it, and parts whose header is a headline.
BESIDE_WORDS = set("has no not non with without".split())
HEADLINE_OF = set("entry post article story content section".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

#: The labelled table: pages of blocks in order; a block is (place, heading, words, linked words, content or not).
LABELLED: list[list[tuple[int, int, int, int, int]]] = [
    # article element, a menu before it and a footer behind it
    [(-1, 0, 1, 1, 0), (-1, 0, 2, 2, 0), (-1, 0, 7, 0, 0), (1, 1, 9, 0, 1), (1, 0, 62, 0, 1), (1, 0, 3, 0, 1),
     (1, 0, 140, 4, 1), (1, 0, 1, 0, 1), (1, 0, 1, 0, 1), (1, 0, 88, 0, 1), (-1, 0, 16, 0, 0)],
    # article of short paragraphs, one of them a single link, and a list of links inside it
    [(-1, 0, 4, 4, 0), (1, 1, 5, 0, 1), (1, 0, 12, 0, 1), (1, 0, 4, 4, 1), (1, 0, 2, 0, 1), (1, 0, 9, 1, 1), (1, 1, 3, 0, 1),
     (1, 0, 25, 6, 1), (1, 0, 4, 4, 0), (1, 0, 6, 6, 0), (1, 0, 5, 5, 0), (-1, 0, 30, 0, 0), (-1, 0, 55, 2, 0), (-1, 0, 9, 3, 0)],
    # article, advert in the middle, sidebar with long teasers, comments as long as paragraphs
    [(-1, 0, 3, 3, 0), (1, 1, 8, 0, 1), (1, 0, 75, 2, 1), (-1, 0, 14, 0, 0), (1, 0, 40, 0, 1),
     (1, 0, 5, 5, 0), (-1, 1, 2, 0, 0), (-1, 0, 38, 38, 0), (-1, 0, 45, 12, 0), (-1, 0, 80, 0, 0), (-1, 0, 120, 1, 0), (-1, 0, 11, 4, 0)],
    # article with nothing around it, the last paragraph a short one; another of one paragraph only
    [(1, 1, 4, 0, 1), (1, 0, 2, 0, 1), (1, 0, 30, 0, 1), (1, 0, 9, 9, 1), (1, 0, 26, 0, 1), (1, 0, 4, 0, 1)],
    [(1, 0, 18, 0, 1)],
    # no article element: menu and footer show by their links and neighbours
    [(0, 0, 1, 1, 0), (0, 0, 2, 2, 0), (0, 0, 3, 3, 0), (0, 1, 7, 0, 1), (0, 0, 48, 0, 1), (0, 0, 90, 5, 1),
     (0, 0, 14, 0, 1), (0, 0, 66, 1, 1), (0, 0, 3, 3, 0), (0, 0, 2, 2, 0), (0, 0, 6, 1, 0)],
    [(0, 0, 2, 2, 0), (0, 0, 5, 5, 0), (0, 1, 6, 0, 1), (0, 0, 35, 0, 1), (0, 1, 4, 0, 1), (0, 0, 44, 2, 1),
     (0, 0, 120, 3, 1), (0, 0, 9, 0, 1), (0, 0, 31, 0, 1), (0, 0, 4, 4, 0), (0, 0, 5, 5, 0), (0, 0, 8, 2, 0), (0, 0, 4, 0, 0)],
    # no article element: a byline below the headline, paragraphs to the page's end
    [(0, 0, 2, 2, 0), (0, 0, 1, 1, 0), (0, 1, 5, 0, 1), (0, 0, 2, 0, 1), (0, 0, 40, 0, 1), (0, 0, 22, 1, 1), (0, 0, 34, 0, 1)],
    [(0, 0, 3, 3, 0), (0, 1, 8, 0, 1), (0, 0, 1, 0, 1), (0, 0, 18, 0, 1), (0, 0, 3, 0, 1)],
    # paragraphs with many links one after the other, and a list of links behind a paragraph without any
    [(-1, 0, 2, 2, 0), (1, 1, 4, 0, 1), (1, 0, 30, 6, 1), (1, 0, 28, 9, 1), (1, 0, 12, 3, 1), (1, 0, 33, 0, 1), (1, 0, 2, 2, 1),
     (1, 0, 19, 0, 1), (1, 0, 5, 5, 0), (1, 0, 3, 3, 0), (1, 0, 6, 6, 0), (1, 1, 4, 0, 1), (1, 0, 21, 0, 1),
     (1, 0, 6, 6, 1), (1, 0, 17, 0, 1)],
    # a card that is one link ends the article
    [(1, 1, 5, 0, 1), (1, 0, 44, 0, 1), (1, 0, 12, 12, 0), (-1, 0, 9, 0, 0)],
    [(-1, 0, 2, 2, 0), (1, 1, 6, 0, 1), (1, 0, 25, 0, 1), (1, 0, 3, 3, 0), (-1, 0, 12, 4, 0)],
    [(0, 0, 1, 1, 0), (0, 0, 4, 4, 0), (0, 1, 4, 0, 1), (0, 0, 3, 0, 1), (0, 0, 45, 9, 1), (0, 0, 26, 7, 1), (0, 0, 41, 0, 1)],
    [(0, 0, 3, 3, 0), (0, 1, 2, 0, 1), (0, 0, 24, 0, 1), (0, 1, 4, 0, 1), (0, 0, 15, 4, 1), (0, 0, 6, 6, 0), (0, 0, 2, 2, 0), (0, 0, 4, 0, 0)],
    # the last paragraph has links
    [(0, 0, 2, 2, 0), (0, 1, 6, 0, 1), (0, 0, 31, 0, 1), (0, 0, 40, 8, 1)],
    [(0, 1, 5, 0, 1), (0, 0, 19, 4, 1), (0, 0, 27, 4, 1)],
    [(0, 0, 3, 3, 0), (0, 1, 4, 0, 1), (0, 0, 24, 5, 1), (0, 0, 2, 2, 0), (0, 0, 3, 3, 0)],
    [(1, 1, 7, 0, 1), (1, 0, 22, 0, 1), (1, 0, 30, 6, 1)],
    # no marks at all: one paragraph, and a headline with one
    [(0, 0, 21, 0, 1)],
    [(0, 0, 3, 0, 1)],
    [(0, 1, 6, 0, 1), (0, 0, 11, 0, 1)],
    [(0, 0, 1, 1, 0), (0, 0, 3, 3, 0), (0, 0, 11, 0, 1)],
    # no article element: cards behind the text, each a heading over a linked teaser
    [(0, 0, 2, 2, 0), (0, 1, 7, 0, 1), (0, 0, 51, 2, 1), (0, 0, 37, 0, 1), (0, 1, 2, 0, 0), (0, 0, 9, 9, 0), (0, 0, 12, 12, 0),
     (0, 1, 1, 0, 0), (0, 0, 6, 6, 0), (0, 0, 7, 7, 0), (0, 0, 5, 1, 0)],
    # no article element, a notice and a form marked by name
    [(-1, 0, 28, 2, 0), (-1, 0, 3, 3, 0), (0, 1, 9, 0, 1), (0, 0, 70, 0, 1), (0, 0, 58, 0, 1), (-1, 0, 12, 0, 0), (0, 0, 82, 2, 1),
     (0, 0, 3, 3, 0), (0, 0, 4, 4, 0), (-1, 0, 20, 0, 0), (-1, 0, 6, 0, 0)],
    # a page of links
    [(0, 0, 4, 4, 0), (0, 0, 3, 3, 0), (0, 0, 10, 9, 0), (0, 0, 30, 28, 0), (0, 0, 25, 24, 0), (0, 0, 2, 2, 0)],
]
FEATURES = ("links", "place", "place behind", "links before", "links behind", "heading", "words", "words before", "words behind")
MAX_DEPTH = 8
SCALES = (0.7, 1.0, 1.5)


@dataclass
class Block:
    text: str
    place: int
    heading: int
    linked: int


#: How an element stands outside: by its name or as a form, so that an article or main element inside may be the page's;
#: by a name of what repeats on a page, so that a main element inside may be; or for certain.
BY_NAME, REPEATING, CERTAIN = 1, 2, 3
ARTICLE_IN_NAMED = 2  # a place until the page's end: inside the article if the page has no other, outside otherwise
NAMED, NAMED_REPEATING = -2, -3  # the places inside an element that is outside by its name only


def _by_name(value: str, in_article: bool) -> int:
    """What the words of a class or id say of an element."""
    found = 0
    for name in value.split():
        parts = [p for p in re.split(r"[^a-z0-9]+", name) if p]
        words = OUTSIDE_WORDS.intersection(parts)
        if words and (in_article or not HEADLINE_OF.isdisjoint(parts)):
            words -= {"header"}
        if words and BESIDE_WORDS.isdisjoint(parts):
            repeating = len(parts) == 1 and not words.isdisjoint(REPEATING_WORDS)
            found = max(found, REPEATING if repeating else BY_NAME)
    return found


def _outside(tag: str, attributes: str, in_article: bool = False) -> int:
    """How an element stands outside; inside an article the id of a heading, section or paragraph is a mark to jump to."""
    found = 0 if tag not in OUTSIDE_TAGS else BY_NAME if tag == "form" else CERTAIN
    if found == CERTAIN or not attributes or attributes.isspace():
        return found
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
        if name in ("class", "id"):
            named = _by_name(value, in_article)
            if named != BY_NAME or name == "class" or not in_article or tag not in JUMPED_TO:
                found = max(found, named)
        if name == "role" and value in OUTSIDE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return CERTAIN
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return CERTAIN
    return found


def _opens_link(attributes: str) -> bool:
    """An anchor with a target that is not closed at once; a slash may also end a bare target."""
    if attributes.endswith("/"):
        *rest, last = attributes[:-1].rsplit(None, 1) or [""]
        bare = "=" in last[:-1] or bool(rest) and rest[0].rstrip().endswith("=")
        if not bare or '"' in last or "'" in last or attributes[-2:-1].isspace():
            return False
    return any(name.lower() == "href" for name, *_ in ATTRIBUTE.findall(attributes))


def _next_tag(html: str, at: int, lost: set[str]) -> tuple[int, int, str, bool, str] | None:
    """(start, end, name, closing, attributes) of the next tag; comments and declarations have an empty name.

    A quote counts behind an equals sign only, and only if it is closed.  Once a tag finds no end outside quotes, quotes no
    longer count on the page.  ``lost`` keeps the quotes that have no partner ahead, and ``>`` in that last case, so the
    work grows with the page's length whatever is in it.
    """
    found = OPENING.search(html, at)
    if not found:
        return None
    end = 0
    if found[2] is None and html.startswith("<!--", found.start()):
        end = html.find("-->", found.end()) + 3
        end = end if end > 2 else len(html)
    elif found[2] and ">" not in lost:
        here = found.end()
        while mark := END_OR_QUOTE.search(html, here):
            here = mark.end()
            if not mark[1]:
                end = here
                break
            if mark[1] not in lost:
                close = html.find(mark[1], here)
                here = close + 1 if close >= 0 else here
                if close < 0:
                    lost.add(mark[1])
        if not end:
            lost.add(">")
    end = end or html.find(">", found.end()) + 1
    if not end:
        return None
    return found.start(), end, (found[2] or "").lower(), bool(found[1]), html[found.end() : end - 1]


def _decoded(text: str) -> str:
    """Character references resolved; numbers beyond all characters give U+FFFD however long they are."""
    if "&#" in text:
        text = LONG_NUMBER.sub(lambda m: "&#" if m[1] is None else "\ufffd", text)
    return entities.unescape(text)


def blocks_of(html: str) -> list[Block]:
    """The page's flat blocks in order, references decoded and white space folded."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open containers with the place inside them
    parts: list[tuple[str, bool]] = []
    heading, own, in_link = 0, False, False  # own: the block's own tag stands outside the article
    unclosed = False  # the open link has no end of its own, so it ends with its block

    def flush() -> None:
        words = linked = 0
        if parts:
            text = " ".join(_decoded("".join(p for p, _ in parts)).split())
            if text:
                words = text.count(" ") + 1
                linked = min(words, sum(len(p.split()) for p, link in parts if link))
                out.append(Block(text, -1 if own else stack[-1][1] if stack else 0, heading, linked))
            parts.clear()

    at, size = 0, len(html)
    lost: set[str] = set()
    unended: set[str] = set()  # raw elements that have no end from here on
    depths: Counter[str] = Counter()  # open containers by tag
    while found := _next_tag(html, at, lost):
        start, end, tag, closing, attributes = found
        if start > at:
            parts.append((html[at:start], in_link))
        at = end
        if tag in RAW and not closing:
            if tag != "option" and not attributes.rstrip().endswith("/"):
                close = None if tag in unended else re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                if not close and tag not in unended:
                    unended.add(tag)
                    close = re.compile(r"(?=<body)", re.IGNORECASE).search(html, at) if tag == "head" else None
                at = close.end() if close else size if tag in ("script", "style") else at
            continue
        if tag == "a":
            in_link = not closing and _opens_link(attributes)
            following = ANCHOR.search(html, at) if in_link else None
            unclosed = in_link and not (following and following[1])
        if tag == "br":
            parts.append((" ", False))
        if tag not in BLOCKS:
            continue
        flush()
        in_link = in_link and not unclosed
        heading, own = int(tag in HEADINGS and not closing), False
        if tag in CONTAINERS:
            if closing:
                while depths[tag]:
                    last, _ = stack.pop()
                    depths[last] -= 1
                    if last == tag:
                        break
            elif not attributes.endswith("/"):
                place = stack[-1][1] if stack else 0
                marked = 0 if tag in ("html", "body") else _outside(tag, attributes, place > 0)
                if place == -1 or marked == CERTAIN or tag == "header" and place == 0:
                    place = -1
                elif marked == REPEATING or place == NAMED_REPEATING and tag != "main":
                    place = NAMED_REPEATING
                elif marked:
                    place = NAMED
                elif tag in ("article", "main"):
                    place = 1 if place in (0, 1) else ARTICLE_IN_NAMED
                stack.append((tag, place))
                depths[tag] += 1
        elif not closing:
            own = bool(_outside(tag, attributes, bool(stack) and stack[-1][1] > 0))
    if at < size:
        parts.append((html[at:], in_link))
    flush()
    inside = any(b.place == 1 for b in out)
    for block in out:
        block.place = max(block.place, -1) if block.place != ARTICLE_IN_NAMED else -1 if inside else 1
    return out


def _features(figures: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Rows of FEATURES from (place, heading, words, linked words) of a page's blocks."""
    place, heading, words, linked = np.array(figures, float).reshape(-1, 4).T
    links = linked / np.maximum(words, 1)
    before, behind = (lambda x: np.concatenate(([0], x[:-1]))), (lambda x: np.concatenate((x[1:], [0])))
    return np.column_stack(
        (links, place, behind(place), before(links), behind(links), heading, words, before(words), behind(words))
    )


@dataclass
class Tree:
    """A node: rows with ``feature`` at most ``limit`` go left; a leaf has a ``label``."""

    label: int
    feature: int = -1
    limit: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(rows), self.label)
        low = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), int)
        out[low], out[~low] = self.left.predict(rows[low]), self.right.predict(rows[~low])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = MAX_DEPTH) -> Tree:
    """A binary tree by least Gini impurity; ties go to the earlier feature and the smaller limit."""
    tree = Tree(int(labels.mean() >= 0.5))
    if depth == 0 or len(set(labels.tolist())) == 1:
        return tree
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= limit
            impurity = sum(own.sum() * (own.size - own.sum()) / own.size for own in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(limit)
    if best is None:
        return tree
    low = rows[:, best[1]] <= best[2]
    tree.feature, tree.limit = best[1], best[2]
    tree.left, tree.right = grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)
    return tree


def trained(labelled: list[list[tuple[int, int, int, int, int]]] = LABELLED) -> Tree:
    """The tree grown on the labelled table, each page also with its words scaled, so that no exact count decides."""
    rows, labels = [], []
    for page in labelled:
        for scale in SCALES:
            words = [max(1, round(b[2] * scale)) for b in page]
            rows.append(_features([(b[0], b[1], n, round(n * b[3] / b[2])) for b, n in zip(page, words, strict=True)]))
            labels += [b[4] for b in page]
    return grow(np.concatenate(rows), np.array(labels))


def main_text(html: str | None, tree: Tree) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    rows = _features([(b.place, b.heading, b.text.count(" ") + 1, b.linked) for b in blocks])
    return "\n".join(b.text for b, keep in zip(blocks, tree.predict(rows), strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", column: str = "text", tree: Tree | None = None) -> DataFrame:
    """``pages`` with the main text in ``column``, in place of a column of that name.

    A null, empty or contentless page gives an empty text.  Rows are taken one by one, so repeated pages give equal rows,
    other columns pass unchanged, and an empty table gives none.  The work for a page grows with its length.
    """
    tree = tree or trained()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, tree) for page in batch], dtype=object)

    return pages.withColumn(column, text(F.col(html)))
