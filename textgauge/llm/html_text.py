"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. A block is described by its number of words,
the share of them inside links, the same for the blocks before and after it, and by what encloses
it: an element or class that names page furniture, one that names content, a heading, a list item. A
decision tree over these numbers, grown from the table LABELLED below, says which blocks are main
text. The densities of the neighbours tell a paragraph that is one link, which stays, from one of a list of links, and blocks
without any neighbour are the page's text. An <article> or <main> inside an element that is named like furniture, but is no remark, advert, list of
related pages, or nav, footer, aside, menu or dialog, is no furniture. Nor is a form, div or section with a
name of the layout that holds nearly all words of the page outside links. Enclosing elements are features because words and links alone cannot tell an advert of one sentence from a
paragraph of one sentence.

Character references are decoded, white space inside a block becomes one space, and the blocks kept are
joined in page order by an empty line. Scripts, styles, comments and the texts of controls are no blocks.
Markup may be cut off, unclosed or wrongly nested: an unclosed script, style, title, text area or frame lasts to the end of
the page, as in a browser, any other control or drawing to the next block. Null html counts as empty and gives an empty
text. Repeated rows and rows with a null id are extracted alike. An empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.llm.common import slices

# A comment, a declaration, or a tag; quoted values may hold ">". A tag cut off by the end counts.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
# "has-sidebar" or "page-with-sidebar" names what is beside, not what is inside.
_BESIDE = re.compile(r"\b(?:[\w-]*[-_])?(?:has|with|without|no)[-_]+\w+", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# HTML elements by their part in the layout.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter "
    "nobr output progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template title textarea select button svg math iframe object canvas audio video datalist".split()
)
# Elements whose content is raw text up to their end tag.
RAW = frozenset("script style title textarea iframe".split())
FURNITURE = frozenset("nav footer aside form header menu dialog".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside rail widget widgets footer header masthead topbar toolbar cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login "
    "register search form share sharing social related recommended recommendations trending popular comment "
    "comments reply replies respond responses discussion disqus pagination pager tags copyright legal disclaimer skip "
    "contentinfo complementary dialog author byline".split()
)
REMARKS = frozenset("comment comments reply replies respond responses discussion disqus".split())
# Furniture with all that is inside, articles too.
FIRM = frozenset("nav footer aside menu dialog".split())
FIRM_NAMES = REMARKS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion related recommended "
    "recommendations trending popular".split()
)
# What may enclose a whole page: elements, and names of the layout.
WRAPPERS = frozenset("form div section".split())
LAYOUT_NAMES = frozenset("sidebar rail widget widgets header masthead topbar toolbar nav navbar navigation menu banner form".split())
# Share of the words of a page outside links.
WHOLE_PAGE = 0.75
CONTENT_NAMES = frozenset("article content main post entry story body text".split())
# A name that ends so names an article, whatever it is about: "comment-policy-article".
ARTICLE_NAMES = frozenset("article story".split())
BLOCK_TAGS = (
    "p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li dl table form blockquote pre figure hr "
    "body html"
).split()

_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in SKIPPED}
_OPENS = {name: re.compile(rf"<{name}\b", re.I) for name in SKIPPED}
_NEXT_BLOCK = re.compile(rf"</?(?:{'|'.join(BLOCK_TAGS)})\b", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    content: bool
    heading: bool
    item: bool


def _names_article(name: str) -> bool:
    parts = [p.lower() for p in _PARTS.findall(name)]
    return len(parts) > 1 and parts[-1] in ARTICLE_NAMES


def _skipped_to(page: str, name: str, at: int) -> int:
    """Where an element without text of the page ends that was opened before `at`."""
    end = _ENDS[name].search(page, at)
    if name in RAW:
        return end.end() if end else len(page)
    # One that is opened again before it ends was not closed; nor was one without an end.
    again = _OPENS[name].search(page, at)
    if end and not (again and again.start() < end.start() and name not in ("svg", "object")):
        return end.end()
    block = _NEXT_BLOCK.search(page, at)
    return block.start() if block else len(page)


def _kind(name: str, rest: str, within: bool) -> tuple[bool, bool, bool, bool]:
    """If an element is furniture, is content, is furniture with all inside, and may enclose a page.

    By its own name, class, id and role.

    A header within content is neither: it holds the headline.
    """
    parts, own = set(), set()
    if "=" in rest:
        for found in _NAMES.findall(rest):
            names = " ".join(n for n in " ".join(found).split() if not _names_article(n))
            parts.update(p.lower() for p in _PARTS.findall(names))
            own.update(p.lower() for p in _PARTS.findall(_BESIDE.sub(" ", names)))
        if any(_names_article(n) for found in _NAMES.findall(rest) for n in " ".join(found).split()):
            parts.add("article")
    if name in CONTENT:
        remark = not parts.isdisjoint(REMARKS)
        return remark, not remark, remark, False
    furniture, content = not parts.isdisjoint(FURNITURE_NAMES), not parts.isdisjoint(CONTENT_NAMES)
    firm = name in FIRM or not own.isdisjoint(FIRM_NAMES)
    wraps = name in WRAPPERS and not firm and own & FURNITURE_NAMES <= LAYOUT_NAMES
    if name in FURNITURE and (name != "header" or not within):
        return True, False, firm, wraps
    # A name such as "content-with-sidebar" says neither.
    named = not own.isdisjoint(FURNITURE_NAMES) and (not content or not own.isdisjoint(REMARKS))
    return named, content and not furniture, named and firm, wraps


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in page order."""
    found: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    open_elements: list[tuple[str, bool, bool, bool, bool, int]] = []
    # For each block, the furniture around it: elements by number, -1 for what cannot enclose a page.
    around: list[set[int]] = []
    opened = 0
    state = {"link": False, "heading": False, "item": False}

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(references.unescape("".join(t for t, _ in pieces)).split())
        if text:
            linked = sum(len(references.unescape(t).split()) for t, link in pieces if link)
            found.append(
                Block(
                    text,
                    text.count(" ") + 1,
                    linked,
                    False,
                    any(e[2] for e in open_elements),
                    state["heading"],
                    state["item"],
                )
            )
            marks = {-1} if any(e[3] for e in open_elements) else set()
            for element, furniture, content, _, wraps, number in reversed(open_elements):
                if element in CONTENT and content:
                    break
                if furniture:
                    marks.add(number if wraps else -1)
            around.append(marks)
        pieces.clear()

    at = 0
    while at < len(page):
        tag = _MARKUP.search(page, at)
        if tag is None:
            pieces.append((page[at:], state["link"]))
            break
        if tag.start() > at:
            pieces.append((page[at : tag.start()], state["link"]))
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        closes = bool(tag["close"] or tag["close2"])
        rest = tag["rest"] or tag["rest2"] or ""
        if not name:
            continue
        if name in SKIPPED:
            if not closes and not rest.endswith("/"):
                at = _skipped_to(page, name, at)
            continue
        if name in INLINE:
            if name == "a":
                state["link"] = not closes
            elif name in ("br", "img", "input"):
                pieces.append((" ", state["link"]))
            continue
        flush()
        state["link"] = False
        if name in HEADINGS:
            state["heading"] = not closes
        elif name == "li":
            state["item"] = not closes
        elif name in ("p", "div", "section", "ul", "ol", "table"):
            state["heading"] = False
        if name in VOID or name in HEADINGS or name in ("p", "li", "html", "body", "head"):
            continue
        if not closes:
            if not rest.endswith("/"):
                opened += 1
                open_elements.append((name, *_kind(name, rest, any(e[2] for e in open_elements)), opened))
        else:
            for depth in range(len(open_elements) - 1, -1, -1):
                if open_elements[depth][0] == name:
                    del open_elements[depth:]
                    break
    flush()
    held: dict[int, int] = {}
    for block, marks in zip(found, around):
        for number in marks:
            held[number] = held.get(number, 0) + block.words - block.linked
    most = WHOLE_PAGE * sum(b.words - b.linked for b in found)
    # Where an article is marked as such outside of an element, that element does not enclose the page.
    outside = [marks for block, marks in zip(found, around) if block.content and -1 not in marks]
    for block, marks in zip(found, around):
        block.furniture = any(n < 0 or held[n] <= most or any(n not in m for m in outside) for n in marks)
    return found


def described(found: list[Block]) -> list[tuple[float, ...]]:
    """The features of each block, its neighbours' among them."""
    density = [b.linked / b.words for b in found]
    none = (0, 0.0)
    sides = [none, *((b.words, d) for b, d in zip(found, density)), none]
    return [
        (b.words, density[i], *sides[i], *sides[i + 2], b.furniture, b.content, b.heading, b.item)
        for i, b in enumerate(found)
    ]


# words, link density, words and link density of the block before, of the block after, inside furniture,
# inside content, heading, list item: main text or not. Blocks of made-up pages, labelled by hand.
LABELLED = [
    # Paragraphs, headings and lists of articles marked as such: long, short, first, last, among links.
    ((80, 0.00, 60, 0.00, 90, 0.00, 0, 1, 0, 0), 1),
    ((45, 0.04, 9, 0.00, 70, 0.05, 0, 1, 0, 0), 1),
    ((120, 0.02, 7, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((3, 0.00, 40, 0.00, 55, 0.00, 0, 1, 0, 0), 1),
    ((1, 0.00, 3, 1.00, 2, 1.00, 0, 1, 0, 0), 1),
    ((2, 0.00, 1, 0.00, 1, 0.00, 0, 1, 0, 0), 1),
    ((14, 0.00, 0, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((25, 0.40, 60, 0.00, 4, 1.00, 0, 1, 0, 0), 1),
    ((6, 0.33, 14, 0.00, 8, 0.00, 0, 1, 0, 0), 1),
    # Short ones beside short ones, as small print has them outside of articles.
    ((1, 0.00, 6, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((1, 0.00, 5, 0.00, 3, 0.00, 0, 1, 0, 0), 1),
    ((2, 0.00, 4, 0.00, 9, 0.00, 0, 1, 0, 0), 1),
    ((3, 0.00, 80, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((6, 0.00, 5, 0.00, 9, 0.00, 0, 1, 0, 0), 1),
    ((9, 0.00, 3, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((4, 0.00, 0, 0.00, 2, 1.00, 0, 1, 0, 0), 1),
    ((5, 0.40, 3, 1.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((7, 0.00, 5, 0.00, 6, 0.50, 0, 1, 0, 1), 1),
    ((6, 0.00, 4, 1.00, 3, 1.00, 0, 1, 0, 0), 1),
    ((25, 0.00, 5, 0.00, 6, 0.00, 0, 1, 0, 0), 1),
    ((18, 0.00, 12, 0.00, 8, 0.00, 0, 1, 0, 0), 1),
    ((40, 0.00, 2, 0.00, 3, 0.00, 0, 1, 0, 0), 1),
    ((3, 0.00, 2, 1.00, 4, 1.00, 0, 1, 1, 0), 1),
    # Paragraphs that are mostly or wholly one link, between paragraphs that are not.
    ((20, 0.80, 60, 0.00, 50, 0.00, 0, 1, 0, 0), 1),
    ((9, 1.00, 35, 0.05, 44, 0.00, 0, 1, 0, 0), 1),
    ((4, 1.00, 50, 0.00, 25, 0.00, 0, 1, 0, 1), 1),
    ((30, 0.70, 12, 0.00, 8, 0.10, 0, 1, 0, 0), 1),
    ((6, 1.00, 9, 0.00, 30, 0.00, 0, 1, 1, 0), 1),
    ((7, 1.00, 40, 0.00, 0, 0.00, 0, 1, 0, 0), 1),
    ((2, 1.00, 30, 0.00, 80, 0.00, 0, 1, 0, 0), 1),
    ((12, 0.90, 100, 0.00, 3, 0.00, 0, 1, 0, 0), 1),
    ((3, 1.00, 5, 0.00, 4, 0.00, 0, 1, 0, 0), 1),
    ((15, 0.65, 0, 0.00, 70, 0.00, 0, 1, 0, 0), 1),
    ((8, 0.00, 12, 1.00, 80, 0.00, 0, 1, 1, 0), 1),
    ((5, 0.00, 0, 0.00, 2, 0.00, 0, 1, 1, 0), 1),
    ((6, 0.00, 30, 0.00, 7, 1.00, 0, 1, 0, 1), 1),
    ((12, 0.10, 6, 0.00, 9, 0.00, 0, 1, 0, 1), 1),
    # Articles without marks: texts with few links, and what lies between them.
    ((75, 0.00, 8, 1.00, 60, 0.00, 0, 0, 0, 0), 1),
    ((40, 0.05, 5, 1.00, 6, 1.00, 0, 0, 0, 0), 1),
    ((130, 0.10, 0, 0.00, 0, 0.00, 0, 0, 0, 0), 1),
    ((22, 0.20, 50, 0.00, 2, 1.00, 0, 0, 0, 0), 1),
    ((18, 0.00, 25, 0.00, 20, 0.00, 0, 0, 0, 0), 1),
    ((5, 0.00, 60, 0.00, 45, 0.00, 0, 0, 0, 0), 1),
    ((2, 0.00, 35, 0.00, 40, 0.00, 0, 0, 0, 0), 1),
    ((7, 0.00, 30, 0.00, 65, 0.00, 0, 0, 1, 0), 1),
    ((4, 0.00, 22, 0.00, 28, 0.00, 0, 0, 1, 0), 1),
    ((10, 0.00, 26, 0.00, 24, 0.00, 0, 0, 0, 1), 1),
    ((9, 0.00, 3, 1.00, 65, 0.00, 0, 0, 1, 0), 1),
    # All that there is on a page.
    ((1, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0), 1),
    ((2, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0), 1),
    ((12, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0), 1),
    ((5, 0.20, 0, 0.00, 0, 0.00, 0, 0, 0, 0), 1),
    ((4, 0.00, 0, 0.00, 0, 0.00, 0, 0, 1, 0), 1),
    ((8, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 1), 1),
    # Menus, link lists and paths without marks, also inside articles.
    ((1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0, 1), 0),
    ((3, 1.00, 40, 0.00, 60, 0.00, 0, 0, 0, 1), 0),
    ((2, 1.00, 0, 0.00, 70, 0.00, 0, 0, 0, 0), 0),
    ((30, 0.95, 60, 0.00, 80, 0.00, 0, 0, 0, 0), 0),
    ((12, 0.80, 40, 0.00, 10, 0.85, 0, 0, 0, 0), 0),
    ((4, 0.75, 3, 1.00, 30, 0.00, 0, 0, 0, 0), 0),
    ((8, 1.00, 60, 0.00, 9, 1.00, 0, 1, 0, 1), 0),
    ((6, 1.00, 5, 1.00, 7, 1.00, 0, 1, 0, 1), 0),
    ((3, 1.00, 70, 0.00, 2, 1.00, 0, 1, 0, 0), 0),
    ((10, 0.90, 12, 0.95, 35, 0.00, 0, 1, 0, 0), 0),
    ((5, 1.00, 4, 1.00, 0, 0.00, 0, 1, 0, 0), 0),
    ((4, 1.00, 6, 0.80, 5, 1.00, 0, 1, 0, 0), 0),
    ((2, 1.00, 0, 0.00, 3, 1.00, 0, 1, 0, 0), 0),
    # Small print and captions of lists without marks.
    ((6, 0.00, 4, 1.00, 3, 1.00, 0, 0, 0, 0), 0),
    ((9, 0.00, 3, 0.00, 0, 0.00, 0, 0, 0, 0), 0),
    ((4, 0.00, 0, 0.00, 2, 1.00, 0, 0, 0, 0), 0),
    ((5, 0.40, 3, 1.00, 0, 0.00, 0, 0, 0, 0), 0),
    ((3, 0.00, 2, 1.00, 4, 1.00, 0, 0, 1, 0), 0),
    ((7, 0.00, 5, 0.00, 6, 0.50, 0, 0, 0, 1), 0),
    # Headers, footers, notices, adverts, forms, side bars and remarks of readers, marked as such.
    ((12, 0.00, 1, 1.00, 8, 0.00, 1, 0, 0, 0), 0),
    ((25, 0.00, 0, 0.00, 90, 0.00, 1, 0, 0, 0), 0),
    ((60, 0.00, 70, 0.00, 0, 0.00, 1, 0, 0, 0), 0),
    ((9, 0.10, 50, 0.00, 45, 0.00, 1, 0, 0, 0), 0),
    ((130, 0.00, 80, 0.00, 75, 0.00, 1, 1, 0, 0), 0),
    ((7, 0.00, 80, 0.00, 75, 0.00, 1, 1, 0, 0), 0),
    ((4, 0.25, 9, 0.00, 50, 0.00, 1, 1, 0, 0), 0),
    ((2, 0.00, 8, 0.00, 25, 0.00, 1, 1, 1, 0), 0),
    ((3, 0.00, 60, 0.00, 55, 0.00, 1, 0, 1, 0), 0),
    ((8, 0.00, 0, 0.00, 30, 0.00, 1, 0, 1, 0), 0),
    ((45, 0.00, 12, 0.00, 30, 0.00, 1, 0, 0, 1), 0),
    ((35, 0.00, 3, 0.50, 28, 0.00, 1, 0, 0, 0), 0),
    ((90, 0.00, 4, 0.00, 40, 0.00, 1, 1, 0, 1), 0),
    ((1, 1.00, 1, 1.00, 1, 1.00, 1, 0, 0, 1), 0),
    ((2, 1.00, 0, 0.00, 1, 1.00, 1, 0, 0, 1), 0),
    ((70, 0.00, 0, 0.00, 0, 0.00, 1, 0, 0, 0), 0),
]


def mirrored(rows: list[tuple[tuple, int]]) -> list[tuple[tuple, int]]:
    """The rows, and again with the blocks before and after exchanged."""
    return rows + [((*x[:2], *x[4:6], *x[2:4], *x[6:]), label) for x, label in rows]


def grow(rows: list[tuple[tuple, int]], depth: int = 7, least: int = 2) -> tuple | int:
    """A decision tree: a label, or (feature, threshold, tree for values up to it, tree for others)."""
    ones = sum(label for _, label in rows)
    majority = int(2 * ones >= len(rows))
    if ones in (0, len(rows)) or not depth:
        return majority
    impure = lambda part: len(part) and (k := sum(y for _, y in part)) * (len(part) - k) / len(part)
    best = None
    for feature in range(len(rows[0][0])):
        values = sorted({x[feature] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[0][feature] <= cut], [r for r in rows if r[0][feature] > cut]
            if min(len(low), len(high)) < least:
                continue
            worth = impure(low) + impure(high)
            if best is None or worth < best[0] - 1e-12:
                best = (worth, feature, cut, low, high)
    if best is None:
        return majority
    _, feature, cut, low, high = best
    return feature, cut, grow(low, depth - 1), grow(high, depth - 1)


def says(tree: tuple | int, x: tuple[float, ...]) -> int:
    while not isinstance(tree, int):
        feature, cut, low, high = tree
        tree = low if x[feature] <= cut else high
    return tree


TREE = grow(mirrored(LABELLED))


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, x in zip(found, described(found)) if says(TREE, x))


def text_of(html: Column) -> Column:
    """The main text of a page, as a column."""

    @F.arrow_udf(T.StringType())
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page) for some in slices(pages) for page in some], pa.string())

    return extract(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its code points, for every page."""
    found = pages.select("page_id", "url", text_of(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
