"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of blocks, cut wherever markup starts a new line. A block is described by its
word count and link density, those of the block before and after it, the length of the run of links it is
in, its element and where it stands; a tree trained on the small table below decides which blocks are the
article. In a marked article that leaves links in prose and paragraphs that are links; only lists of three
links or more are menus. On pages that mark nothing, the neighbours tell a menu from a link in the text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm.common import map_texts

# Fixed values of HTML and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: content that is no text of the page
RAW = frozenset("script style template textarea title iframe noembed noframes svg math object select noscript".split())
#: these begin and end a block
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
#: these never hold the article
ASIDE = frozenset("nav footer aside form dialog menu button label head fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
_PART = (
    r"(?:ads?|advert[a-z]*+|adsense|sponsor[a-z]*+|promo[a-z]*+|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|"
    r"footer|masthead|topbar|toolbar|share|sharing|social|related|recommended|comments?|commentlist|disqus|replies|reply|respond|"
    r"cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|"
    r"pagination|pager|widget|skip|copyright|legal|disclaimer|tags|author-bio|byline-links)")
#: words that place such a part, and words for the box or the items it consists of
_PLACE = (r"(?:site|page|main|post|entry|article|blog|global|top|bottom|left|right|primary|secondary|inner|outer|mobile|desktop|sticky|"
          r"fixed|floating|js|wp|block|section|user|email|mail|google|breaking|privacy)")
_BOX = (r"(?:content|wrap|wrapper|container|box|area|block|list|inner|outer|section|links?|bar|items?|form|buttons?|icons?|text|title|"
        r"heading|body|panel|column|col|group|posts?|articles?|stories|unit|slot|policy|message|bottom|left|right|top|primary|secondary|"
        r"main|\d++)")
#: whole words of class or id that name such a part; category-social, tag-search or has-sidebar say something about the article
PARTS = re.compile(rf"(?:^|(?<=\s))(?:{_PLACE}[_-]+)*{_PART}(?:[_-]+(?:{_PART}|{_BOX}))*(?=\s|$)", re.I)
HEAD = re.compile(r"(?:^|(?<=\s))(?:(?:site|page|main|top|global)[_-]+)?header(?=\s|$)", re.I)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_SKIP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
#: a tag at the end of a page that was cut off
_CUT = re.compile(r"</?[a-zA-Z][^\s<>]*\Z")
_NAMES = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
#: the element that holds a block: 2 for running text, 1 for items and cells, 0 for a box
KINDS = {**dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption address".split(), 2), **dict.fromkeys("li dt dd td th".split(), 1)}
#: a block with a greater share of linked words counts as a link
LINKED = 0.5
#: so many links in a row make a menu of a list within an article
MENU = 3
#: how surely a block is no article: by class or id, or by the element, its role or being hidden
NAMED, SURE = 1, 2


@dataclass
class Block:
    text: str
    words: int
    linked: int
    aside: bool
    main: bool
    #: in an article within a part that only its class or id calls no article
    held: bool = False
    kind: int = 0

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _aside(tag: str, attributes: str, in_main: bool) -> int:
    if tag in ASIDE or (tag == "header" and not in_main):
        return SURE
    if tag in ("html", "body") or not attributes:
        return 0
    named = 0
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and tag not in ("article", "main") and (
                PARTS.search(value) or (not in_main and HEAD.search(value))):
            named = NAMED
        if (name == "role" and value.lower() in ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return SURE
    return named


def _is_main(tag: str, attributes: str) -> bool:
    return tag == "main" or any(n.lower() == "role" and v.strip("\"'").lower() == "main" for n, v in _NAMES.findall(attributes or ""))


def blocks(page: str | None) -> list[Block]:
    """The non-empty text blocks in page order, white space collapsed, character references decoded.

    Class and id never make ``main`` an aside, nor what contains it, nor ``article``. An article within such a part,
    as comments may be, counts where the page has no other one.
    """
    page = page or ""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool, bool, int]] = []
    state = [0, False, False, 0]
    link, at, end = False, 0, len(page)

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, len(text.split()), len(" ".join(linked).split()), state[0] > 0, *state[1:]))
        parts.clear()
        linked.clear()

    def pop(to: int) -> None:
        del stack[to:]
        state[:] = stack[-1][1:] if stack else (0, False, False, 0)

    while at < end:
        cut = page.find("<", at)
        cut = end if cut < 0 else cut
        if cut > at:
            text = page[at:cut]
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if link:
                linked.append(text)
        if cut == end:
            break
        tag = _TAG.match(page, cut)
        if not tag:
            skip = _SKIP.match(page, cut)
            if skip:
                at = skip.end()
            elif _CUT.match(page, cut):
                at = end
            else:  # a lone "<" is text
                parts.append("<")
                at = cut + 1
            continue
        at = tag.end()
        closes, name, attributes = tag.group(1, 2, 3) if tag[2] else tag.group(4, 5, 6)
        name = name.lower()
        if name in BLOCKS:
            flush()
            if not closes and stack and stack[-1][0] == "p":
                pop(len(stack) - 1)
        elif name == "br":
            parts.append(" ")
        if name == "a":
            link = not closes
        if closes:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1] != (stack[k - 1][1] if k else 0):
                        flush()
                    pop(k)
                    break
        elif name in RAW:
            if not attributes.rstrip().endswith("/") or name not in ("svg", "math"):
                close = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
        elif name not in VOID:
            own = _aside(name, attributes, state[1] or state[2])
            if name in BLOCKS or own > state[0]:
                if own > state[0]:
                    flush()
                if name == "li" and stack and stack[-1][0] == "li":
                    pop(len(stack) - 1)
                    own = _aside(name, attributes, state[1] or state[2])
                aside, main, held, kind = max(state[0], own), *state[1:]
                kind = KINDS.get(name, 0) if name in BLOCKS else kind
                if name in ("article", "main") or "role" in attributes.lower():
                    is_main = _is_main(name, attributes)
                    if aside < SURE and is_main:
                        aside, main = (aside if main else 0), True
                    elif name == "article" and not main and not held:
                        main, held = not aside, aside == NAMED
                        aside = 0 if held else aside
                stack.append((name, aside, main, held, kind))
                state[:] = (aside, main, held, kind)
    flush()
    marked = any(b.main for b in out)
    for block in out:
        if block.held and not block.main:
            block.main, block.aside = not marked, block.aside or marked
    return out


FEATURES = ("words", "density", "words before", "density before", "words after", "density after", "aside", "place", "kind", "run")
#: The training table: pages, each a list of blocks with words, density, kind, aside, place and whether it is article. What is
#: before, after and the run come from the blocks next to it. kind: see KINDS. place: 2 in the page's article, 1 on a page
#: that marks none, 0 outside of it.
LABELLED = (
    # marked articles between menus, headers, footers, adverts and notices; links in their prose, and paragraphs that are links
    ((1, 1.0, 1, 1, 0, 0), (2, 1.0, 1, 1, 0, 0), (1, 1.0, 1, 1, 0, 0), (9, 0.0, 0, 1, 0, 0), (8, 0.0, 2, 0, 2, 1), (60, 0.0, 2, 0, 2, 1),
     (3, 1.0, 2, 0, 2, 1), (45, 0.2, 2, 0, 2, 1), (12, 0.6, 2, 0, 2, 1), (2, 0.0, 2, 0, 2, 1), (60, 0.0, 0, 1, 2, 0), (11, 0.1, 0, 1, 0, 0)),
    ((40, 0.0, 0, 0, 0, 0), (2, 0.0, 2, 0, 0, 0), (12, 0.0, 2, 0, 2, 1), (2, 1.0, 2, 0, 2, 1), (3, 1.0, 2, 0, 2, 1), (4, 1.0, 2, 0, 2, 1),
     (1, 0.0, 2, 0, 2, 1), (5, 0.4, 1, 0, 2, 1), (3, 0.0, 1, 0, 2, 1), (200, 0.1, 0, 0, 2, 1), (2, 0.0, 0, 0, 2, 1), (70, 0.0, 2, 0, 0, 0)),
    ((5, 1.0, 2, 0, 2, 1), (35, 0.0, 2, 0, 2, 1), (2, 1.0, 1, 0, 2, 1), (3, 1.0, 1, 0, 2, 1), (20, 0.0, 2, 0, 2, 1), (1, 1.0, 0, 0, 2, 1),
     (6, 0.0, 1, 0, 2, 1), (4, 0.9, 2, 0, 2, 1), (4, 1.0, 2, 0, 0, 0)),
    ((2, 1.0, 1, 1, 0, 0), (4, 0.0, 0, 0, 2, 1), (60, 0.0, 2, 0, 2, 1)), ((1, 1.0, 0, 0, 0, 0), (1, 0.0, 0, 0, 2, 1), (30, 0.0, 0, 0, 2, 1)),
    ((1, 0.0, 2, 0, 2, 1),), ((4, 1.0, 2, 0, 2, 1),), ((2, 0.0, 0, 0, 2, 1), (1, 0.0, 0, 0, 2, 1)),
    # what stands outside of a marked article, whatever it looks like
    ((90, 0.0, 2, 0, 0, 0), (150, 0.1, 0, 0, 0, 0), (2, 0.0, 0, 0, 0, 0), (10, 0.0, 1, 0, 0, 0), (30, 0.0, 0, 0, 2, 1), (50, 0.0, 0, 0, 0, 0),
     (5, 0.5, 2, 0, 0, 0), (4, 1.0, 2, 0, 0, 0), (25, 0.0, 0, 0, 0, 0), (60, 0.0, 2, 0, 0, 0), (1, 0.0, 0, 0, 0, 0), (1, 1.0, 0, 0, 0, 0),
     (200, 0.0, 0, 0, 0, 0), (8, 0.3, 1, 0, 0, 0)),
    # runs of links in a marked article that stand in a list or a bare box: menus within it
    ((50, 0.0, 2, 0, 2, 1), (4, 1.0, 1, 0, 2, 0), (3, 1.0, 1, 0, 2, 0), (5, 1.0, 1, 0, 2, 0), (7, 0.9, 1, 0, 2, 0), (40, 0.0, 2, 0, 2, 1)),
    ((2, 1.0, 0, 0, 2, 0), (2, 1.0, 0, 0, 2, 0), (3, 1.0, 0, 0, 2, 0), (90, 0.0, 2, 0, 2, 1), (6, 0.0, 2, 0, 2, 1)),
    # what says that it is no article, on a page that marks none
    ((3, 0.0, 2, 1, 1, 0), (120, 0.0, 2, 1, 1, 0), (80, 0.1, 0, 1, 1, 0), (25, 0.0, 2, 0, 1, 1), (15, 0.0, 1, 1, 1, 0), (30, 0.0, 2, 1, 1, 0)),
    # pages that mark nothing: a menu, a line between it and the heading, the article, a line at the foot
    ((1, 1.0, 1, 0, 1, 0), (2, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (9, 0.0, 0, 0, 1, 0), (8, 0.0, 2, 0, 1, 1),
     (60, 0.0, 2, 0, 1, 1), (3, 1.0, 2, 0, 1, 1), (45, 0.1, 2, 0, 1, 1), (4, 0.0, 2, 0, 1, 1), (12, 0.0, 0, 0, 1, 0)),
    ((2, 0.0, 0, 0, 1, 0), (1, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0), (14, 0.0, 0, 0, 1, 0), (3, 0.0, 2, 0, 1, 1),
     (90, 0.2, 2, 0, 1, 1), (18, 0.0, 2, 0, 1, 1), (5, 0.0, 0, 0, 1, 0)),
    ((3, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (4, 1.0, 1, 0, 1, 0), (15, 0.0, 2, 0, 1, 1), (25, 0.0, 2, 0, 1, 1), (9, 0.0, 2, 0, 1, 1),
     (30, 0.0, 2, 0, 1, 1), (8, 0.0, 0, 0, 1, 0)),
    # a block of links between two long texts is text, among links it is a menu, whatever its element
    ((70, 0.0, 2, 0, 1, 1), (5, 1.0, 0, 0, 1, 1), (50, 0.0, 2, 0, 1, 1), (4, 0.8, 1, 0, 1, 1), (60, 0.0, 2, 0, 1, 1), (2, 1.0, 2, 0, 1, 1),
     (3, 1.0, 2, 0, 1, 1), (40, 0.0, 2, 0, 1, 1), (25, 0.6, 2, 0, 1, 1), (30, 0.0, 0, 0, 1, 1), (6, 0.5, 0, 0, 1, 1), (80, 0.0, 0, 0, 1, 1)),
    ((60, 0.0, 2, 0, 1, 1), (3, 1.0, 2, 0, 1, 0), (5, 1.0, 2, 0, 1, 0), (8, 1.0, 2, 0, 1, 0), (25, 0.7, 2, 0, 1, 0), (60, 0.9, 0, 0, 1, 0)),
    ((70, 0.0, 0, 0, 1, 1), (3, 0.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0), (4, 1.0, 0, 0, 1, 0), (5, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0)),
    ((4, 1.0, 2, 0, 1, 0), (2, 1.0, 2, 0, 1, 0), (5, 0.8, 2, 0, 1, 0), (10, 0.0, 2, 0, 1, 1), (40, 0.1, 2, 0, 1, 1), (20, 0.0, 2, 0, 1, 1)),
    # link lines at the head and foot of a page that are no run
    ((3, 1.0, 0, 0, 1, 0), (7, 0.0, 2, 0, 1, 1), (55, 0.0, 2, 0, 1, 1), (3, 1.0, 0, 0, 1, 0)),
    ((4, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0), (80, 0.0, 0, 0, 1, 1), (60, 0.1, 0, 0, 1, 1), (6, 0.8, 0, 0, 1, 0)),
    ((1, 1.0, 2, 0, 1, 0), (12, 0.0, 2, 0, 1, 1), (20, 0.0, 2, 0, 1, 1), (9, 1.0, 2, 0, 1, 1), (24, 0.0, 2, 0, 1, 1), (2, 1.0, 1, 0, 1, 0)),
    ((30, 0.0, 0, 0, 1, 1), (1, 1.0, 0, 0, 1, 1), (100, 0.1, 0, 0, 1, 1), (8, 1.0, 0, 0, 1, 1), (22, 0.0, 0, 0, 1, 1), (12, 1.0, 0, 0, 1, 0)),
    ((150, 0.0, 2, 0, 1, 1), (1, 1.0, 2, 0, 1, 1), (150, 0.0, 2, 0, 1, 1), (6, 0.7, 2, 0, 1, 1), (35, 0.2, 2, 0, 1, 1), (10, 1.0, 2, 0, 1, 0)),
    # runs of links between long texts, and lines beside them
    ((60, 0.0, 2, 0, 1, 1), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (2, 1.0, 1, 0, 1, 0), (60, 0.0, 2, 0, 1, 1), (5, 1.0, 0, 0, 1, 0),
     (5, 1.0, 0, 0, 1, 0), (8, 1.0, 0, 0, 1, 0), (5, 1.0, 0, 0, 1, 0), (90, 0.0, 2, 0, 1, 1)),
    ((1, 0.0, 0, 0, 1, 0), (3, 1.0, 0, 0, 1, 0), (3, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 0.0, 0, 0, 1, 0), (6, 0.0, 2, 0, 1, 1), (40, 0.0, 2, 0, 1, 1),
     (1, 0.0, 0, 0, 1, 0)),
    ((5, 0.0, 0, 0, 1, 0), (9, 1.0, 1, 0, 1, 0), (9, 1.0, 1, 0, 1, 0), (2, 1.0, 1, 0, 1, 0), (20, 0.0, 0, 0, 1, 0), (2, 0.0, 2, 0, 1, 1), (25, 0.0, 2, 0, 1, 1),
     (20, 0.0, 0, 0, 1, 0)),
    ((10, 0.0, 0, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (35, 0.0, 0, 0, 1, 1), (30, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 0, 1, 0)),
    ((1, 1.0, 1, 0, 1, 0), (3, 1.0, 1, 0, 1, 0), (9, 0.0, 0, 0, 1, 0), (25, 0.0, 2, 0, 1, 1), (70, 0.0, 2, 0, 1, 1), (5, 1.0, 2, 0, 1, 1),
     (9, 1.0, 2, 0, 1, 1), (80, 0.0, 2, 0, 1, 1), (1, 1.0, 2, 0, 1, 1), (1, 1.0, 2, 0, 1, 1), (30, 0.0, 0, 0, 1, 1), (20, 0.0, 0, 0, 1, 0)),
    ((2, 1.0, 0, 0, 1, 0), (1, 1.0, 0, 0, 1, 0), (3, 1.0, 0, 0, 1, 0), (20, 0.0, 0, 0, 1, 0), (40, 0.0, 2, 0, 1, 1), (90, 0.0, 2, 0, 1, 1), (4, 1.0, 1, 0, 1, 1),
     (12, 1.0, 1, 0, 1, 1), (22, 0.0, 2, 0, 1, 1), (1, 0.0, 0, 0, 1, 0)),
    ((1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (3, 0.0, 0, 0, 1, 0), (150, 0.0, 2, 0, 1, 1), (2, 1.0, 2, 0, 1, 0), (2, 1.0, 2, 0, 1, 0),
     (2, 1.0, 2, 0, 1, 0), (150, 0.0, 2, 0, 1, 1), (9, 1.0, 1, 0, 1, 0), (4, 1.0, 1, 0, 1, 0), (9, 1.0, 1, 0, 1, 0), (25, 0.0, 2, 0, 1, 1)),
    ((2, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (6, 0.0, 0, 0, 1, 0), (12, 0.0, 2, 0, 1, 1), (50, 0.0, 2, 0, 1, 1), (15, 0.0, 0, 0, 1, 0)),
    ((1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 0, 1, 0), (2, 1.0, 1, 0, 1, 0), (15, 0.0, 0, 0, 1, 0), (16, 0.0, 2, 0, 1, 1), (30, 0.0, 2, 0, 1, 1), (10, 0.0, 0, 0, 1, 0)),
    ((1, 1.0, 0, 0, 1, 0), (1, 1.0, 0, 0, 1, 0), (1, 1.0, 0, 0, 1, 0), (18, 0.0, 0, 0, 1, 0), (20, 0.0, 2, 0, 1, 1), (120, 0.0, 2, 0, 1, 1), (18, 0.0, 0, 0, 1, 0)),
    # texts in bare boxes; short lines between long ones belong to them
    ((2, 0.0, 0, 0, 1, 1), (60, 0.0, 0, 0, 1, 1), (3, 0.0, 0, 0, 1, 1), (45, 0.1, 0, 0, 1, 1), (9, 0.0, 0, 0, 1, 1), (150, 0.0, 0, 0, 1, 1)),
    ((5, 0.0, 0, 0, 1, 1), (60, 0.0, 0, 0, 1, 1), (1, 0.0, 0, 0, 1, 1), (40, 0.0, 0, 0, 1, 1), (15, 0.0, 0, 0, 1, 1), (30, 0.3, 0, 0, 1, 1)),
    ((150, 0.0, 0, 0, 1, 1),), ((12, 0.0, 0, 0, 1, 1),), ((3, 0.0, 0, 0, 1, 1),), ((2, 0.0, 0, 0, 1, 1),), ((1, 0.0, 0, 0, 1, 1),),
    # short texts in paragraphs, lists and tables, without links around
    ((4, 0.0, 2, 0, 1, 1),), ((1, 0.0, 2, 0, 1, 1), (2, 0.0, 2, 0, 1, 1), (3, 0.0, 2, 0, 1, 1)), ((6, 0.0, 1, 0, 1, 1), (2, 0.0, 1, 0, 1, 1)),
    ((2, 0.0, 2, 0, 1, 1), (5, 0.0, 1, 0, 1, 1), (3, 0.2, 1, 0, 1, 1), (1, 0.0, 1, 0, 1, 1), (4, 0.0, 1, 0, 1, 1), (12, 0.1, 2, 0, 1, 1)),
    # nothing but links, or names and links
    ((4, 1.0, 2, 0, 1, 0),), ((1, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0)), ((2, 0.0, 0, 0, 1, 0), (3, 1.0, 1, 0, 1, 0), (2, 0.0, 0, 0, 1, 0), (4, 1.0, 1, 0, 1, 0)),
)

Tree = tuple  # (feature, threshold, tree at or below, tree above), or the verdict alone


def train(table: np.ndarray, depth: int = 16):
    """A classification tree by the largest fall in Gini impurity; ties go to the first feature and threshold."""
    y = table[:, -1]
    if depth == 0 or y.min() == y.max():
        return bool(y.mean() >= 0.5)

    def impurity(part: np.ndarray) -> float:
        share = part.mean()
        return len(part) * share * (1 - share)

    best = (impurity(y) - 1e-9, None, None)
    for feature in range(table.shape[1] - 1):
        levels = np.unique(table[:, feature])
        for threshold in (levels[1:] + levels[:-1]) / 2:
            low = table[:, feature] <= threshold
            cost = impurity(y[low]) + impurity(y[~low])
            if cost < best[0]:
                best = (cost, feature, float(threshold))
    _, feature, threshold = best
    if feature is None:
        return bool(y.mean() >= 0.5)
    low = table[:, feature] <= threshold
    return feature, threshold, train(table[low], depth - 1), train(table[~low], depth - 1)


def verdict(tree, x: tuple) -> bool:
    while not isinstance(tree, bool):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _described(rows: list[tuple]) -> list[tuple]:
    """FEATURES of the blocks of a page, from (words, density, kind, aside, place) of each."""
    around = [(0, 0.0), *(r[:2] for r in rows), (0, 0.0)]
    runs: list[int] = []
    # a run of links ends where the part of the page does
    for (linked, _, _), run in groupby(rows, key=lambda r: (r[1] > LINKED, r[3], r[4])):
        n = sum(1 for _ in run)
        runs.extend([n if linked else 0] * n)
    return [(words, density, *around[i], *around[i + 2], aside, place, kind, runs[i])
            for i, (words, density, kind, aside, place) in enumerate(rows)]


def labelled(pages=LABELLED) -> np.ndarray:
    """The training table with FEATURES, the last column saying article or not.

    A page that marks nothing is read again as it would be aside, outside of a marked article, and within one,
    where all is article but runs of links in lists and boxes.
    """
    table = [(*x, row[-1]) for page in pages for x, row in zip(_described([r[:-1] for r in page]), page, strict=True)]
    for page in pages:
        bare = [row[:3] for row in page]
        if all(place == 1 for *_, place, _ in page):
            for aside, place in ((1, 1), (1, 2), (0, 0), (0, 2)):
                for x in _described([(*row, aside, place) for row in bare]):
                    table.append((*x, int(place == 2 and not aside and (x[-1] < MENU or x[-2] == 2))))
    return np.array(table)


def features(found: list[Block]) -> list[tuple]:
    marked = any(b.main for b in found)
    return _described([(b.words, b.density, b.kind, int(b.aside), 1 if not marked else 2 if b.main else 0) for b in found])


def main_text(page: str | None, tree) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if verdict(tree, x))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of ``pages`` (page_id, url, html).

    The whole page is read, whatever its length. Null and empty pages and those without an article have an empty
    text; page_id and url come back as they are, nulls and repeated rows included; other columns are left out. An
    empty table gives an empty one. Blocks of any length are read whole; a page is one row of one batch in memory.
    """
    tree = train(labelled())
    kind = pages.schema["page_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, tree) for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_texts(pages.select("page_id", "url", "html"), "html",
                     f"page_id {kind}, url string, text string, n_chars long", work)
