"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block-level tags into a flat list of texts. Each block is described by its words, its share of linked
words, the same two of its neighbours, and whether it stands in an element for content or for boilerplate. The tree is
fitted on the small labelled table below; pages without any element for content have a tree and more rows of their own.

Classes, ids and roles mark boilerplate as whole names or as known compounds (`comment-list`, `site-footer`), so
`has-sidebar` and `related-work` mark nothing. Headings and parts of an article have ids for links, which are not read
unless they name a list of comments. Elements with a `hidden` attribute or `display:none` are boilerplate. A paragraph
ends where the next block begins, so its own marks reach no further.
A `main`, or an `article` with no unmarked article before it, takes back the marks of wrappers around it.

Scripts, styles, comments, titles and other parts without readable text are skipped; the code of a script or style ends
only at its own closing tag, and what it holds is not read as tags. The tags of head and body may be left out, as HTML
allows. Markup that is never closed ends with the page, or where the head is closed or the body opened. Character references are decoded, white space within a block becomes one space. Null and empty
pages have an empty text. Pages of any length are read whole; equal rows give equal texts; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their part in a page.
SKIPPED = frozenset(
    "script style noscript template title svg math iframe object canvas audio video textarea select datalist".split()
)
# Of these, the ones whose content is plain text up to their own closing tag.
RAW = ("script", "style", "noscript", "title", "iframe", "textarea")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Of these, the ones that hold no main text even if an article stands in them.
FIRM = BOILERPLATE - {"form"}
# Elements that stand within a paragraph and do not end it.
IN_PARAGRAPH = frozenset("button caption tbody td tfoot th thead tr".split())
# Elements whose id can name a part of the page, as other ids are targets of links.
NAMED = frozenset("div section ul ol table td".split())
# Names in a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice popup modal "
    "overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social comment comments disqus "
    "reply replies respond footer masthead newsletter subscribe signup login search widget related recommended "
    "contentinfo complementary".split()
)
# Words that mark content.
CONTENT_MARKS = frozenset("article articlebody entry post story main content body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']+|\"[^\"<]*\"|'[^'<]*')*))>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I | re.A) for name in RAW}
# A script that opens a comment and another script in it ends after the closing tag of the inner one.
_SCRIPT_PART = re.compile(r"<!--(?:-?>)?|-->|<(/?)script(?=[\s/>])", re.I | re.A)
_HEAD_END = re.compile(r"</head(?=[\s/>])|<body(?=[\s/>])", re.I | re.A)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_MARK = "|".join(sorted(MARKS, key=len, reverse=True))
# A mark by itself, or between a word for the place and words for the kind of box, with a number.
_MARKED = re.compile(
    r"(?:(?:site|page|global|main|primary|secondary|top|bottom|post|entry|article|blog|reader|readers|user|users)-)?"
    rf"(?:{_MARK})(?:-(?:{_MARK}))*"
    r"(?:-(?:area|articles|bar|block|box|button|buttons|container|icons|inner|item|items|form|links|list|posts|section|"
    r"slot|stories|thread|unit|widgets|wrap|wrapper))*(?:-?\d+(?:x\d+)?)?"
    r"|(?:div-)?(?:advert|comment|comments|cookie|footer|modal|popup|promo|reply|sidebar|sponsored)"
    r"-(?:body|content|text|message)(?:-\d+)?"
    r"|comments?list(?:-\d+)?"
)
# Ids that name a list of comments wherever they stand.
_COMMENTS_ID = re.compile(
    r"(?:blog|post|reader|readers|user|users)-comments|comments?-(?:area|form|list|section|thread|wrap|wrapper)"
    r"|comments?list|disqus(?:-thread)?"
)
_UNSEEN = re.compile(r"display\s*:\s*none")
_WORD_CUT = re.compile(r"[^a-z]+")
_JOINT = re.compile(r"[-_]+")

FEATURES = ("words", "linked", "words_before", "linked_before", "words_after", "linked_after", "content", "boiler",
            "heading")

# The labelled table: the features of a block, and 1 for main text. The first 20 rows are blocks inside content
# elements, the next 30 blocks inside boilerplate, the others blocks of pages without such elements.
LABELLED = (
    (9, 0.0, 6, 1.0, 40, 0.0, 1, 0, 1, 1), (40, 0.0, 9, 0.0, 55, 0.1, 1, 0, 0, 1),
    (120, 0.05, 40, 0.0, 80, 0.0, 1, 0, 0, 1), (1, 0.0, 60, 0.0, 90, 0.0, 1, 0, 0, 1),
    (3, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (15, 0.4, 70, 0.0, 30, 0.0, 1, 0, 0, 1),
    (6, 1.0, 0, 0.0, 50, 0.0, 1, 0, 1, 1), (2, 0.0, 3, 1.0, 4, 1.0, 1, 0, 0, 1),
    (8, 1.0, 45, 0.0, 60, 0.0, 1, 0, 0, 1), (30, 0.0, 5, 1.0, 12, 0.0, 1, 0, 0, 1),
    (5, 0.0, 25, 0.0, 6, 0.0, 1, 0, 1, 1), (200, 0.0, 2, 1.0, 7, 0.3, 1, 0, 0, 1),
    (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 0, 1), (4, 0.0, 200, 0.0, 5, 0.0, 1, 0, 0, 1),
    (1, 1.0, 2, 0.0, 3, 0.5, 1, 0, 0, 1), (18, 0.0, 4, 0.0, 2, 1.0, 1, 0, 0, 1),
    (7, 0.0, 9, 1.0, 4, 0.0, 1, 0, 0, 1), (12, 0.7, 5, 0.0, 3, 0.0, 1, 0, 0, 1),
    (60, 0.0, 3, 0.0, 1, 0.0, 1, 0, 0, 1), (24, 0.2, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (7, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0),
    (8, 0.2, 50, 0.0, 0, 0.0, 0, 1, 0, 0), (60, 0.0, 30, 0.0, 20, 0.0, 0, 1, 0, 0),
    (25, 0.0, 40, 0.0, 35, 0.0, 1, 1, 0, 0), (4, 1.0, 40, 0.0, 5, 1.0, 1, 1, 0, 0),
    (12, 0.0, 80, 0.0, 90, 0.0, 1, 1, 0, 0), (3, 0.0, 2, 0.0, 70, 0.0, 0, 1, 1, 0),
    (150, 0.1, 9, 0.0, 8, 1.0, 0, 1, 0, 0), (2, 0.5, 3, 1.0, 2, 1.0, 0, 1, 0, 0),
    (35, 0.0, 60, 0.0, 4, 1.0, 1, 1, 0, 0), (5, 0.0, 30, 0.0, 45, 0.0, 1, 1, 1, 0),
    (14, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0, 0), (22, 0.0, 45, 0.0, 0, 0.0, 0, 1, 0, 0),
    (16, 0.0, 120, 0.0, 40, 0.0, 0, 1, 0, 0), (30, 0.0, 70, 0.0, 35, 0.0, 0, 1, 0, 0),
    (9, 0.0, 1, 1.0, 60, 0.0, 0, 1, 0, 0), (18, 0.0, 2, 1.0, 90, 0.0, 0, 1, 0, 0),
    (40, 0.0, 25, 0.0, 50, 0.0, 0, 1, 0, 0), (70, 0.1, 80, 0.0, 65, 0.0, 0, 1, 0, 0),
    (45, 0.0, 50, 0.1, 30, 0.0, 1, 1, 0, 0), (20, 0.0, 38, 0.0, 44, 0.0, 1, 1, 0, 0),
    (1, 0.0, 55, 0.0, 70, 0.0, 1, 1, 0, 0), (90, 0.0, 100, 0.0, 110, 0.0, 1, 1, 0, 0),
    (8, 1.0, 50, 0.0, 60, 0.0, 1, 1, 0, 0), (26, 0.3, 4, 0.0, 3, 0.0, 1, 1, 0, 0),
    (6, 0.0, 12, 0.0, 9, 0.0, 1, 1, 0, 0), (11, 0.0, 0, 0.0, 30, 0.0, 0, 1, 1, 0),
    (50, 0.0, 40, 0.0, 60, 0.0, 0, 1, 0, 0), (33, 0.0, 28, 0.0, 27, 0.0, 1, 1, 0, 0),
    (45, 0.0, 8, 0.0, 60, 0.0, 0, 0, 0, 1), (90, 0.1, 45, 0.0, 30, 0.2, 0, 0, 0, 1),
    (22, 0.15, 30, 0.0, 26, 0.0, 0, 0, 0, 1), (14, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1),
    (8, 0.0, 70, 0.0, 45, 0.1, 0, 0, 0, 1), (10, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1, 1),
    (7, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1, 1), (18, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 1),
    (3, 1.0, 2, 1.0, 4, 1.0, 0, 0, 0, 0), (2, 1.0, 3, 1.0, 40, 0.0, 0, 0, 0, 0),
    (6, 0.6, 5, 1.0, 3, 1.0, 0, 0, 0, 0), (30, 0.8, 4, 1.0, 6, 0.9, 0, 0, 0, 0),
    (4, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 0), (9, 0.5, 60, 0.0, 4, 1.0, 0, 0, 0, 0),
    (3, 0.0, 2, 0.0, 3, 0.0, 0, 0, 0, 0), (4, 0.0, 6, 0.8, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 2, 1.0, 3, 1.0, 0, 0, 1, 0), (55, 0.7, 30, 0.0, 5, 1.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 80, 0.0, 0, 0, 0, 0), (4, 1.0, 30, 0.0, 45, 0.0, 0, 0, 0, 0),
    (20, 0.9, 3, 1.0, 30, 0.0, 0, 0, 0, 0), (2, 0.0, 5, 1.0, 25, 0.0, 0, 0, 0, 0),
)

# More blocks of pages that have no content element at all, where short blocks and headings belong to the text.
PLAIN = (
    (3, 0.0, 2, 0.0, 3, 0.0, 0, 0, 0, 1),
    (2, 0.0, 0, 0.0, 40, 0.0, 0, 0, 1, 1), (4, 0.0, 0, 0.0, 6, 0.0, 0, 0, 1, 1),
    (3, 0.0, 50, 0.0, 45, 0.0, 0, 0, 1, 1), (1, 0.0, 12, 0.0, 8, 0.0, 0, 0, 1, 1),
    (2, 0.0, 2, 1.0, 30, 0.0, 0, 0, 1, 1), (5, 0.0, 1, 1.0, 4, 0.0, 0, 0, 1, 1),
    (4, 0.0, 30, 0.0, 4, 0.0, 0, 0, 0, 1), (3, 0.0, 4, 0.0, 4, 0.0, 0, 0, 0, 1),
    (5, 0.0, 3, 0.0, 50, 0.0, 0, 0, 0, 1), (2, 0.0, 3, 0.0, 2, 0.0, 0, 0, 0, 1),
    (1, 0.0, 2, 0.0, 1, 0.0, 0, 0, 0, 1), (4, 0.0, 80, 0.0, 60, 0.0, 0, 0, 0, 1),
    (6, 0.0, 5, 0.0, 7, 0.0, 0, 0, 0, 1), (3, 0.0, 40, 0.0, 30, 0.1, 0, 0, 0, 1),
    (4, 0.0, 25, 0.0, 0, 0.0, 0, 0, 0, 1), (6, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 1),
    (9, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (6, 0.3, 40, 0.0, 35, 0.0, 0, 0, 0, 1), (4, 0.0, 2, 0.0, 12, 0.0, 0, 0, 0, 1),
)


class Tree:
    """A binary decision tree by Gini impurity, in arrays of nodes."""

    def __init__(self, table: np.ndarray, labels: np.ndarray, depth: int = 6):
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []
        self._grow(table, labels, depth)
        for name in ("feature", "threshold", "left", "right", "value"):
            setattr(self, name, np.array(getattr(self, name)))
        self.depth = depth

    def _grow(self, table: np.ndarray, labels: np.ndarray, depth: int) -> int:
        number = len(self.value)
        self.feature.append(0)
        self.threshold.append(np.inf)
        self.left.append(number)
        self.right.append(number)
        self.value.append(bool(labels.mean() > 0.5))
        best = (1e-9, 0, 0.0)
        if depth and labels.min() != labels.max():
            whole = len(labels) * labels.mean() * (1 - labels.mean())
            for f, column in enumerate(table.T):
                levels = np.unique(column)
                for cut in (levels[1:] + levels[:-1]) / 2:
                    sides = labels[column <= cut], labels[column > cut]
                    gain = whole - sum(len(s) * s.mean() * (1 - s.mean()) for s in sides)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, cut)
        if best[0] > 1e-9:
            low = table[:, best[1]] <= best[2]
            self.feature[number], self.threshold[number] = best[1], best[2]
            self.left[number] = self._grow(table[low], labels[low], depth - 1)
            self.right[number] = self._grow(table[~low], labels[~low], depth - 1)
        return number

    def predict(self, table: np.ndarray) -> np.ndarray:
        at = np.zeros(len(table), np.int64)
        rows = np.arange(len(table))
        for _ in range(self.depth):
            at = np.where(table[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]


@lru_cache(maxsize=1)
def fitted_tree() -> Tree:
    rows = np.array(LABELLED, float)
    return Tree(rows[:, :-1], rows[:, -1])


@lru_cache(maxsize=1)
def plain_tree() -> Tree:
    """The tree for pages without content elements. Every block of such a page is no main text within boilerplate."""
    known = {r[:-1] for r in PLAIN}
    plain = [*PLAIN, *(r for r in LABELLED if not r[6] and not r[7] and r[:-1] not in known)]
    marked = [(*r[:6], inside, 1, r[8], 0) for r in plain for inside in (0, 1)]
    rows = np.array([*plain, *marked, *(r for r in LABELLED if r[7])], float)
    return Tree(rows[:, :-1], rows[:, -1], depth=10)


def _standing(name: str, attributes: str, inside_content: bool, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is for content, and whether for boilerplate."""
    content, boiler = name in CONTENT, name in BOILERPLATE
    if name == "header":
        boiler = not inside_content
    if attributes and name not in ("body", "head", "html"):
        values: dict[str, str] = {}
        for found in _ATTRIBUTE.findall(attributes):
            values.setdefault(found[0].lower(), (found[1] or found[2] or found[3]).lower())
        names = " ".join(values.get(k, "") for k in ("class", "role", "itemprop")).split()
        words = {w for n in (*names, values.get("id", "")) for w in _WORD_CUT.split(n)}
        if name in NAMED and (not inside_content or name == "div" and not inside_article and "section" not in names):
            names += values.get("id", "").split()
        elif _COMMENTS_ID.fullmatch(_JOINT.sub("-", values.get("id", ""))) and name not in HEADINGS:
            boiler = True
        hidden = values.get("hidden", "until-found") != "until-found"
        boiler = boiler or hidden or bool(_UNSEEN.search(values.get("style", "")))
        if name != "main":
            boiler = boiler or any(_MARKED.fullmatch(_JOINT.sub("-", n)) for n in names)
        content = content or bool(words & CONTENT_MARKS) and not boiler
    return content, boiler


def _raw_end(source: str, name: str, start: int, unclosed: set[str]) -> int:
    """Where the closing tag of a plain-text element stands, or -1; `unclosed` has what is known not to come any more."""
    if name in unclosed:
        return -1
    comment = inner = False
    for part in _SCRIPT_PART.finditer(source, start) if name == "script" and "<!--" not in unclosed else ():
        if part[0] == "<!--":
            comment = True
        elif part[0] == "-->":
            comment = inner = False
        elif part[1] and not inner:
            return part.start()
        elif part[1] is not None:
            inner = comment and not part[1]
    if comment:
        # A comment that is never closed hides no closing tag.
        unclosed.add("<!--")
    end = _RAW_END[name].search(source, start)
    if not end:
        unclosed.add(name)
    return end.start() if end else -1


def page_blocks(source: str) -> list[tuple[str, int, float, bool, bool, bool]]:
    """The text blocks of a page: text, words, linked share, in content, in boilerplate, heading."""
    out: list[tuple[str, int, float, bool, bool, bool]] = []
    # Open elements that matter, with what held before them: in content, in an article, in boilerplate, and in
    # boilerplate that an article does not take back.
    stack: list[tuple[str, tuple[bool, bool, bool, bool]]] = []
    text: list[str] = []
    linked_words = links = 0
    content = article = boiler = firm = article_seen = False
    heading, skip, place = False, "", 0
    # Plain-text elements with no closing tag in the rest of the page, and comments in scripts.
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked_words
        words = "".join(text).split()
        if words:
            share = min(1.0, linked_words / len(words))
            out.append((" ".join(words), len(words), share, content, boiler, heading))
        text.clear()
        linked_words = 0

    def add(raw: str) -> None:
        nonlocal linked_words
        raw = html.unescape(raw) if "&" in raw else raw
        text.append(raw)
        if links:
            linked_words += len(raw.split())

    def leave(name: str) -> None:
        nonlocal content, article, boiler, firm
        last = ""
        while last != name:
            last, (content, article, boiler, firm) = stack.pop()

    while token := _TOKEN.search(source, place):
        if token.start() > place and not skip:
            add(source[place:token.start()])
        place = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(token[1] or token[4]), token[3] or token[6] or ""
        if name in RAW and not closing and not attributes.endswith("/"):
            end = _raw_end(source, name, place, unclosed)
            if end >= 0:
                place = end
            elif not skip:
                # A page that never closes its title or script shows its body all the same.
                rest = _HEAD_END.search(source, place)
                place = rest.start() if rest else len(source)
            continue
        if skip:
            if closing and name == skip:
                skip = ""
            continue
        if name in SKIPPED and not closing:
            if not attributes.endswith("/"):
                skip = name
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name not in BLOCKS and name not in VOID and not attributes:
            continue
        if name in BLOCKS:
            flush()
            links = 0
            heading = name in HEADINGS and not closing
            if not closing and name not in IN_PARAGRAPH and any(s[0] == "p" for s in stack):
                leave("p")
        if name in VOID or attributes.endswith("/"):
            continue
        if not closing:
            is_content, is_boiler = _standing(name, attributes, content, article)
            if name == "p":
                # Plain paragraphs change nothing, so they need no place among the open elements.
                is_content = False
                if not is_boiler:
                    continue
            if name in BLOCKS or is_boiler:
                if name not in BLOCKS:
                    flush()
                stack.append((name, (content, article, boiler, firm)))
                if name == "main" or name == "article" and not (is_boiler or firm or article_seen):
                    boiler = firm = False
                content = content or is_content
                firm = firm or is_boiler and (article or name in FIRM)
                boiler = boiler or is_boiler
                if name == "article":
                    article_seen = article_seen or not (article or boiler or stack[-1][1][2])
                    article = True
        elif any(s[0] == name for s in stack):
            if name not in BLOCKS:
                flush()
            leave(name)
    if place < len(source) and not skip:
        add(source[place:])
    flush()
    return out


def page_texts(pages: list[str | None]) -> list[str]:
    """The main text of every page."""
    blocks = [page_blocks(p) if p else [] for p in pages]
    rows, plain = [], []
    for page in blocks:
        around = [(0, 0.0), *((b[1], b[2]) for b in page), (0, 0.0)]
        plain += [not any(b[3] and not b[4] for b in page)] * len(page)
        for i, (_, words, share, content, boiler, heading) in enumerate(page):
            rows.append((words, share, *around[i], *around[i + 2], content, boiler, heading))
    if not rows:
        return [""] * len(pages)
    table = np.array(rows, float)
    chosen = iter(np.where(plain, plain_tree().predict(table), fitted_tree().predict(table)).tolist())
    return ["\n".join([b[0] for b in page if next(chosen)]) for page in blocks]


def extract_text(df: DataFrame, source: str = "html") -> DataFrame:
    """`(page_id, url, text, n_chars)` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = page_texts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = df.select(F.col("page_id").cast("long").alias("page_id"), "url", source)
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
