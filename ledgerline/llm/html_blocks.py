"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at block-level tags. Each block has its
word count and link density, those of its neighbours, and three marks of the tags
around it. A small decision tree, trained on the labelled pages of
``html_training``, tells which blocks belong to the article.

Class names are read as whole words. Those that name a topic or a state
(``category-legal``, ``tag-search``, ``comments-open``) say nothing of the page's
parts, and on an element that is marked as an article only names that can mean
nothing else make it a frame. Ambiguous names (``legal``, ``thread``) make a frame
beside a marked article; on other pages words and links decide alone.

``text`` joins the blocks kept, in page order, by ``\\n``; in a block every run of
white space is one blank and character references are decoded. Null and empty
pages, and pages without a kept block, have the text ``""``. Broken markup is read
as far as it goes: a ``<`` that opens no tag is text, an open tag ends with its
parent; only script, style, title and textarea without an end tag hold all that
follows, as in HTML. A self-closed svg or math is empty, and both end where a
block begins that cannot stand in them. Repeated rows are read each by itself; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices

FEATURES = (
    "words", "link_density", "words_before", "density_before", "words_after", "density_after",
    "closed", "heading", "in_article", "in_frame",
)
TREE_DEPTH = 8
LABEL_WORDS = 3

# Tags that end a block, tags whose contents are no text, tags that
# have no end, and the tags, roles and class words that tell what a part of a page is.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
# What stands in the first is not read for tags.
RAW_TAGS = "script style title textarea".split()
SILENT_TAGS = frozenset("noscript template svg math iframe object canvas audio video select".split())
FOREIGN_TAGS = frozenset("svg math".split())
FOREIGN_TEXT_TAGS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())  # these may hold blocks
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FRAME_TAGS = frozenset("nav header footer aside form button dialog menu search fieldset label".split())
ARTICLE_TAGS = frozenset("article main".split())
FRAME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search status toolbar".split()
)
FRAME_WORDS = frozenset(
    "ad ads adv advert advertisement adverts announcement banner breadcrumb breadcrumbs byline captcha comment comments "
    "consent cookie cookies copyright credits disclaimer discussion disqus dropdown feedback foot footer gdpr hamburger "
    "head header hidden legal links login masthead menu meta modal nav navbar navigation newsletter notice notification "
    "outbrain overlay pager pagination paywall popup promo promoted promotion rail recommended related remark remarks "
    "replies reply respond response responses search share sharing shoutbox sidebar signup site-info skip social sponsor "
    "sponsored subscribe subscription survey taboola tags teaser thread toc toolbar topbar trackback warning widget "
    "widgets".split()
)
# Beginnings that tell as much, as in "commentlist" or "adslot".
FRAME_STEMS = (
    "adbox", "adsense", "adslot", "adunit", "advert", "breadcrumb", "comment", "cookie", "footer", "masthead", "navbar",
    "navigation", "newsletter", "sidebar", "sponsor", "subscri",
)
ARTICLE_WORDS = frozenset("article articlebody content entry hentry main post story".split())
# "has-sidebar" tells of a layout and not of a part.
LAYOUT_WORDS = frozenset("has no with without".split())
# "category-legal" tells of a topic, unless it is a list of them; "comments-open" of a state.
TOPIC_WORDS = frozenset("author category format label status tag term topic type".split())
LIST_WORDS = frozenset("archive box cloud links list lists menu nav".split())
STATE_WORDS = frozenset("closed disabled enabled off on open".split())
# Frame words that may as well be what an article is about, or how it is laid out.
AMBIGUOUS_WORDS = frozenset(
    "announcement discussion feedback legal rail response responses search skip social survey tags thread toc warning".split()
)
# What a name may hold beside a frame word, if it is to make a frame of an article: "related-posts", "comment-body".
PART_WORDS = frozenset("area block body box card container entry item link links list post posts section wrapper".split())
# No article stands in these.
CLOSED_TAGS = frozenset("nav aside footer".split())

_RAW = "|".join(RAW_TAGS)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(class|id|role|aria-label|hidden|style|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_CLOSERS = "\"')]}»”’"
_CLOSING = tuple(".!?…:;。！？")

PLAIN, ARTICLE, FRAME, HIDDEN, HINT = range(5)


@dataclass
class Block:
    """One block: its text, its words outside and inside links, and the marks around it."""

    text: str
    words: int
    linked: int
    heading: bool
    in_article: bool
    in_frame: bool
    label: int | None = None
    hinted: bool = False  # by an ambiguous name

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    """An open tag: its name, what it says of the page part, and what holds inside."""

    tag: str
    kind: int
    in_article: bool
    hidden: bool
    label: int | None
    closed: bool = False


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    pieces: list[tuple[str, bool]] = field(default_factory=list)


def _frame_words(parts: set[str]) -> set[str]:
    return {part for part in parts if part in FRAME_WORDS or part.startswith(FRAME_STEMS)}


def _names(value: str, found: int) -> int:
    """What the words of a class or id say, on an element that is ``found`` to be an article or plain."""
    names = []
    for name in value.split():
        parts = [x.lower() for x in _NAME_PARTS.findall(name)]
        topic = len(parts) > 1 and parts[0] in TOPIC_WORDS and parts[1] not in LIST_WORDS
        head = {"header", "head"} & set(parts) and {"article", "entry", "post", "story"} & set(parts)
        # The head of an article holds its title.
        if parts and not topic and not head and not LAYOUT_WORDS & set(parts) and not (len(parts) > 1 and parts[-1] in STATE_WORDS):
            names.append(set(parts))
    article = found == ARTICLE or any(parts <= ARTICLE_WORDS for parts in names)
    hinted = False
    for parts in names:
        frame = _frame_words(parts)
        if article and not parts <= frame | PART_WORDS | ARTICLE_WORDS:
            continue  # a title or topic in the name of an article
        if frame - AMBIGUOUS_WORDS:
            return FRAME
        hinted |= bool(frame) and not article
        if parts & ARTICLE_WORDS:
            found = ARTICLE
    return HINT if hinted else found


def _kind(tag: str, attributes: str, in_article: bool) -> int:
    """What a tag says of the part of the page that it holds; its names count more than the tag."""
    found = PLAIN
    if tag in FRAME_TAGS and not (tag == "header" and in_article):
        found = FRAME
    elif tag in ARTICLE_TAGS:
        found = ARTICLE
    if not attributes or tag in ("body", "head", "html"):
        return found
    hinted = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "style" and _HIDING.search(value)) or (name == "aria-hidden" and value == "true"):
            return HIDDEN
        if name == "role" and value.lower() in FRAME_ROLES:
            return FRAME
        if name == "role" and value.lower() in ARTICLE_TAGS:
            found = ARTICLE
        # A longer label is a sentence and not the name of a part.
        if name in ("class", "id") or (name == "aria-label" and len(value.split()) <= LABEL_WORDS):
            named = _names(value, found)
            if named == FRAME:
                return FRAME
            hinted |= named == HINT
            found = found if named == HINT else named
    return HINT if hinted and found == PLAIN else found


def blocks(page: str) -> list[Block]:
    """The flat blocks of a page that have a word, in page order; hidden parts are left out."""
    out = _Page()
    stack = [_Open("", PLAIN, False, False, None)]
    links, heading, at = 0, False, 0
    silent: list[str] = []  # the open silent tag and the tags open inside
    inline: Counter[str] = Counter()  # open tags that are not on the stack

    def text(end: int) -> None:
        if end > at and not silent and not stack[-1].hidden:
            out.pieces.append((html.unescape(page[at:end]), links > 0))

    def flush() -> None:
        if not out.pieces:
            return
        whole = "".join(x for x, _ in out.pieces).split()
        if whole:
            linked = sum(len(x.split()) for x, inside in out.pieces if inside)
            top = stack[-1]
            out.blocks.append(
                Block(" ".join(whole), len(whole), linked, heading, top.in_article, top.kind == FRAME, top.label, top.kind == HINT)
            )
        out.pieces.clear()

    for match in _TOKEN.finditer(page):
        text(match.start())
        at = match.end()
        tag = match[3]
        if not tag:
            continue
        tag = tag.lower()
        if silent and match[2]:
            if tag in silent:
                del silent[len(silent) - 1 - silent[::-1].index(tag) :]
                continue
            if not inline[tag] and all(x.tag != tag for x in stack):
                continue
            silent.clear()  # its parent ends
        elif silent:
            foreign = silent[0] in FOREIGN_TAGS and not FOREIGN_TEXT_TAGS.intersection(silent)
            if not foreign or tag not in BLOCK_TAGS:
                if tag not in VOID_TAGS and not match[4].endswith("/"):
                    silent.append(tag)
                continue
            silent.clear()
        if tag in SILENT_TAGS and not match[2]:
            if tag not in FOREIGN_TAGS or not match[4].endswith("/"):
                silent.append(tag)
            continue
        if tag not in BLOCK_TAGS and tag not in VOID_TAGS:
            inline[tag] = max(0, inline[tag] - 1) if match[2] else inline[tag] + 1
        if tag == "a":
            links = 0 if match[2] else 1
            continue
        if tag == "br":
            out.pieces.append((" ", False))
            continue
        if tag in VOID_TAGS and tag != "hr":
            continue
        block = tag in BLOCK_TAGS
        if match[2]:
            if block:
                flush()
                heading = False
                links = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if not block and stack[i].tag in BLOCK_TAGS:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if block:
            flush()
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            links = 0
        if tag in ("p", "hr") or match[4].endswith("/"):
            if tag == "p" and stack[-1].tag == "p":
                stack.pop()
            if tag != "p":
                continue
        top = stack[-1]
        kind = _kind(tag, match[4], top.in_article)
        if block or kind != PLAIN:
            label = re.search(r"data-label=([01])", match[4])
            closed = top.closed or tag in CLOSED_TAGS
            stack.append(_Open(
                tag,
                FRAME if top.closed else top.kind if kind == PLAIN else kind,
                top.in_article or (kind == ARTICLE and not closed),
                top.hidden or kind == HIDDEN,
                int(label[1]) if label else top.label,
                closed,
            ))
    text(len(page))
    flush()
    return out.blocks


def features(found: list[Block]) -> np.ndarray:
    """One row per block, see ``FEATURES``; beyond the ends of the page there are no words."""
    rows = np.zeros((len(found), len(FEATURES)))
    if not found:
        return rows
    words = np.array([b.words for b in found], float)
    density = np.array([b.density for b in found])
    rows[:, 0], rows[:, 1] = words, density
    rows[1:, 2], rows[1:, 3] = words[:-1], density[:-1]
    rows[:-1, 4], rows[:-1, 5] = words[1:], density[1:]
    rows[:, 6] = [b.text.rstrip(_CLOSERS).endswith(_CLOSING) for b in found]
    rows[:, 7] = [b.heading for b in found]
    rows[:, 8] = [b.in_article for b in found]
    marked = any(b.in_article and not b.in_frame and not b.hinted for b in found)
    rows[:, 9] = [b.in_frame or (b.hinted and marked) for b in found]
    return rows


@dataclass
class Tree:
    """A binary decision tree in arrays: at a leaf ``column`` is -1 and ``value`` the share of article blocks."""

    column: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        column, limit = np.array(self.column), np.array(self.limit)
        low, high = np.array(self.low), np.array(self.high)
        while (inner := np.flatnonzero(column[at] >= 0)).size:
            node = at[inner]
            at[inner] = np.where(rows[inner, column[node]] <= limit[node], low[node], high[node])
        return np.array(self.value)[at]


def train(rows: np.ndarray, labels: np.ndarray, depth: int = TREE_DEPTH) -> Tree:
    """A tree by Gini impurity; of equal splits the first column and lowest limit are taken."""
    tree = Tree()

    def grow(own: np.ndarray, left: int) -> int:
        number = len(tree.column)
        share = float(labels[own].mean())
        for values, value in ((tree.column, -1), (tree.limit, 0.0), (tree.low, 0), (tree.high, 0), (tree.value, share)):
            values.append(value)
        best = None
        if left and 0 < share < 1:
            for column in range(rows.shape[1]):
                order = own[np.argsort(rows[own, column], kind="stable")]
                x, y = rows[order, column], labels[order].astype(float)
                n = np.arange(1, len(y))
                ones = np.cumsum(y)[:-1]
                rest = y.sum() - ones
                impurity = ones * (n - ones) / n + rest * (len(y) - n - rest) / (len(y) - n)
                impurity[x[1:] == x[:-1]] = np.inf
                at = int(np.argmin(impurity)) if len(impurity) else -1
                if at >= 0 and np.isfinite(impurity[at]) and (best is None or impurity[at] < best[0] - 1e-12):
                    best = (impurity[at], column, (x[at] + x[at + 1]) / 2)
        if best:
            _, column, limit = best
            below = rows[own, column] <= limit
            tree.column[number], tree.limit[number] = column, limit
            tree.low[number] = grow(own[below], left - 1)
            tree.high[number] = grow(own[~below], left - 1)
        return number

    grow(np.arange(len(labels)), depth)
    return tree


def trained_tree() -> Tree:
    """The tree of the labelled pages; their blocks are a table of some hundred rows."""
    from ledgerline.llm.html_training import PAGES

    found = [blocks(page) for page in PAGES]
    rows = np.concatenate([features(x) for x in found])
    labels = np.array([b.label for x in found for b in x])
    return train(rows, labels)


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The article of each page."""
    found = [blocks(page) for page in pages]
    rows = [features(x) for x in found]
    kept = tree.predict(np.concatenate(rows)) > 0.5 if rows else np.zeros(0, bool)
    out, at = [], 0
    for own in found:
        out.append("\n".join(b.text for b, keep in zip(own, kept[at : at + len(own)]) if keep))
        at += len(own)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    tree = trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = pa.array(main_texts(pc.fill_null(part.column("html"), "").to_pylist(), tree), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), texts, pc.utf8_length(texts).cast(pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
