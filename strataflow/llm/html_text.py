"""Main text of web pages: the maximum-scoring run of words and tags, with weights from labelled pages.

A page is read as a sequence of words and tags.  Words in ordinary blocks score positive; tags, and words in links,
menus, notices and the like, score negative.  One linear scan finds the contiguous run with the largest sum; the blocks
it touches are the article.  Menus, forms, adverts, comments and so on inside the run are left out.

The scores are smoothed log-odds of the token's kind inside and outside the article of labelled pages: those whose
article is marked by exactly one ``article`` or ``main`` element, at most ``LABELLED`` of them, drawn by hash.  Kinds
that no labelled page shows keep a prior score.  Every page is scanned whole, marked or not.

Whether an element with a class or id is side matter is learned as well: each name scores by the words under it inside
and outside the labelled articles.  A name that they do not show has a prior score by its parts: it is side matter if
all its parts say so (``cookie-notice``), and not for one of them (``share-price``, ``notice-board``).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from types import MappingProxyType

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import sized

LABELLED = 500
READ_BYTES = 8_000_000
PRIOR = 8.0  # labelled tokens a prior score is worth
# Least and largest score: of a word, of a tag, and of either inside a menu, advert or the like.  Those are left out of
# the text wherever they stand, so they must not cut an article that goes on behind them.
WORD, TAG, SIDE = (-3.0, 1.0), (-4.0, -0.05), (-0.25, -0.05)

# The head, whose end tag may be left out: it goes on as long as what can stand in it.  An element left open in it runs to
# the end of the head, or of the page.
HEAD_TEXT = "|".join(
    rf"<{name}\b[^>]*>(?:.*?</{name}\s*>|.*?(?=</head\b|<body\b)|.*)"
    for name in ("script", "style", "noscript", "template", "title", "noframes")
)
HEAD = (
    rf"<head(?=[\s/>])[^>]*>(?>\s+|<!--(?:.*?-->|.*?(?=</head\b|<body\b)|.*)|{HEAD_TEXT}"
    r"|</?(?:meta|link|base|basefont|bgsound)\b[^>]*>|</(?:script|style|noscript|template|title)\s*>|<[!?][^>]*>"
    r")*+(?:</head\s*>)?"
)
# An svg without content: its slash is no part of an unquoted value.
CLOSED_SVG = r"<svg(?:\s+[^\s=<>/\"']+(?:\s*=\s*(?:\"[^<\"]*\"|'[^<']*'|[^\s<>\"']+(?=\s)))?)*+\s*/>"
# Comments, whole elements whose content is no text, tags, and text between them; whatever is left open runs to the end.
TOKEN = re.compile(
    rf"(?is)<!--.*?(?:-->|\Z)|{CLOSED_SVG}"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    rf"|{HEAD}"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)(?:>|\Z|(?=<))"
    r"|([^<]+|<)"
)
ATTRIBUTE = re.compile(r"(?is)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SPACES = frozenset("br img embed".split())  # stand between words; wbr does not
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 b i em strong span a".split())
SIDE_TAGS = frozenset("nav footer aside form button dialog menu title label input".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu".split())
# Parts of class names and ids that speak for side matter until labelled pages say otherwise, and parts that say nothing.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall "
    "sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond reply replies disqus "
    "discussion related recommended share sharing social widget toolbar pagination pager login search form masthead "
    "topbar disclaimer".split()
)
PLAIN_WORDS = frozenset(
    "bar block body box button buttons container footer group inner item items left link links list main outer right row "
    "section site top wrap wrapper bottom primary secondary global".split()
)
SIDE_NAME = -2.5  # a name with at most this score is side matter
NAME_PRIOR = 100.0  # words under a name that its prior score is worth
HOLDS_ALL = frozenset({"html", "body", "article", "main"})


@dataclass
class Block:
    """Consecutive text without a block boundary; ``side`` says that it belongs to a menu, advert or the like."""

    side: bool
    text: list[str]


@dataclass
class Open:
    """An open element, with what holds for it and all that encloses it."""

    name: str
    side: bool
    within: bool  # an article or main
    where: str  # innermost block
    link: bool
    names: tuple[str, ...] = ()  # classes and ids


ROOT = Open("", False, False, "body", False)


class Page:
    """Tokens of a page: their kinds, and for words the number of their block."""

    def __init__(self, source: str | None, scores: Mapping[str, float] = MappingProxyType({})):
        self.scores = scores
        self.under: Counter = Counter()  # words by (name that holds them, inside the article)
        self.kinds: list[str] = []
        self.counts: list[int] = []
        self.block_of: list[int] = []
        self.inside: list[bool] = []
        self.blocks: list[Block] = []
        self.marks = 0
        self._stack: list[Open] = [ROOT]
        self._names: Counter = Counter()
        self._fresh = True
        for m in TOKEN.finditer(source or ""):
            if m[5]:
                self._text(m[5])
            elif m[3]:
                (self._close if m[2] else self._open)(m[3].lower(), m[4])

    def _token(self, kind: str, count: int, block: int) -> None:
        self.kinds.append(kind)
        self.counts.append(count)
        self.block_of.append(block)
        self.inside.append(self._stack[-1].within)

    def _text(self, raw: str) -> None:
        self._inline(html.unescape(raw))

    def _inline(self, text: str) -> None:
        top = self._stack[-1]
        if self._fresh or not self.blocks:
            if not text.strip():
                return
            self.blocks.append(Block(top.side, []))
            self._fresh = False
        self.blocks[-1].text.append(text)
        words = len(text.split())
        if words:
            kind = "side" if top.side else f"{top.where} link" if top.link else top.where
            self._token(f"word in {kind}", words, len(self.blocks) - 1)
            for o in self._stack:
                for name in o.names:
                    self.under[name, top.within] += words

    def _side(self, name: str, roles: list[str], names: tuple[str, ...]) -> bool:
        if name in HOLDS_ALL:
            return False
        if name in SIDE_TAGS or (name == "header" and not self._stack[-1].within):
            return True
        if SIDE_ROLES.intersection(roles):
            return True
        return any((self.scores.get(f"name {n}") or name_prior(n)) <= SIDE_NAME for n in names)

    def _open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._fresh = True
            while self._stack[-1].name in CLOSED_BY_BLOCK:
                self._pop()
            if name == "li" and self._stack[-1].name == "li":
                self._pop()
        if name in ("article", "main"):
            self.marks += name == "article" or not self._names["article"]
            # A wrapper that holds the article is no side matter, whatever it is called.
            for o in self._stack[1:]:
                o.side = False
        roles, names = named(attributes)
        top = self._stack[-1]
        side = top.side or self._side(name, roles, names)
        self._token(tag_kind("", name, side), 1, -1)
        if name in SPACES and not self._fresh:
            self._inline(" ")
        if name not in VOID and not attributes.endswith("/"):
            where = heading(name) if name in BLOCKS else top.where
            within = top.within or name in ("article", "main")
            link = (top.link and name not in BLOCKS) or name == "a"
            self._stack.append(Open(name, side, within, where, link, names))
            self._names[name] += 1

    def _pop(self) -> None:
        self._names[self._stack.pop().name] -= 1

    def _close(self, name: str, _: str) -> None:
        if name in BLOCKS:
            self._fresh = True
        kind = tag_kind("/", name, self._stack[-1].side)
        if self._names[name]:
            while self._stack[-1].name != name:
                self._pop()
            self._pop()
        self._token(kind, 1, -1)

    def run(self, scores: Mapping[str, float]) -> tuple[int, int]:
        """First token and the one after the last of the run with the largest positive sum; the earliest of equals."""
        best, start, end, total, since = 0.0, 0, 0, 0.0, 0
        for i, (kind, count) in enumerate(zip(self.kinds, self.counts, strict=True)):
            if total <= 0:
                total, since = 0.0, i
            total += count * (scores.get(kind) or prior(kind))
            if total > best:
                best, start, end = total, since, i + 1
        return start, end

    def main_text(self) -> str:
        start, end = self.run(self.scores)
        touched = sorted({b for b in self.block_of[start:end] if b >= 0})
        lines = (" ".join("".join(self.blocks[b].text).split()) for b in touched if not self.blocks[b].side)
        return "\n".join(line for line in lines if line)


def named(attributes: str) -> tuple[list[str], tuple[str, ...]]:
    """Roles, and classes and ids."""
    roles: list[str] = []
    names: list[str] = []
    for key, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower().split()
        (roles if key.lower() == "role" else names).extend(value)
    return roles, tuple(dict.fromkeys(names))


def name_prior(name: str) -> float:
    """Score of a class or id before any page was seen: the mean of its parts, plain ones left out."""
    parts = [p for p in re.split(r"[^a-z0-9]+", name) if p in SIDE_WORDS or p not in PLAIN_WORDS and not p.isdigit() and p]
    return -4.0 * sum(p in SIDE_WORDS for p in parts) / len(parts) if parts else 0.0


def heading(name: str) -> str:
    """All headings are one kind of block."""
    return "h" if len(name) == 2 and name[0] == "h" and name[1].isdigit() else name


def tag_kind(slash: str, name: str, side: bool) -> str:
    return "tag in side" if side else f"<{slash}{heading(name) if name in BLOCKS else 'inline'}>"


def prior(kind: str) -> float:
    """Score of a token kind before any page was seen."""
    if kind.startswith("name "):
        return name_prior(kind[5:])
    if kind.endswith(" side"):
        return -0.1
    if kind.startswith("word"):
        return -1.0 if kind.endswith(" link") else 1.0
    return -0.25 if kind.strip("</>") in ("inline", "p", "h", "li") else -2.0


def bounded(kind: str, score: float) -> float:
    if kind.startswith("name "):
        return score
    low, high = SIDE if kind.endswith(" side") else WORD if kind.startswith("word") else TAG
    return max(low, min(high, score))


def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each kind, and words under each name, inside and outside the marked article."""
    inside, outside = Counter(), Counter()
    for batch in batches:
        for source in batch.column("html").to_pylist():
            page = Page(source)
            if page.marks == 1:
                for kind, count, within in zip(page.kinds, page.counts, page.inside, strict=True):
                    (inside if within else outside)[kind] += count
                for (name, within), count in page.under.items():
                    (inside if within else outside)[f"name {name}"] += count
    kinds = sorted(set(inside) | set(outside))
    columns = [pa.array(kinds, pa.string())] + [pa.array([c[k] for k in kinds], pa.int64()) for c in (inside, outside)]
    yield pa.RecordBatch.from_arrays(columns, ["kind", "within", "without"])


def learned_scores(pages: DataFrame, labelled: int = LABELLED) -> dict[str, float]:
    """Scores by token kind, of which there are a few dozen, and by the names on at most ``labelled`` pages."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)\b")).select("html", F.xxhash64("html").alias("draw"))
    # Only the draws are sorted; the pages up to the last one drawn are then read where they lie.
    last = marked.select("draw").orderBy("draw").limit(labelled).agg(F.max("draw").alias("last")).first().last
    if last is None:
        return {}
    sample = marked.where(F.col("draw") <= last).select("html")
    counts = sample.mapInArrow(tallied, "kind string, within long, without long").groupBy("kind")
    scores = {}
    for r in counts.agg(F.sum("within").alias("a"), F.sum("without").alias("b")).collect():
        odds = math.log((r.a + 1) / (r.b + 1))
        weight = (r.a + r.b) / (r.a + r.b + (NAME_PRIOR if r.kind.startswith("name ") else PRIOR))
        score = weight * odds + (1 - weight) * prior(r.kind)
        scores[r.kind] = bounded(r.kind, score)
    return scores


def main_texts(pages: DataFrame, scores: Mapping[str, float]) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row; null and empty pages have the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "html", READ_BYTES):
            texts = [Page(source, scores).main_text() for source in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(len, texts), pa.int64())], names)

    names = ["page_id", "url", "text", "n_chars"]
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extracted(pages: DataFrame, labelled: int = LABELLED) -> DataFrame:
    return main_texts(pages, learned_scores(pages, labelled))
