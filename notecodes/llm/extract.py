"""Main-text extraction by maximum-scoring subsequence (operator 9).

A page is a sequence of words and tags. Words score positive and tags negative,
with weights learned from labelled pages: pages whose markup has exactly one
``<article>`` or ``<main>``, with most of the words in it, label their words and tags as inside or outside.
A tag that labelled pages have outside only is a barrier. One linear scan finds
the contiguous region of the highest score (the first of equals) on every page, with
article and main as keys like others; it is widened to
the innermost element that holds it, and what has strongly negative words inside it is left out.

Lists of element and class names (menus, notices, adverts, forms, reader comments) are only a prior: they judge
keys that labelled pages have fewer than ``KNOWN_WORDS`` words of, and some of the names only elements
without prose. What the prior calls furniture counts as outside in labelled pages.

Weights are counts per key (element name with its first class) from all pages;
keys rarer than ``LEAST_SHARE`` of the pages have the default weight, which bounds what reaches the
driver. Pages are parsed one by one in Arrow batches with a single pass of one pattern.

Defined cases: null and empty html, and pages without words, give an empty
text. Cut-off markup at the end of a page is dropped; unclosed elements reach to
the end of the element around them, and keep their text also where a closed one (button,
select, noscript, ...) has none. A head without end tag ends at the body or the first of its elements. Repeated rows are extracted each. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notecodes.llm import textnum as tn
from notecodes.llm.common import setup

TRAIN_PAGES, LEAST_SHARE = 20_000, 0.002
#: Weights of keys that labelled pages do not have.
NEW_WORD, NEW_TAG = 0.3, -0.5

# Element and class names, as HTML and common practice have them.
#: Elements of plain characters: without an end tag they reach to the end of the page.
RAW = "script|style|textarea"
#: Elements whose content is no text of the page, if their end tag comes before that of the element around them.
DROPPED = frozenset("head noscript template svg iframe select button".split())
#: What a slash ends in the start tag (and all within svg and math).
FOREIGN = frozenset(["svg", "math"])
SLASHED = DROPPED | FOREIGN | {"object"}
HEAD_TAGS = frozenset("title meta link base basefont bgsound noscript template head html".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
#: Names of elements that are no part of the main text, as a rule: a prior for keys that labelled pages tell too little of.
FURNITURE_TAGS = frozenset("nav footer aside menu dialog".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement advertising adbox breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus "
    "footer masthead menu nav navbar navigation newsletter notice pager pagination paywall reactions reader-comments replies "
    "sidebar skip sponsor sponsored subscribe topbar".split()
)
#: The same for elements that are so unless they hold prose (a form around a whole page, a section on search).
UNSURE_TAGS = frozenset(["form"])
UNSURE_NAMES = frozenset("banner form header login modal notification popup promo promoted related search share sharing signup social tags toolbar widget".split())
#: Prose: as many words at least, and a sentence's end for each so many of them.
PROSE_WORDS, SENTENCE_WORDS = 20, 40
#: Words in labelled pages from which a key's weights overrule the prior.
KNOWN_WORDS = 30
#: Words of keys with such odds (20 to 1 outside) are left out of the region, too.
LEFT_OUT = -3.0

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _names(attributes: str) -> list[str]:
    return [n.lower() for m in _NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()]


_SENTENCE_END = re.compile(r"[.!?\u3002](?=[\s\"')\]]|$)")


class Page:
    """A parsed page: ``items`` are (is_word, key, text, container) in page order.

    ``key`` is the tag's own key, or that of a text's innermost container; ``container`` indexes the
    elements that hold others: ``parent`` (0: the page, html or body; a parent comes before its children),
    ``furniture`` (by the prior, itself or an element around it) and ``main`` (the number
    of its outermost article or main element, 0: outside). ``known``: keys that the prior does not judge.
    Parsing takes time linear in the page, however deeply its elements are nested.
    """

    def __init__(self, source: str, known: frozenset[str] = frozenset()):
        self.items: list[tuple[bool, str, str, int]] = []
        self.parent = [0]
        kinds: list[tuple[str, str, list[str]]] = [("", "page", [])]  # name, key and names of each container
        gone: list[bool] = [False]
        stack: list[tuple[str, str, int]] = [("", "page", 0)]  # name, key, container
        opened: list[tuple[int, int]] = [(0, 0)]  # items and containers before each element of the stack
        places: dict[str, list[int]] = {}  # of each name, where it is open in the stack
        head = 0  # place of an open head in the stack

        def leave(at: int) -> None:
            """Element ``at`` of the stack ends, and what is open in it."""
            nonlocal head
            if stack[at][0] in DROPPED:
                items, containers = opened[at]
                del self.items[items:]
                gone[containers:] = [True] * (len(gone) - containers)
            for name, _, _ in stack[at:]:
                places[name].pop()
            del stack[at:], opened[at:]
            if head >= at:
                head = 0

        for m in _TOKEN.finditer(source):
            raw, closing, name, attributes, text = m[1], m[2], m[3], m[4], m[5]
            if text is not None:
                if head and head == len(stack) - 1 and not text.isspace():
                    leave(head)
                self.items.append((True, *stack[-1][1:2], text, stack[-1][2]))
                continue
            if raw or name is None:
                continue
            name = name.lower()
            if head and not closing and (name == "body" or (name not in HEAD_TAGS and stack[-1][0] in ("head", "title"))):
                leave(head)
            if name in INLINE or name in VOID or name == "p" or (len(name) == 2 and name[0] == "h" and name[1].isdigit()):
                self.items.append((False, closing + name, "", stack[-1][2]))
                continue
            if closing:
                if places.get(name):
                    at = places[name][-1]
                    self.items.append((False, "/" + stack[at][1], "", stack[at][2]))
                    leave(at)
                else:
                    self.items.append((False, "/" + name, "", stack[-1][2]))
                continue
            if attributes.endswith("/") and (name in SLASHED or any(places.get(x) for x in FOREIGN)):
                continue
            if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1][0] == name:
                leave(len(stack) - 1)
            names = _names(attributes) if attributes else []
            key = f"{name}.{names[0]}" if names else name
            inside = stack[-1][2]
            opened.append((len(self.items), len(self.parent)))
            if name not in ("html", "body"):
                self.parent.append(inside)
                kinds.append((name, key, names))
                gone.append(False)
                inside = len(self.parent) - 1
            places.setdefault(name, []).append(len(stack))
            stack.append((name, key, inside))
            if name == "head" and not head and not places.get("body"):
                head = len(stack) - 1
            self.items.append((False, key, "", inside))
        if head:
            leave(head)
        self._mark(kinds, gone, known)

    def _mark(self, kinds: list[tuple[str, str, list[str]]], gone: list[bool], known: frozenset[str]) -> None:
        """``furniture`` and ``main`` of the containers."""
        many = len(self.parent)
        words, ends = [0] * many, [0] * many
        if any(name in UNSURE_TAGS or not UNSURE_NAMES.isdisjoint(names) for name, _, names in kinds):
            for is_word, _, text, c in self.items:
                if is_word:
                    words[c] += len(text.split())
                    ends[c] += len(_SENTENCE_END.findall(text))
            for c in range(many - 1, 0, -1):
                words[self.parent[c]] += words[c]
                ends[self.parent[c]] += ends[c]
        self.furniture, self.main, self.mains = [False] * many, [0] * many, 0
        for c in range(1, many):
            (name, key, names), up = kinds[c], self.parent[c]
            own = False
            if key not in known:
                prose = words[c] >= PROSE_WORDS and ends[c] * SENTENCE_WORDS >= words[c]
                if name not in MAIN:
                    own = not FURNITURE_NAMES.isdisjoint(names) or (not prose and not UNSURE_NAMES.isdisjoint(names))
                own = own or name in FURNITURE_TAGS or (name in UNSURE_TAGS and not prose) or (name == "header" and not self.main[up])
            self.furniture[c] = own or self.furniture[up]
            self.main[c] = self.main[up]
            if name in MAIN and not self.main[c] and not self.furniture[c] and not gone[c]:
                self.mains += 1
                self.main[c] = self.mains

    def labelled(self) -> bool:
        """Whether article or main elements hold most words that are not furniture (a teaser does not)."""
        inside = outside = 0
        for is_word, _, text, c in self.items:
            if is_word and not self.furniture[c]:
                n = len(text.split())
                inside, outside = (inside + n, outside) if self.main[c] else (inside, outside + n)
        return inside > outside

    def around(self, containers: set[int]) -> int:
        """The innermost container that holds all of ``containers``: containers are numbered in page order, so
        it is the one that holds the first and the last."""
        a, b = min(containers), max(containers)
        while a != b:  # a parent comes before its children
            a, b = min(a, self.parent[b]), max(a, self.parent[b])
        return a

    def within(self, container: int) -> set[int]:
        """``container`` and all containers in it (children come after their parents)."""
        found = {container}
        for c in range(container + 1, len(self.parent)):
            if self.parent[c] in found:
                found.add(c)
        return found


def _decoded(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key, how often labelled pages have it inside and outside their main element."""
    for batch in batches:
        for part in tn.slices(batch, "html"):
            seen: Counter = Counter()
            for source in part.column("html").to_pylist():
                page = Page(source or "")
                if page.mains == 1 and page.labelled():
                    for is_word, key, text, c in page.items:
                        weight = len(text.split()) if is_word else 1
                        if weight:  # what the prior calls furniture is outside also within an article
                            seen[is_word, key[:80], page.main[c] > 0 and not page.furniture[c]] += weight
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())],
                ["is_word", "key", "inside", "n"],
            )


class Weights:
    """Word weights by container key and tag weights by tag key. Keys with words enough in labelled pages
    have learned weights alone; the prior judges the others."""

    def __init__(self, counts: list[tuple[bool, str, int, int]]):
        self.word: dict[str, float] = {}
        self.tag: dict[str, float] = {}
        self.known = frozenset(key for is_word, key, inside, outside in counts if is_word and inside + outside >= KNOWN_WORDS)
        self.out: set[str] = set()
        for is_word, key, inside, outside in counts:
            odds = log((inside + 0.5) / (outside + 0.5))
            if is_word:
                self.word[key] = max(-1.0, min(1.0, odds)) or 0.1
                if odds <= LEFT_OUT and key in self.known:
                    self.out.add(key)
            else:
                self.tag[key] = -0.1 - max(0.0, min(1.0 if key.lstrip("/") in INLINE else 8.0, -odds))

    def region(self, page: Page) -> tuple[int, int]:
        """Bounds of the best-scoring run of items (empty when nothing scores above zero)."""
        best, bounds, run, begin = 0.0, (0, 0), 0.0, 0
        for i, (is_word, key, text, c) in enumerate(page.items):
            if is_word:
                n = len(text.split())
                score = n * (-1.0 if page.furniture[c] else self.word.get(key, NEW_WORD)) if n else 0.0
            else:
                score = self.tag.get(key, NEW_TAG)
            if run <= 0:
                run, begin = 0.0, i
            run += score
            if run > best:
                best, bounds = run, (begin, i + 1)
        return bounds

    def main_text(self, source: str | None) -> str:
        page = Page(source or "", self.known)
        a, b = self.region(page)
        left_out = lambda x: page.furniture[x[3]] or (x[0] and x[1] in self.out)
        region = [x for x in page.items[a:b] if x[0] and not left_out(x) and x[2].strip()]
        if region and (holder := page.around({x[3] for x in region})):
            inner = page.within(holder)
            items = [x for x in page.items if x[3] in inner]
        else:
            items = page.items[a:b]
        out = []
        for item in items:
            if item[0] and not left_out(item):
                out.append(_decoded(item[2]))
            elif left_out(item) or item[1].lstrip("/") not in INLINE:
                out.append(" ")
        return " ".join("".join(out).split())


def learn(pages: DataFrame) -> Weights:
    """Weights from the labelled pages of a sample of ``pages`` (page_id, html), chosen by a hash of the id."""
    setup(pages.sparkSession)
    total = max(1, pages.count())
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    if total > TRAIN_PAGES:
        source = source.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < int((1 << 20) * TRAIN_PAGES / total))
        total = TRAIN_PAGES
    source = source.select("html")
    got = (
        source.mapInArrow(_counts, "is_word boolean, key string, inside boolean, n long")
        .groupBy("is_word", "key").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("outside"))
        .where(F.col("inside") + F.col("outside") >= LEAST_SHARE * total).collect()
    )
    return Weights([(r["is_word"], r["key"], r["inside"], r["outside"]) for r in got])


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    weights = weights or learn(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "html"):
                texts = [weights.main_text(s) for s in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
