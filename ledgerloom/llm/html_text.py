"""Main text of web pages by tree scoring.

A page becomes a tree of elements and a list of blocks, runs of text between the borders of block elements. Blocks
of some length pass points, for themselves, their commas and their length, to the element around them, half of that
to the next one and less further up, `REACH` levels at most. Work is linear in the elements and blocks. The element with the most points, discounted by the share of its text that
lies in links, is the article; siblings with a fair share of its points, and paragraphs and headings beside it, are
kept with it. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments never enter the tree:
they are known by their elements, roles or class names.

Defined results: a null or empty page, or one without text outside such parts, gives an empty text. Unclosed and
misnested elements are closed as browsers do, an element cut off at the end of the page is left out, and a stray
`<` is text. Rows are independent: repeated rows and other columns change nothing, an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, with_text

# Element names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html tbody td tfoot th thead tr caption legend".split())
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
PARAGRAPHS = frozenset("p pre td th li blockquote dd dt figcaption h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Parameters: what is never article text.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template svg canvas audio video object iframe button select "
    "textarea input label dialog menu head title search".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar tablist".split()
)
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar cookie "
    "cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments disqus respond replies share sharing social related recommended widget form search skip".split()
)
ARTICLE_NAMES = frozenset("article post entry story main".split())
ARTICLES = frozenset(["article", "main"])
RUNNING_TEXT = HEADINGS | frozenset(["p", "pre"])
NEVER_DROPPED = frozenset("html body article main".split())
SHORTEST, SIBLING_SHARE, SIBLING_LENGTH = 25, 0.2, 80
# Levels up to which a block passes points; at the last one it passes less than a hundredth of them.
REACH = 64

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?:(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(?P<odd>[^>]*)(?:>|(?P<cut>\Z)))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE) for name in RAW}
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

OUTPUT = T.StructType([T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])


def is_dropped(name: str, rest: str, in_article: bool = False) -> bool:
    """Whether an element with these attributes is no part of any article.

    Any part of a class or id that says so is enough; for paragraphs, headings and preformatted text within an `article`
    or `main` a whole name must, as `share-price` or `notice-board` say nothing there.
    """
    if name in DROPPED:
        return True
    if name in NEVER_DROPPED or not rest.strip():
        return False
    found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(rest)}
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in DROPPED_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.IGNORECASE):
        return True
    given = found.get("class", "") + " " + found.get("id", "")
    if in_article and name in RUNNING_TEXT:
        return bool(DROPPED_NAMES & set(given.lower().split()))
    names = {p.lower() for p in NAME_PARTS.findall(given)}
    return bool(names & DROPPED_NAMES) and not names & ARTICLE_NAMES


class Page:
    """The tree and the blocks of one page. Elements are numbers; 0 is the root."""

    def __init__(self, html: str):
        self.names, self.parents = ["#root"], [-1]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._stack = [0]
        self._open_names: Counter[str] = Counter()
        self._dropped_at = 0  # size of the stack at which a dropped element opened, 0 outside
        self._links = 0
        self._parts: list[tuple[str, bool]] = []
        at = 0
        while match := TAG.search(html, at):
            self._text(html[at : match.start()])
            at = match.end()
            name = (match["name"] or "").lower()
            if not name or match["cut"] is not None:
                continue
            if match["close"]:
                self._close(name)
                continue
            rest = match["rest"] if match["rest"] is not None else match["odd"]
            self._open(name, rest)
            if name in RAW:
                end = RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
                self._close(name)
        self._text(html[at:])
        self._end_block()

    def _text(self, text: str) -> None:
        if text and not self._dropped_at:
            self._parts.append((text, self._links > 0))

    def _end_block(self) -> None:
        if not self._parts:
            return
        text = " ".join(unescape("".join(part for part, _ in self._parts)).split())
        if text:
            linked = " ".join(unescape("".join(part for part, link in self._parts if link)).split())
            around = next(e for e in reversed(self._stack) if e == 0 or self.names[e] in BLOCKS)
            self.blocks.append((around, text, len(linked)))
        self._parts = []

    def _pop_to(self, size: int) -> None:
        for element in self._stack[size:]:
            if self.names[element] in BLOCKS:
                self._end_block()
                break
        closed = [self.names[element] for element in self._stack[size:]]
        self._links -= closed.count("a")
        self._open_names.subtract(closed)
        del self._stack[size:]
        if self._dropped_at > size:
            self._dropped_at = 0

    def _find(self, wanted: frozenset[str], stop: frozenset[str] = frozenset()) -> int:
        """Place of the innermost open element of that name, 0 if there is none before one of `stop`."""
        if not any(self._open_names[name] for name in wanted):
            return 0
        for place in range(len(self._stack) - 1, 0, -1):
            name = self.names[self._stack[place]]
            if name in wanted:
                return place
            if name in stop:
                return 0
        return 0

    def _open(self, name: str, rest: str) -> None:
        if name in CLOSES_PARAGRAPH and (place := self._find(frozenset(["p"]), SCOPES)):
            self._pop_to(place)
        if name in CLOSED_BY:
            wanted, stop = CLOSED_BY[name]
            while place := self._find(wanted, stop):
                self._pop_to(place)
        if name == "a" and self._links and (place := self._find(frozenset(["a"]), BLOCKS)):
            self._pop_to(place)
        if name == "br":
            self._text(" ")
        if name in BLOCKS:
            self._end_block()
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            return
        self.names.append(name)
        self.parents.append(self._stack[-1])
        self._stack.append(len(self.names) - 1)
        self._links += name == "a"
        in_article = any(self._open_names[article] for article in ARTICLES)
        self._open_names[name] += 1
        if not self._dropped_at and is_dropped(name, rest, in_article):
            self._end_block() if name in BLOCKS else None
            self._dropped_at = len(self._stack)

    def _close(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self._text(" ")
        stop = frozenset(["table"]) if name not in BLOCKS else frozenset()
        if place := self._find(frozenset([name]), stop):
            self._pop_to(place)

    def article(self) -> list[str]:
        """The texts of the blocks of the article, in page order."""
        points: dict[int, float] = {}
        for element, text, linked in self.blocks:
            if len(text) < SHORTEST or element == 0 and len(self.names) == 1:
                continue
            worth = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
            around = self.parents[element] if self.names[element] in PARAGRAPHS else element
            level = 0
            while around > 0 and level <= REACH:
                points[around] = points.get(around, 0.0) + worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
                around, level = self.parents[around], level + 1
        size = self._sizes()

        def rated(element: int) -> float:
            total, linked = size[element]
            return points[element] * (1 - linked / total)

        if not points:
            whole = {e for e, name in enumerate(self.names) if name in ARTICLES}
            return self._texts_in(whole) if whole else [text for _, text, _ in self.blocks]
        best = max(points, key=lambda e: (round(rated(e), 9), -e))
        above = best
        while above > 0:  # an element marked as the article holds all of it
            if self.names[above] in ARTICLES:
                best = above
            above = self.parents[above]
        kept = {best} | self._siblings(best, points, size, SIBLING_SHARE * rated(best) if best in points else 0.0)
        return self._texts_in(kept)

    def _sizes(self) -> dict[int, tuple[int, int]]:
        """Characters of text and of text in links within each element that has any, added up from the leaves."""
        texts, links = [0] * len(self.names), [0] * len(self.names)
        for element, text, linked in self.blocks:
            texts[element] += len(text)
            links[element] += linked
        for element in range(len(self.names) - 1, 0, -1):  # an element comes after the one around it
            texts[self.parents[element]] += texts[element]
            links[self.parents[element]] += links[element]
        return {e: (texts[e], links[e]) for e in range(1, len(self.names)) if texts[e]}

    def _texts_in(self, kept: set[int]) -> list[str]:
        """The blocks within any of the elements."""
        inside = [False] * len(self.names)
        for element in range(1, len(self.names)):
            inside[element] = element in kept or inside[self.parents[element]]
        return [text for element, text, _ in self.blocks if inside[element]]

    def _siblings(self, best: int, points: dict, size: dict, share: float) -> set[int]:
        kept = set()
        for element in range(1, len(self.names)):
            if self.parents[element] != self.parents[best] or element not in size:
                continue
            total, linked = size[element]
            plain = linked < 0.25 * total
            if plain and points.get(element, 0.0) >= max(share, 1.0):
                kept.add(element)
            elif plain and self.names[element] == "p" and total > SIBLING_LENGTH:
                kept.add(element)
            elif plain and self.names[element] in HEADINGS:
                kept.add(element)
        return kept


SCOPES = frozenset("table td th button object caption html template".split())


def main_text(html: str | None) -> str:
    """The blocks of the article, one line each."""
    return "\n".join(Page(html).article()) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` (code points of `text`) of every page."""

    def run(batches):
        for batch in in_slices(batches):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            kept = [batch.column(name) for name in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays([*kept, *columns], ["page_id", "url", *OUTPUT.names])

    narrow = with_text(pages, "page_id", "url", "html")
    return narrow.mapInArrow(run, T.StructType([narrow.schema["page_id"], narrow.schema["url"], *OUTPUT.fields]))
