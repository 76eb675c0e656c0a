"""What one HTML page says: title, text blocks, loose text and links. A small stdlib reader, run page by page in Arrow
passes (``pages.parse_pages``).

Blocks are headings, paragraphs, list items and table rows, each with all of its text: what is nested inside is a block
of its own as well. An unclosed paragraph, item or row ends where the next begins. Of several main elements the one with
the most text counts. A page whose blocks hold no text has its text as ``loose`` lines instead.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from datetime import date
from html.parser import HTMLParser
from itertools import accumulate

#: Elements whose text is no part of the page's.
SKIPPED = ("script", "style", "noscript", "nav", "footer", "header")
#: Elements that are blocks, and their kinds.
BLOCK_KINDS = {"h1": "heading", "h2": "heading", "h3": "heading", "p": "text", "li": "text", "tr": "table"}
#: Elements that hold a page's main text, by tag, id or class.
MAIN_TAGS, MAIN_IDS = ("article", "main"), ("UCAP-CONTENT",)
MAIN_CLASSES = ("TRS_Editor", "article-content", "article_content", "content")
#: Marks of pages that load their text by script, dates in link texts, words of links to the next page.
DYNAMIC = re.compile(r"(__NEXT_DATA__|webpack|ajax|iframe|加载中|请开启JavaScript)", re.I)
DATE = re.compile(r"(?<!\d)(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})日?")
NEXT_WORDS = re.compile(r"下一页|下页|next|后页", re.I)

#: Fixed values of HTML: elements without content, those that end an open paragraph, those that a paragraph can't reach over.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENDS_PARAGRAPH = (
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
)
#: By element: those that it ends, and those that keep it from looking further out.
IMPLIED = {tag: (("p",), ("table", "td", "th", "caption", "button", "object", "template")) for tag in ENDS_PARAGRAPH}
IMPLIED |= {"li": (("li",), ("ul", "ol", "menu", "table")), "tr": (("tr",), ("table",))}
#: Blocks that a text can be in at once: one more, and the outermost ends there. Keeps pages of any nesting linear.
MOST_NESTED = 16
_UNSEEN = ("script", "style")


@dataclass
class _Element:
    tag: str
    start: int
    main: str | None = None
    block: int | None = None
    links: list[int] = field(default_factory=list)


@dataclass
class Link:
    href: str
    label: str
    is_next: bool
    date_hint: date | None
    skipped: bool


@dataclass
class Page:
    title: str | None
    blocks: list[tuple[str, str]]
    loose: str | None
    links: list[Link]
    dynamic: bool


class _Reader(HTMLParser):
    """Collects text pieces in order, and elements as ranges of pieces."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.kept: list[bool] = []
        self.stack: list[_Element] = []
        self.places: dict[str, list[int]] = {}  # by tag, where its open elements are in the stack
        self.skipped = 0
        self.title: list[str] | None = None
        self.titles: list[str] = []
        self.blocks: list[list] = []  # [kind, start, end]
        self.nested: list[int] = []
        self.mains: dict[str, tuple[int, int]] = {}
        self.seen_mains: set[str] = set()
        self.links: list[list] = []  # [href, rel, skipped, label's range, parent's range]
        self.link: int | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_implied(tag)
        named = {k: v or "" for k, v in attrs}
        if tag == "a" and named.get("href"):
            self._end_link()
            self.link = len(self.links)
            self.links.append([named["href"].strip(), named.get("rel", ""), self.skipped > 0, [len(self.pieces), None], None])
            if self.stack:
                self.stack[-1].links.append(self.link)
        if tag in VOID:
            return
        element = _Element(tag, len(self.pieces))
        self.skipped += tag in SKIPPED
        if not self.skipped:
            element.main = self._main(tag, named)
            if tag in BLOCK_KINDS:
                element.block = len(self.blocks)
                self.blocks.append([BLOCK_KINDS[tag], len(self.pieces), None])
                self.nested.append(element.block)
                if len(self.nested) > MOST_NESTED:
                    self._end_block(self.nested[0])
        if tag == "title" and not self.titles:
            self.title = []
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(element)

    def _innermost(self, tags: tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _main(self, tag: str, named: dict[str, str]) -> str | None:
        """The first element of each kind of main element is one."""
        names = [tag] if tag in MAIN_TAGS else []
        names += [f"#{i}" for i in MAIN_IDS if named.get("id") == i] + [f".{c}" for c in MAIN_CLASSES if c in named.get("class", "").split()]
        new = [n for n in names if n not in self.seen_mains]
        self.seen_mains.update(new)
        return new[0] if new else None

    def _end_implied(self, tag: str) -> None:
        ended, borders = IMPLIED.get(tag, ((), ()))
        i = self._innermost(ended)
        if i > self._innermost(borders):
            self._end_from(i)

    def _end_block(self, block: int) -> None:
        if block in self.nested:
            self.nested.remove(block)
            self.blocks[block][2] = len(self.pieces)

    def _end_link(self) -> None:
        if self.link is not None:
            self.links[self.link][3][1] = len(self.pieces)
            self.link = None

    def _end_from(self, i: int) -> None:
        """The element and all that is open inside end here."""
        for element in reversed(self.stack[i:]):
            end = len(self.pieces)
            if element.block is not None:
                self._end_block(element.block)
            if element.main:
                self.mains[element.main] = (element.start, end)
            for link in element.links:
                self.links[link][4] = (element.start, end)
            if element.tag == "a":
                self._end_link()
            if element.tag == "title" and self.title is not None:
                self.titles.append(" ".join(self.title))
                self.title = None
            self.skipped -= element.tag in SKIPPED
            self.places[element.tag].pop()
        del self.stack[i:]

    def handle_endtag(self, tag: str) -> None:
        i = self._innermost((tag,))
        if i >= 0:
            self._end_from(i)

    def handle_data(self, data: str) -> None:
        piece = data.strip()
        if not piece or self.stack and self.stack[-1].tag in _UNSEEN:
            return
        if self.title is not None:
            self.title.append(piece)
        self.pieces.append(piece)
        self.kept.append(not self.skipped)


def _first_date(text: str) -> tuple[bool, date | None]:
    """Whether there is a date, and the first one if there is such a day."""
    m = DATE.search(text)
    if not m:
        return False, None
    try:
        return True, date(*map(int, m.groups()))
    except ValueError:
        return True, None


def _links(reader: _Reader) -> list[Link]:
    dated = [(i, d) for i, piece in enumerate(reader.pieces) for has, d in [_first_date(piece)] if has]
    places, out = [i for i, _ in dated], []
    for href, rel, skipped, (start, end), parent in reader.links:
        label = " ".join(reader.pieces[start:end])
        has, hint = _first_date(label)
        if not has:  # then the first one in the element around
            first, last = parent or (0, len(reader.pieces))
            at = bisect_left(places, first)
            hint = dated[at][1] if at < len(places) and places[at] < last else None
        out.append(Link(href, label, rel.lower().split() == ["next"] or bool(NEXT_WORDS.search(label)), hint, skipped))
    return out


def read_page(html: str | None) -> Page:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader._end_from(0)
    reader._end_link()
    text = lambda start, end, by: by.join(p for p, kept in zip(reader.pieces[start:end], reader.kept[start:end], strict=True) if kept)
    size = [0, *accumulate((len(p) + 1) * kept for p, kept in zip(reader.pieces, reader.kept, strict=True))]
    root = max(reader.mains.values(), key=lambda m: size[m[1]] - size[m[0]], default=(0, len(reader.pieces)))
    inside = [(kind, text(start, end, " ")) for kind, start, end in reader.blocks if root[0] <= start and end <= root[1]]
    blocks = [(t, kind) for kind, t in inside if t]
    loose = None if blocks else text(*root, "\n")
    return Page(reader.titles[0] or None if reader.titles else None, blocks, loose, _links(reader), bool(DYNAMIC.search(html or "")))
