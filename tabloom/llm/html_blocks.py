"""HTML to a list of leaf blocks: text with the tags around it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# HTML elements by their part in the block structure.
FOREIGN = frozenset(
    "svg g path circle ellipse rect line polyline polygon defs use symbol text tspan math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle "
    "merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation "
    "annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = FOREIGN | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup "
    "time tt u var ruby rb rt rp img br wbr picture audio video source track map area input meter progress output object param embed canvas noscript".split()
)
RAW = frozenset("script style noscript template svg textarea select iframe title".split())
SHOWN = frozenset("svg textarea select iframe".split())  # of RAW, what parts the words around it
# What ends an svg or math that is still open, as in the HTML standard.
LEAVES_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}

#: mark of an element: tag names that carry it, and what its class, id or role must contain
MARKS = {
    "nav": ("nav", r"nav|menu|breadcrumb|toc|pagination|pager|skip-?link"),
    "header": ("header", r"header|masthead|banner|top-?bar|site-title"),
    "footer": ("footer", r"footer|colophon|copyright|legal"),
    "aside": ("aside", r"aside|sidebar|side-?bar|widget|related|rail|recommend|trending|popular"),
    "ad": ("ins", r"(?<![a-z])ads?(?![a-z])|advert|sponsor|promo|adsense|outbrain|taboola"),
    "notice": ("dialog", r"cookie|consent|notice|alert|popup|modal|overlay|newsletter|subscribe|gdpr|paywall"),
    "form": ("form fieldset button", r"(?<![a-z])form(?![a-z])|search|login|signup|sign-up"),
    "comment": ("", r"comment|repl(y|ies)|disqus|discussion|respond"),
    "share": ("", r"share|social|follow|byline-tools"),
    "article": ("article main", r"article|(?<![a-z])post(?![a-z])|entry|story|hentry"),
    "content": ("", r"content|(?<![a-z])main(?![a-z])|body|text"),
}
NAMES = list(MARKS)
_BY_TAG = {tag: k for k, (tags, _) in enumerate(MARKS.values()) for tag in tags.split()}
_BY_CLASS = [(k, re.compile(pattern, re.I)) for k, (_, pattern) in enumerate(MARKS.values())]
_TAG = re.compile(r"/?[a-zA-Z][^\s/>]*")
_SVG = re.compile(rf"<(/?svg|(?:{'|'.join(sorted(LEAVES_FOREIGN))}))(?=[\s/>])", re.I)
_SELECT_END = re.compile(r"</select(?=[\s/>])|<(?:select|input|textarea)(?=[\s/>])", re.I)
_TO_QUOTE = re.compile(r"[^\"'>]*")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    tag: str
    marks: int
    inner: int  # the innermost mark, -1 without
    link_chars: int


class _Open(NamedTuple):
    tag: str
    marks: int
    inner: int
    block: str


def _tag_end(page: str, at: int) -> int:
    """Position of the `>` that ends the tag; quoted values may hold one. Without an end, the end of the page."""
    start = at
    while True:
        at = _TO_QUOTE.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            break
        closing = page.find(page[at], at + 1)
        if closing < 0:  # a stray quote
            at = page.find(">", start)
            return at if at >= 0 else len(page)
        at = closing + 1
    return min(at, len(page))


def _marks_of(attributes: str, tag: str, above: _Open) -> tuple[int, int]:
    marks, inner = above.marks, above.inner
    found = _BY_TAG.get(tag)
    if found is not None:
        marks, inner = marks | 1 << found, found
    elif attributes:
        words = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(attributes))
        if words:
            for k, pattern in _BY_CLASS:
                if pattern.search(words):
                    marks, inner = marks | 1 << k, k
                    break
    return marks, inner


def _closed_svgs(page: str) -> dict[int, int]:
    """Position of the end of each svg that is closed before a tag that leaves it, by the position behind its opening name."""
    found, open_ = {}, []
    for tag in _SVG.finditer(page):
        name = tag.group(1).lower()
        if name == "svg":
            if page[_tag_end(page, tag.end()) - 1] != "/":
                open_.append(tag.end())
        elif name != "/svg":
            open_.clear()
        elif open_:
            found[open_.pop()] = tag.end()
    return found


class _Builder:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack = [_Open("html", 0, -1, "body")]
        self.parts: list[str] = []
        self.link_chars = 0
        self.links = 0
        self.count: dict[str, int] = {}

    def text(self, data: str) -> None:
        if data:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data.strip())

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                top = self.stack[-1]
                self.blocks.append(Block(text, top.block, top.marks, top.inner, min(self.link_chars, len(text))))
            self.parts, self.link_chars = [], 0

    def pop(self) -> None:
        gone = self.stack.pop()
        self.count[gone.tag] -= 1
        self.links -= gone.tag == "a"

    def open(self, tag: str, attributes: str) -> None:
        if tag in LEAVES_FOREIGN:
            for foreign in ("svg", "math"):
                while self.count.get(foreign):
                    self.close(foreign)
        if tag == "br" or tag == "wbr" or tag in FOREIGN and attributes.endswith("/"):
            self.parts.append(" ")
            return
        inline = tag in INLINE
        if not inline:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and self.count.get("p"):
            self.close("p")
        elif tag in SIBLINGS:
            ends, within = SIBLINGS[tag]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in within:
                    break
                if self.stack[k].tag in ends.split():
                    while len(self.stack) > k:
                        self.pop()
                    break
        above = self.stack[-1]
        marks, inner = _marks_of(attributes, tag, above)
        self.stack.append(_Open(tag, marks, inner, above.block if inline else tag))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.links += tag == "a"

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if self.count.get(tag):
            while True:
                top = self.stack[-1].tag
                self.pop()
                if top == tag:
                    break


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in their order; linear in its length, whatever is unclosed or broken.

    Left out: markup, comments, scripts, styles and the other elements of RAW,
    which do not part a block. Without its closing tag a svg or noscript is an
    element as any other, a select ends at the next field, and the others take
    the rest of the page, as in a browser.
    """
    builder = _Builder()
    svgs, unclosed = None, set()
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            builder.text(page[at:])
            break
        builder.text(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            at = _tag_end(page, start + 2) + 1
            continue
        found = _TAG.match(page, start + 1)
        if found is None:  # a plain less-than sign
            builder.text("<")
            at = start + 1
            continue
        end = _tag_end(page, found.end())
        name, at = found.group().lower(), end + 1
        if name[0] == "/":
            builder.close(name[1:])
            continue
        attributes = page[found.end() : end]
        if name in RAW and name not in unclosed and not attributes.endswith("/"):
            if name == "svg":
                svgs = _closed_svgs(page) if svgs is None else svgs
                close = svgs.get(found.end())
                after = None if close is None else _tag_end(page, close) + 1
            else:
                closing = (_SELECT_END if name == "select" else re.compile(f"</{name}(?=[\\s/>])", re.I)).search(page, at)
                if closing is None:
                    after = None if name == "noscript" else size
                    unclosed.add(name)
                else:  # the field that ends a select is a tag of its own
                    after = _tag_end(page, closing.end()) + 1 if closing.group()[1] == "/" else closing.start()
            if after is not None:
                if name in SHOWN:
                    builder.parts.append(" ")
                at = after
                continue
        builder.open(name, attributes)
    builder.flush()
    return builder.blocks
