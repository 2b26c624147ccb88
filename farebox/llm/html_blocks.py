"""HTML text as a sequence of leaf blocks with their tag paths."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from functools import lru_cache
from html import unescape
from typing import NamedTuple

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>|[^<]++|<", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+|\d+")

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_NOT_IN_P = BLOCK - frozenset("body button caption head html legend option tbody td tfoot th thead tr".split())
_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
}
_SCOPES = frozenset("ul ol menu dl table tbody thead tfoot article section main body div aside nav form select".split())
_IN_SELECT = frozenset("option optgroup hr button legend".split())
OUTER = INNER = 32  # elements of a block's path from the page down, and from the block up, that are kept


class Element(NamedTuple):
    tag: str
    names: tuple[str, ...]  # the words of its class, id and role


class Block(NamedTuple):
    path: tuple[Element, ...]  # at most OUTER + INNER elements
    text: str
    linked: int  # characters of the text inside links


@lru_cache(maxsize=1 << 12)
def _element(tag: str, attributes: str) -> Element:
    names: list[str] = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            names += _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", "".join(values)).lower())
    return Element(tag, tuple(names))


class _Open:
    """The open elements, with the places of each tag, so that no look-up walks over them."""

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, element: Element) -> None:
        at = len(self.elements)
        self.elements.append(element)
        self.places[element.tag].append(at)
        if element.tag in BLOCK:
            self.blocks.append(at)
        if element.tag in _SCOPES:
            self.scopes.append(at)

    def close_to(self, at: int) -> None:
        elements, places, blocks, scopes = self.elements, self.places, self.blocks, self.scopes
        while len(elements) > at:
            places[elements.pop().tag].pop()
        while blocks and blocks[-1] >= at:
            blocks.pop()
        while scopes and scopes[-1] >= at:
            scopes.pop()

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def end(self, tag: str) -> None:
        """An end tag closes the last element of its name, but an inline one closes no block."""
        at = self.last(tag)
        if at >= 0 and (tag in BLOCK or not self.blocks or self.blocks[-1] < at):
            self.close_to(at)

    def make_room(self, tag: str) -> None:
        """Close what a start tag of a block ends: an open p, select, or item of the same list or table."""
        if tag not in _IN_SELECT and self.last("select") >= 0:
            self.close_to(self.places["select"][0])
        if tag in _NOT_IN_P and self.blocks and self.elements[self.blocks[-1]].tag == "p":
            self.close_to(self.blocks[-1])
        if tag not in _SAME:
            return
        scope = self.scopes[-1] if self.scopes else -1
        lowest = len(self.elements)
        for other in _SAME[tag]:
            places = self.places.get(other, [])
            above = bisect_right(places, scope)
            if above < len(places):
                lowest = min(lowest, places[above])
        if lowest < len(self.elements):
            self.close_to(lowest)

    def path(self) -> tuple[Element, ...]:
        if len(self.elements) <= OUTER + INNER:
            return tuple(self.elements)
        return (*self.elements[:OUTER], *self.elements[-INNER:])


def _plain(text: str) -> str:
    """Character references decoded, white space inside made one space, none at the ends."""
    return " ".join((unescape(text) if "&" in text else text).split())


def blocks(html: str | None) -> list[Block]:
    """The text blocks in page order.

    A block is the text between two block-level tags; inline tags do not part it and br counts as
    white space. Character references are decoded, white space becomes one space, empty blocks are
    left out. Comments, scripts, styles, titles and other raw elements have no block. End tags that
    are missing, and elements left open by broken markup, are closed where HTML closes them. Of paths
    deeper than ``OUTER + INNER`` elements the middle is left out, so time and memory follow the
    length of the page, however its tags nest.
    """
    out: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if parts:
            text = _plain("".join(parts))
            if text:
                link = _plain("".join(linked)) if linked else ""
                out.append(Block(stack.path(), text, min(len(link), len(text))))
            parts.clear()
            linked.clear()

    links = stack.places["a"]
    text = html or ""
    at, last = 0, text.rfind(">")
    while at < len(text):
        if at > last and not text.startswith("<!--", at):  # no tag can end from here on
            end = text.find("<!--", at)
            token_text = text[at : end if end >= 0 else len(text)]
            parts.append(token_text)
            if links:
                linked.append(token_text)
            at += len(token_text)
            continue
        token = _TOKEN.match(text, at)
        at = token.end()
        tag = token[2]
        if tag is None:
            if token[0][:2] not in ("<!", "<?"):
                parts.append(token[0])
                if links:
                    linked.append(token[0])
            continue
        tag = tag.lower()
        if token[1]:
            if tag in BLOCK:
                flush()
            stack.end(tag)
        elif tag == "br":
            parts.append(" ")
        elif tag in RAW:
            if not token[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(text, at)
                at = end.end() if end else len(text)
            parts.append(" ")
        else:
            if tag in BLOCK:
                flush()
                stack.make_room(tag)
            if tag not in VOID and (not token[3].endswith("/") or tag in BLOCK):
                stack.push(_element(tag, token[3]))
    flush()
    return out


_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\b", re.I | re.S)
_LINK = re.compile(r"<a\b((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>", re.I)


def title_and_links(html: str) -> tuple[str | None, list[str]]:
    """The page title, and the href of each link in page order."""
    title = _TITLE.search(html)
    links = []
    for attributes in _LINK.findall(html):
        for name, *values in _ATTRIBUTE.findall(attributes):
            if name.lower() == "href":
                links.append(unescape("".join(values)))
    return (_plain(title[1]) if title else None), links
