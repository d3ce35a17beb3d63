"""HTML as a tree of elements with the text runs of each, in time linear in the page.

The tree keeps what extraction needs. Elements are numbered in page order, so that an element's subtree is
a range. Blocks never stand inside inline elements: a block's start closes those that are open. Inline
content straight inside a container that may also hold blocks gets a ``#line`` element of its own.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Blocks that hold text only.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 pre dt legend summary caption #line".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; without an end tag, the first ones run to the page's end.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
SKIPPED = RAW | frozenset("audio button canvas datalist iframe map noscript object select svg template video".split())
#: Start tags that end an open element of these names, unless one of the last lies between.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
#: An end tag does not reach beyond these.
BARRIERS = ("td", "th", "caption", "table")

_MARKUP = re.compile(
    r"""<(?:!--(?:.*?--!?>|.*)|[!?][^>]*(?:>|\Z)|/(?:[^a-zA-Z>][^>]*)?(?:>|\Z)
    |(/?)([a-zA-Z][^\s/>]*+)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z))""",
    re.S | re.X,
)


class Page:
    """Parallel lists over elements (``parent``, ``tag``, ``attributes``, ``end``, ``depth``, ``linked``)
    and the text runs (element, block, text, in a link)."""

    def __init__(self, html: str):
        self.parent, self.tag, self.attributes, self.end, self.depth = [-1], ["#root"], [""], [0], [0]
        self.runs: list[tuple[int, int, str, bool]] = []
        self._stack, self._places = [0], {"#root": [0]}
        self._blocks = [0]  # places of open blocks in the stack
        self._block = 0
        self._link = -1  # place of the block that holds the open link
        self._read(html)
        self._pop(0)
        self.end[0] = len(self.parent)

    def _push(self, name: str, attributes: str, block: bool) -> None:
        self.parent.append(self._stack[-1])
        self.depth.append(len(self._stack))
        self.tag.append(name)
        self.attributes.append(attributes)
        self.end.append(0)
        place = len(self._stack)
        self._stack.append(len(self.parent) - 1)
        self._places.setdefault(name, []).append(place)
        if block:
            self._blocks.append(place)

    def _pop(self, place: int) -> None:
        """Close all above and, but for the root, at a place of the stack."""
        while len(self._stack) > max(place, 1):
            node = self._stack.pop()
            self.end[node] = len(self.parent)
            self._places[self.tag[node]].pop()
            if self._blocks[-1] == len(self._stack):
                self._blocks.pop()
                if self._link == len(self._stack):
                    self._link = -1

    def _last(self, *names: str) -> int:
        return max((self._places[n][-1] for n in names if self._places.get(n)), default=-1)

    def _top(self) -> str:
        return self.tag[self._stack[self._blocks[-1]]]

    def _boundary(self) -> None:
        self._block += 1
        self._pop(self._blocks[-1] + 1)  # inline elements
        if self._top() == "#line":
            self._pop(self._blocks[-1])

    def _inline(self) -> None:
        if self._top() == "head":
            self._boundary()
            self._pop(self._blocks[-1])
        if self._top() not in LINES and self._blocks[-1] == len(self._stack) - 1:
            self._push("#line", "", True)

    def _text(self, text: str) -> None:
        if not text:
            return
        text = unescape(text) if "&" in text else text
        if not text.strip():
            if self._blocks[-1] < len(self._stack) - 1 or self._top() in LINES:
                self.runs.append((self._stack[-1], self._block, " ", False))
            return
        self._inline()
        self.runs.append((self._stack[-1], self._block, text, self._link >= 0))

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name in BLOCKS:
            self._boundary()
            if self._top() == "p" or (self._top() == "head" and name != "html"):
                self._pop(self._blocks[-1])
            if name in IMPLIED:
                closed, within = IMPLIED[name]
                if (place := self._last(*closed)) > self._last(*within):
                    self._pop(place)
            if name not in VOID:
                self._push(name, attributes, True)
        elif name not in VOID:
            self._inline()
            if name == "a":
                self._link = self._blocks[-2 if self._top() == "#line" else -1]
            self._push(name, attributes, False)

    def _finish(self, name: str) -> None:
        if name == "br":
            self._text(" ")
        elif name in BLOCKS:
            self._boundary()
            if name in ("html", "body"):
                return
            place = self._last(name)
            if place > (self._last(*BARRIERS) if name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption") else self._last("table") - 1):
                self._pop(place)
        else:
            if name == "a":
                self._link = -1
            if (place := self._last(name)) > self._blocks[-1]:
                self._pop(place)

    def _read(self, html: str) -> None:
        at, size, endless = 0, len(html), set()
        while at < size:
            found = _MARKUP.search(html, at)
            if found is None:
                self._text(html[at:])
                return
            self._text(html[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            name = found[2].lower()
            if found[1]:
                if name not in SKIPPED:
                    self._finish(name)
            elif name in SKIPPED:
                if name in endless or found[3].endswith("/") and name not in RAW:
                    continue
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                if closing:
                    at = closing.end()
                elif name in RAW:
                    return
                else:
                    endless.add(name)
            else:
                self._start(name, found[3])


def blocks_of(runs) -> list[str]:
    """The texts of runs (block, text), one per block that has any, white space as single spaces."""
    found: list[str] = []
    held: list[str] = []
    current = None
    for block, text in runs:
        if block != current and held:
            found.append("".join(held))
            held = []
        current = block
        held.append(text)
    if held:
        found.append("".join(held))
    return [text for text in (" ".join(x.split()) for x in found) if text]
