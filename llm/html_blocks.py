"""Leaf blocks of raw HTML: text between block-level tags, with the open block elements above it.

One pass, linear in the page whatever it holds: no tag is read twice, elements below DEPTH open ones are
not opened (their text counts as their parent's), and what a block has above it is one set of hashed
steps, extended from parent to child.
"""

from __future__ import annotations

import html
import re
import zlib
from typing import NamedTuple

#: Bits of a step's hash, and the deepest nesting that is told apart.
STEP_BITS, DEPTH = 12, 256
# Quotes hold a value only after an equals sign; elsewhere, and where they are never closed, they are characters like any other.
_TAG = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_OTHER = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:[!?]|/[^A-Za-z])[^>]*+(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?![\w-])", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
#: Elements whose content is never text of the page.
SILENT = frozenset("script style head title noscript template svg math iframe object canvas select option button textarea audio video".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that neither begin nor end a block; silent ones don't either.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
FLOW = INLINE | SILENT | {"br"}
#: Elements that an opening tag of the same group closes, up to the nearest scope.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: What may stand in a head; any other element ends one whose end tag is left out, as text does.
_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Silent elements that hold none of their own name: the next tag of that name must be the end tag.
_FLAT = frozenset("noscript iframe canvas select button textarea title audio video".split())
_SCOPE = frozenset("ul ol dl table body html div article section main".split())


class Block(NamedTuple):
    """steps has a bit for the hash of every step above the text, depth is how many there are, and leaf is the nearest block element."""

    steps: int
    depth: int
    leaf: str
    text: str
    link_chars: int


def step(name: str) -> int:
    return zlib.crc32(name.encode()) >> (32 - STEP_BITS)


def _steps(name: str, attrs: str) -> list[str]:
    """The element's name, and the words of its class, id, role and itemprop."""
    found = [name]
    for m in _ATTR.finditer(attrs) if attrs else ():
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() in ("hidden", "aria-hidden"):
            if value.lower() != "false":
                found.append("hidden")
        else:
            found += [f".{w.lower()}" for w in _WORD.findall(value)]
    return found


class _Element(NamedTuple):
    name: str
    open_ended: bool  # silent, and without an end tag
    steps: int
    depth: int
    leaf: str


class _Page:
    def __init__(self, page: str):
        self.page = page
        self.blocks: list[Block] = []
        self.stack: list[_Element] = []
        self.walls: list[int] = []  # places of those elements of the stack that aren't inline
        self.open: dict[str, int] = {}  # how often each name is in the stack
        self.open_ended: list[int] = []
        self.parts: list[str] = []
        self.linked = self.silent = self.foreign = 0
        self.last_end: dict[str, int] = {}

    def close_block(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            self.parts.clear()
            if text:
                top = self.stack[-1] if self.stack else _Element("", False, 0, 0, "")
                self.blocks.append(Block(top.steps, top.depth, top.leaf, text, self.linked))
        self.linked = 0

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            e = self.stack.pop()
            self.open[e.name] -= 1
            if self.walls and self.walls[-1] == len(self.stack):
                self.walls.pop()
            if e.open_ended:
                self.open_ended.pop()
            self.silent -= e.name in SILENT
            self.foreign -= e.name in ("svg", "math")

    def push(self, name: str, attrs: str, open_ended: bool) -> None:
        if len(self.stack) >= DEPTH and name not in SILENT:
            return
        above = self.stack[-1] if self.stack else _Element("", False, 0, 0, "")
        steps, depth, leaf = above.steps, above.depth, above.leaf
        if name not in FLOW:
            self.walls.append(len(self.stack))
            own = _steps(name, attrs)
            for s in own:
                steps |= 1 << step(s)
            depth, leaf = depth + len(own), name
        if open_ended:
            self.open_ended.append(len(self.stack))
        self.stack.append(_Element(name, open_ended, steps, depth, leaf))
        self.open[name] = self.open.get(name, 0) + 1
        self.silent += name in SILENT
        self.foreign += name in ("svg", "math")

    def within_silent(self) -> bool:
        """Whether a silent element is open that has an end tag."""
        return self.silent > len(self.open_ended)

    def has_end(self, name: str, at: int) -> bool:
        """Whether the page closes an element that opens before at."""
        if name not in self.last_end:
            self.last_end[name] = max((m.start() for m in re.finditer(f"</{name}(?=[\\s/>])", self.page, re.I)), default=-1)
        if self.last_end[name] < at:
            return False
        return name not in _FLAT or name in RAW or re.compile(f"<(/?){name}(?=[\\s/>])", re.I).search(self.page, at)[1] == "/"

    def end(self, name: str) -> None:
        if self.open.get(name):
            self.pop_to(next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].name == name))

    def start(self, name: str, attrs: str, at: int) -> int:
        """Opens an element; the place where reading goes on."""
        stack = self.stack
        if name == "body" and self.open.get("head"):
            self.end("head")
        elif stack and stack[-1].name == "head" and name not in _HEAD:
            self.pop_to(len(stack) - 1)
        if name in VOID:
            return at
        closed = attrs.endswith("/") and not re.search(r"=[^\s\"'=]*/\Z", attrs)
        if closed and (self.foreign or name in ("svg", "math")):
            return at
        open_ended = name in SILENT and name not in ("script", "style", "head", "option") and not self.has_end(name, at) or name == "option" and not self.open.get("select")
        if open_ended and closed:  # written as an empty element
            return at
        within = self.within_silent()  # where elements mean nothing to those outside
        if name not in FLOW and not within and self.walls and stack[self.walls[-1]].name == "p":
            self.pop_to(self.walls[-1])  # a block tag ends an open paragraph, and with it the inline elements left open there
        if not within and any(self.open.get(x) for x in _CLOSES.get(name, ())):
            for k in reversed(self.walls):
                if stack[k].name in _CLOSES[name]:
                    self.pop_to(k)
                    break
                if stack[k].name in _SCOPE:
                    break
        self.push(name, attrs, open_ended)
        if name in RAW and not open_ended:
            found = re.compile(f"</{name}(?=[\\s/>])", re.I).search(self.page, at)
            return found.start() if found else len(self.page)
        return at

    def read(self) -> list[Block]:
        page, at = self.page, 0
        last = page.rfind(">")  # no tag ends after it
        while at < len(page):
            begin = page.find("<", at)
            begin = len(page) if begin < 0 else begin
            if begin > at:
                self.text(page[at:begin])
                at = begin
                continue
            if m := _OTHER.match(page, at):
                at = m.end()
                continue
            m = _TAG.match(page, at) if at < last else None
            if m is None:
                if page[at + 1 : at + 2].isalpha() and page[at + 1].isascii() or page[at + 1 : at + 2] == "/" and page[at + 2 : at + 3].isalpha():
                    break  # a tag that never ends takes the rest of the page
                self.text("<")
                at += 1
                continue
            at, name = m.end(), m["name"].lower()
            if name in ("br", "hr"):
                self.parts.append(" ")
            if name not in FLOW and not self.within_silent():
                self.close_block()
                if self.open_ended:  # a silent element without an end tag lasts to the next block at most
                    self.pop_to(self.open_ended[0])
            if m["end"]:
                self.end(name)
            else:
                at = self.start(name, m["attrs"], at)
        self.close_block()
        return self.blocks

    def text(self, text: str) -> None:
        if self.stack and self.stack[-1].name == "head" and not text.isspace():
            self.pop_to(len(self.stack) - 1)
        if not self.silent:
            self.parts.append(text)
            self.linked += len(text) * (self.open.get("a", 0) > 0)


def leaves(page: str) -> list[Block]:
    """The page's non-empty blocks in order; references decoded, white space of a block made one space."""
    return _Page(page).read()
