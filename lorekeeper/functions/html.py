"""Visible text of pages: tags are read one after another, and what is inside silent ones is left out."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
# A quote holds a value only after an equals sign, and only if it is closed; anywhere else it is a character like any other.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_RAW = {name: re.compile(rf"</{name}(?![A-Za-z0-9-])", re.I) for name in ("script", "style")}


def tags(page: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, name, whether it closes) of every tag, in time linear in the page; comments and declarations have no name.

    A < that begins no tag is text, and so is a tag that never ends. What a script or style holds is skipped.
    """
    at, last, quotes = 0, page.rfind(">"), True
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, "", False
        elif start > last:
            return
        elif page.startswith(("<!", "<?"), start):
            at = page.find(">", start) + 1
            yield start, at, "", False
        elif (m := _NAME.match(page, start)) is None:
            at = start + 1
        else:
            rest = _REST.match(page, m.end()) if quotes else None
            if rest is None:  # a value that is closed only behind the last tag's end: quotes don't count from here on
                quotes = False
            at = rest.end() if rest else page.find(">", m.end()) + 1
            yield start, at, m[2].lower(), bool(m[1])
            if m[2].lower() in _RAW and not m[1]:
                closing = _RAW[m[2].lower()].search(page, at)
                at = closing.start() if closing else len(page)
                if not closing:
                    yield at, at, "", False


class Reading:
    """What is silent, and what a tag stands for in the text: a space, or a line end in the form that keeps lines."""

    def __init__(self, silent: str, breaks: str, mark: str):
        self.silent, self.breaks, self.mark = frozenset(silent.split()), frozenset(breaks.split()), mark

    def __call__(self, page: str) -> str:
        depth, at, out = 0, 0, []
        for start, end, name, closes in tags(page):
            if not depth:
                out.append(html.unescape(page[at:start]))
            at = end
            if name in self.breaks:
                out.append(self.mark)
            if name in self.silent:
                depth = max(depth + (-1 if closes else 1), 0)
        if not depth:
            out.append(html.unescape(page[at:]))
        lines = (" ".join(line.split()) for line in ("".join(out).split("\n") if self.mark == "\n" else ["".join(out)]))
        return "\n".join(line for line in lines if line)


#: All text on one line; and lines kept, without tables, notes and what frames a page.
text_of = Reading("script style noscript svg", "p div section article header footer nav aside li ul ol br h1 h2 h3 h4 h5 h6 td tr table blockquote", " ")
lines_of = Reading("script style sup table nav footer", "p div h1 h2 h3 li br", "\n")


def _expression(reading: Reading):
    @F.pandas_udf(StringType())
    def read(page: pd.Series) -> pd.Series:
        return page.map(reading, na_action="ignore")

    return read


def visible_text(page: Column) -> Column:
    return _expression(text_of)(page)


def visible_lines(page: Column) -> Column:
    return _expression(lines_of)(page)
