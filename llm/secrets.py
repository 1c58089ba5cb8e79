"""Secrets in texts: every rule is scanned in one pass of a combined automaton over the bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.automaton import Scanner
from llm.frames import slices


class Rule(NamedTuple):
    """kind; the pattern whose leftmost longest matches count; and the part of these that is kept (all, if empty)."""

    kind: str
    pattern: str
    keep: str


_ASSIGN = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"
_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
#: The three base kinds, in their order, then those that this operator adds. ``[0-9a-f]{32,}`` stands
#: for the maximal runs of 32 and more: shorter runs are disjoint from those and can be left out early.
RULES = (
    Rule("assign", f"({_NAME}){_ASSIGN}{_VALUE}+", f"({_NAME}){_ASSIGN}{_VALUE}{{8,}}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}", ""),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", ""),
    Rule("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----", ""),
)
BASE = 3


class SecretScanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.scanner = Scanner([(r.pattern, r.keep) for r in rules])

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, end, rule) in code points, by start and then rule. A null text has none."""
        data = (text or "").encode()
        kept = [(s, e, k) for k, s, e in self.scanner.scan(data)]
        if kept and not text.isascii():
            chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            kept = [(int(chars[s]), int(chars[e]), k) for s, e, k in kept]
        return sorted(kept, key=lambda x: (x[0], x[2], x[1]))

    def joined(self, spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{self.rules[k].kind}:{s}:{e}" for s, e, k in spans)


_scanners: dict[tuple[Rule, ...], SecretScanner] = {}


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    A span is kind:start:end in code points, end exclusive. Matches of a rule are leftmost, longest and
    don't overlap one another; those of different rules may. Null and empty texts have no spans and
    the digest of the empty string; a very long text is read whole, byte by byte. Equal rows give equal
    rows. Columns of docs other than the two named play no part.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rules not in _scanners:
            _scanners[rules] = SecretScanner(rules)
        scanner = _scanners[rules]
        for batch in slices(batches):
            found = [scanner.spans(text) for text in batch.column(1).to_pylist()]
            base = [[x for x in spans if x[2] < BASE] for spans in found]
            counts = [pa.array([sum(x[2] == k for x in spans) for spans in base], pa.int64()) for k in range(BASE)]
            digests = pa.array([hashlib.sha256(scanner.joined(b).encode()).hexdigest() for b in base], pa.string())
            added = pa.array([len(f) - len(b) for f, b in zip(found, base)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, pa.array(map(scanner.joined, found), pa.string()), added], names)

    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"]
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
