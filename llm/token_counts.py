"""Token counts of the sections of a document, from one encoding of the whole document.

Tokens are laid end to end over the text, which gives each its span; sections are intervals that tile
the text; an interval join of the two gives every token to one section. A token that crosses a section
boundary is allocated by an explicit rule:

* ``start``: to the section of its first byte (the default);
* ``majority``: to the section that holds most of its bytes, the earlier one on a tie.

Every token goes to exactly one section, so the sections' counts add up to the document's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bpe import Encoder, read_ranks
from llm.frames import slices
from llm.words import text_bytes

RULES = ("start", "majority")
_tokenizers: dict[str, Tokenizer] = {}


#: Runs that the library's pattern matcher can't be trusted with: it recurses over them. Texts that hold one take our own encoder.
_LONG_RUN = re.compile(r"(?<!\s)\s{4096}|(?<!\S)\S{65536}")


class Tokenizer:
    """Token ids of whole texts: the library's encoder, and our own, which gives the same ids, for texts with very long runs."""

    def __init__(self, data: bytes, pattern: str):
        ranks = read_ranks(data)
        self.lengths = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(t) for t in ranks]
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.own = Encoder(ranks, pattern)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        if len(text) >= 4096 and _LONG_RUN.search(text):
            return np.frombuffer(self.own.encode(text), "<u4").astype(np.int64)
        return np.array(self.library.encode_ordinary(text), np.int64)


def _tokenizer(data: bytes, pattern: str) -> Tokenizer:
    """Made once in each Python worker."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer(data, pattern)
    return _tokenizers[key]


def allocate(token_ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token, and whether it crosses a boundary. Sections are bounds[k]:bounds[k+1]; tokens tile the same bytes."""
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, token_ends, "left") - 1
    if rule == "start":
        return first, last > first
    best, most = first.copy(), np.minimum(token_ends, bounds[np.minimum(first + 1, len(bounds) - 1)]) - starts
    for step in range(1, int((last - first).max(initial=0)) + 1):
        k = np.minimum(first + step, last)
        held = np.minimum(token_ends, bounds[k + 1]) - np.maximum(starts, bounds[k])
        better = (first + step <= last) & (held > most)
        best, most = np.where(better, k, best), np.where(better, held, most)
    return best, last > first


def count_by_section(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "start", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, section, start, end, n_tokens, n_crossing) for every line of every row of docs.

    A section is a line with the line end that closes it; start and end are code points of the text.
    n_crossing counts the section's tokens that reach into another one. A null or empty text has one
    section without tokens; a very long text is encoded whole, whatever runs it holds. Equal rows give
    equal rows; other columns of docs play no part.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a fixed file of under 1 MB
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value, pattern)
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            lists = [tokenizer.ids(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum(tokenizer.lengths[np.concatenate(lists)])
            inner = np.setdiff1d(np.flatnonzero(data == 10) + 1, offsets)
            # Every document opens a section, an empty one too; its sections follow one another.
            bounds = np.sort(np.concatenate([offsets[:-1], inner]), kind="stable")
            owner = np.searchsorted(offsets[:-1], bounds, "right") - 1
            empty = np.flatnonzero(np.diff(offsets) == 0)
            if len(empty):  # several documents begin at one byte
                full = np.flatnonzero(np.diff(offsets) > 0)
                owner = np.concatenate([full[np.searchsorted(offsets[full], b := np.union1d(offsets[full], inner), "right") - 1], empty])
                bounds = np.concatenate([b, offsets[empty]])
                order = np.lexsort((bounds, owner))
                bounds, owner = bounds[order], owner[order]
            edges = np.append(bounds, offsets[-1])
            real = np.flatnonzero(edges[1:] > edges[:-1])
            section, crossing = allocate(ends, np.append(bounds[real], offsets[-1]), rule) if len(real) else (ends, ends)
            n_tokens, n_crossing = np.zeros(len(bounds), np.int64), np.zeros(len(bounds), np.int64)
            if len(real):
                n_tokens[real] = np.bincount(section, minlength=len(real))
                n_crossing[real] = np.bincount(section, crossing, len(real)).astype(np.int64)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = chars[offsets[owner]]
            first_of = np.searchsorted(owner, owner, "left")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), *(pa.array(x.astype(np.int64)) for x in (np.arange(len(owner)) - first_of, chars[edges[:-1]] - base, chars[edges[1:]] - base, n_tokens, n_crossing))],
                ["id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return chosen.mapInArrow(run, f"id {kind}, section long, start long, end long, n_tokens long, n_crossing long").withColumnRenamed("id", id_col)


def count_by_document(sections: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sums of count_by_section: (id, n_sections, n_tokens, n_crossing)."""
    return sections.groupBy(id_col).agg(F.count("*").alias("n_sections"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_crossing").alias("n_crossing"))
