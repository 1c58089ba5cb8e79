"""Benchmark items inside training texts: rare n-gram seeds, then Smith-Waterman alignment.

For every position of an item the shortest n-gram (of NGRAMS) that the corpus is expected to hold at
most ``EXPECTED`` times by chance is a seed; the expectation comes from the frequencies of the item's
words in all documents, so a passage stays a seed however often it was copied. A seed found in a
document fixes a diagonal; the windows around an item's diagonals are aligned locally, word by word,
and an item whose score reaches the threshold leaks. Edits, insertions and lost words only lower the score.

Items are worked on in blocks of bounded size, each of which goes over all documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import broadcast_if_few, nested, slices, stored
from llm.words import PUNCTUATION, Words, mix

NGRAMS = (2, 3, 5, 8)
EXPECTED = 0.25
#: Words of items that are broadcast at once (8 bytes each, and as much again for each n-gram size).
BLOCK_WORDS = 500_000
#: Windows that are held before those that overlap are merged.
HITS = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
_U = np.uint64
_FILTER = 1 << 22


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each position; those of short sequences are none."""
    if len(words) < n:
        return words[:0]
    run = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        run *= _U(0x9FB21C651E98DF25)
        run += words[k : len(words) - n + 1 + k]
    return mix(run + _U(n))


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best local score of each item in its window, and the window position after its last word."""
    scores, ends = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda k: (len(items[k]), len(windows[k])))
    k = 0
    while k < len(order):
        to, width = k, 0
        while to < len(order) and (to == k or (to - k + 1) * max(width, len(windows[order[to]])) <= 60_000):
            width = max(width, len(windows[order[to]]))
            to += 1
        group = order[k:to]
        rows = max(len(items[g]) for g in group)
        item, window = np.zeros((len(group), rows), np.uint64), np.full((len(group), width), 1, np.uint64)
        long = np.zeros((len(group), rows), bool)
        for r, g in enumerate(group):
            item[r, : len(items[g])], window[r, : len(windows[g])] = items[g], windows[g]
            long[r, : len(items[g])] = True
        steps = -GAP * np.arange(width, dtype=np.int32)
        held = np.zeros((len(group), width + 1), np.int32)
        best, at = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for i in range(rows):
            # Words of 0 pad items and 1 windows, so that padding matches nothing.
            new = np.maximum(held[:, :-1] + np.where(item[:, i : i + 1] == window, MATCH, MISMATCH), held[:, 1:] + GAP)
            new = np.maximum(new, 0)
            new = np.maximum.accumulate(new + steps, 1) - steps  # gaps along the window
            held[:, 1:] = new
            top = new.argmax(1)
            value = new[np.arange(len(group)), top]
            better = (value > best) & long[:, i]
            best[better], at[better] = value[better], top[better] + 1
        scores[group], ends[group] = best, at
        k = to
    return scores, ends


def _merged(doc: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows in order, those of one document and item that overlap as one."""
    if not len(doc):
        return doc, item, low, high
    order = np.lexsort((low, item, doc))
    doc, item, low, high = doc[order], item[order], low[order], high[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    group = np.cumsum(other) * (int(high.max()) + 1)
    reach = np.maximum.accumulate(group + high)
    new = other.copy()
    new[1:] |= group[1:] + low[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return doc[begin], item[begin], low[begin], np.maximum.reduceat(high, begin)


class Seeds:
    """The items of a block and their seeds: sorted hashes of each size, with (item, first place, last place) of each hash."""

    def __init__(self, items: list[np.ndarray], frequency, total: float):
        self.items = items
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        by_size = {n: [grams(x, n) for x in items] for n in NGRAMS}
        for k, words in enumerate(items):
            if not len(words):
                continue
            logs = np.log(np.maximum(frequency(words), 0.5) / max(total, 1.0))
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            any_seed = False
            for p in range(len(words)):
                for n in NGRAMS:
                    if p + n > len(words):
                        break
                    if sums[p + n] - sums[p] + np.log(max(total, 1.0)) <= np.log(EXPECTED):
                        found[n].append((int(by_size[n][k][p]), k, p))
                        any_seed = True
                        break
            if not any_seed:  # nothing is rare: the item's longest runs have to do
                n = max((n for n in NGRAMS if n <= len(words)), default=1)
                found[n] += [(int(g), k, p) for p, g in enumerate(by_size[n][k] if n > 1 else grams(words, 1))]
        self.tables = {}
        for n, rows in found.items():
            # Windows of all places of a seed in one item overlap, so their first and last places are enough.
            spans: dict[tuple[int, int], tuple[int, int]] = {}
            for h, k, p in rows:
                a, b = spans.get((h, k), (p, p))
                spans[h, k] = min(a, p), max(b, p)
            rows = sorted((h, k, a, b) for (h, k), (a, b) in spans.items())
            hashes = np.array([r[0] for r in rows], np.uint64)
            distinct, first = np.unique(hashes, return_index=True)
            bits = np.zeros(_FILTER, bool)
            bits[distinct >> _U(42)] = True
            self.tables[n] = (distinct, np.append(first, len(rows)), np.array([r[1:] for r in rows], np.int64), bits)

    def windows(self, w: Words) -> tuple[np.ndarray, ...]:
        """(document, item, first word, end) of the windows around all seeds found within a document, those of one document and item that overlap as one."""
        parts = [_merged(*(np.zeros(0, np.int64) for _ in range(4)))]
        sizes = np.array([len(x) for x in self.items], np.int64)
        for n, (distinct, first, rows, bits) in self.tables.items():
            g = grams(w.hashes, n)
            at = np.flatnonzero(bits[g >> _U(42)])
            place = np.minimum(np.searchsorted(distinct, g[at]), len(distinct) - 1)
            ok = distinct[place] == g[at]
            at, place = at[ok], place[ok]
            doc = np.searchsorted(w.at, at, "right") - 1
            inside = at + n <= w.at[doc + 1]
            at, place, doc = at[inside], place[inside], doc[inside]
            counts = first[place + 1] - first[place]
            done = np.cumsum(counts)
            low = 0
            while low < len(at):  # a few places at a time, however many items share a seed
                high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + HITS, "right")))
                own = counts[low:high]
                each = np.repeat(np.arange(low, high), own)
                row = np.repeat(first[place[low:high]], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
                item, margin = rows[row, 0], sizes[rows[row, 0]] // 4 + 4
                begin = np.maximum(at[each] - rows[row, 2] - margin, w.at[doc[each]])
                end = np.minimum(at[each] - rows[row, 1] + sizes[item] + margin, w.at[doc[each] + 1])
                parts.append(_merged(doc[each], item, begin, end))
                low = high
        return _merged(*(np.concatenate(x) for x in zip(*parts)))

    def leaks(self, w: Words, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """(document, item, score, first word, last word) of the best window of every document and item that reaches the threshold."""
        doc, item, low, end = self.windows(w)
        if not len(doc):
            return []
        sizes = np.array([len(x) for x in self.items], np.int64)[item]
        items, windows = [self.items[k] for k in item], [w.hashes[a:b] for a, b in zip(low, end)]
        scores, ends = align(items, windows)
        share = scores / (MATCH * sizes)
        best: dict[tuple[int, int], int] = {}
        for k in np.flatnonzero(share >= threshold):
            key = (int(doc[k]), int(item[k]))
            if key not in best or share[k] > share[best[key]]:
                best[key] = int(k)
        chosen = list(best.values())
        _, back = align([items[k][::-1] for k in chosen], [windows[k][: ends[k]][::-1] for k in chosen])
        return [(int(doc[k]), int(item[k]), float(share[k]), int(low[k] + ends[k] - b), int(low[k] + ends[k] - 1)) for k, b in zip(chosen, back)]


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, float]:
    """How often each word of the sorted vocabulary is in all documents, and how many words they have."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        counts, total = np.zeros(len(words), np.int64), 0
        bits = np.zeros(_FILTER, bool)
        bits[words >> _U(42)] = True
        for batch in slices(batches, text=0):
            h = Words(batch.column(0), PUNCTUATION).hashes
            total += len(h)
            h = h[bits[h >> _U(42)]]
            place = np.minimum(np.searchsorted(words, h), len(words) - 1)
            counts += np.bincount(place[words[place] == h], minlength=len(words))
        told = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(told, -1)), pa.array(np.append(counts[told], total))], ["k", "n"])

    told = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()  # two numbers for each word of the block at most
    k, n = (told[c].to_numpy() for c in ("k", "n"))
    out = np.zeros(len(vocabulary), np.int64)
    out[k[k >= 0]] = n[k >= 0]
    return out, float(n[k < 0].sum())


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, score, start, end): the items that align in a document with at least ``threshold`` of the full score.

    Words are runs of letters, digits and all characters that aren't ASCII, with A-Z folded. score is the
    local alignment's score over that of the whole item; start and end are the code points of the best
    place: of several windows with the best score the first, and in it the first place to reach that score.
    Null and empty texts and items hold no words and give no row; a very long text is read whole. Ids may
    be null or repeated: equal rows of docs or of the benchmark each give rows. Other columns play no part.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    docs = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    items = benchmark.select(benchmark[item_col].alias("item"), benchmark[item_text_col].alias("text")).where("text is not null").groupBy("item", "text").agg(F.count("*").alias("copies"))
    n_words = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(-(-n_words // (BLOCK_WORDS * 2))))
    out = None
    schema = f"id {kinds[0]}, item {kinds[1]}, score double, start long, end long"
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toArrow() if blocks > 1 else items.toArrow()
        w = Words(part["text"], PUNCTUATION)
        hashes = [w.hashes[a:b] for a, b in zip(w.at[:-1], w.at[1:])]
        vocabulary = np.unique(w.hashes)
        if not len(vocabulary):
            continue
        counts, total = _frequencies(docs, vocabulary)
        seeds = Seeds(hashes, lambda x: counts[np.searchsorted(vocabulary, x)], total)  # noqa: B023
        shared = spark.sparkContext.broadcast((seeds, part["item"].combine_chunks(), part["copies"].to_numpy()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds, names, copies = shared.value
            for batch in slices(batches):
                w = Words(batch.column(1), PUNCTUATION)
                found = seeds.leaks(w, threshold)
                if not found:
                    continue
                doc, item, score, first, last = (np.repeat(x, copies[[f[1] for f in found]]) for x in map(np.array, zip(*found)))
                chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                base = chars[w.offsets[doc]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), names.take(pa.array(item)), pa.array(score), pa.array(chars[w.starts[first]] - base), pa.array(chars[w.ends[last]] - base)],
                    ["id", "item", "score", "start", "end"],
                )

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def without_leaking_texts(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose own text has no leak.

    What is found, and what goes, is keyed by a digest of the text (128 bits) and not by the id: of rows
    that share an id, or have none, only those with a leaking text go. Rows without a text stay.
    """
    digest = F.struct(F.xxhash64(docs[text_col]).alias("h1"), F.xxhash64(F.lit(1), docs[text_col]).alias("h2"))
    found = find_leaks(docs.select(digest.alias("_digest"), docs[text_col].alias("text")), benchmark, threshold, "_digest", "text")
    leaking = broadcast_if_few(stored(found.select(F.col("_digest").alias("leaking")).distinct(), "leaking"))
    return nested(docs, digest=digest).join(leaking, F.col("digest") == F.col("leaking"), "left_anti").select("row.*")
