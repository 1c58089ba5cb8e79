"""Like titles within a year.

Two titles are alike when the share of matching blocks (Ratcliff and Obershelp) or the overlap of their
words reaches a threshold. Both are joined without loss:

* Matching blocks are a common subsequence, so of T letters of both titles at most (1 - threshold) * T are
  inserted or deleted. That bounds the lengths of a pair, the letters that they don't share (by counts), the pairs of
  neighbouring letters that they don't share (three for each edit), and their longest common subsequence. Titles
  meet only others of like length, in tiles; counts and pairs of letters are bits, compared by one exclusive-or
  and a count of bits. Only what passes all bounds is matched block by block.
* Word sets that overlap by the threshold differ in at most t = (1 - threshold) * union words. Of t + 1 parts into which
  words are dealt by their hash, one is equal in both, and titles meet on equal parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions.text import normalised, title_tokens
from lorekeeper.operators.storage import shared_folder

#: Titles of one length class, or with one part of their words, that meet as many others at once.
TILE = 4096
#: Rows of a tile whose bits are compared at once.
ROWS = 128
#: Bits for counts of letters (32 kinds, up to 6 each) and for pairs of letters, in words of 64.
KINDS, MOST, PAIR_WORDS = 32, 6, 4
_COUNT_WORDS = KINDS * MOST // 64
_EPSILON = 1e-9


def signature(title: str) -> bytes:
    """Bits of a title: the n-th letter of a kind for n up to MOST, then its pairs of neighbouring letters by hash."""
    points = np.frombuffer(title.encode("utf-32-le"), np.uint32)
    counts = np.minimum(np.bincount(points % KINDS, minlength=KINDS), MOST)
    letters = np.arange(MOST) < counts[:, None]
    pairs = np.zeros(64 * PAIR_WORDS, bool)
    pairs[((points[:-1].astype(np.uint64) * np.uint64(0x9E3779B1) + points[1:]) * np.uint64(0x85EBCA6B) >> np.uint64(13)) % np.uint64(len(pairs))] = True
    return np.packbits(letters.ravel()).tobytes() + np.packbits(pairs).tobytes()


def word_parts(tokens: list[str], threshold: float) -> list[tuple[str, int, int]]:
    """Keys of a word set, so that two sets whose overlap is at least the threshold share one: for every number
    of differing words that a partner allows, the words dealt by hash into one part more."""
    n = len(tokens)
    if not n:
        return []
    differing = lambda union: int((1 - threshold) * union + _EPSILON)
    hashes = [zlib.crc32(w.encode()) for w in tokens]
    keys = []
    for t in range(differing(n), differing(int(n / threshold + _EPSILON)) + 1):
        parts: list[list[str]] = [[] for _ in range(t + 1)]
        for h, w in zip(hashes, tokens):
            parts[h % (t + 1)].append(w)
        keys += [(" ".join(p), t, k) for k, p in enumerate(parts)]
    return keys


def _with(name: str, value: Callable[[pd.DataFrame], list]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b[name] = value(b)
            yield b

    return run


def common_length(titles: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The longest common subsequence of each pair, bit-parallel over all pairs; of two titles beyond 64 letters, the shorter's length."""
    lengths = np.array([len(t) for t in titles])
    swap = lengths[left] > lengths[right]
    short, long = np.where(swap, right, left), np.where(swap, left, right)
    out = lengths[short].copy()
    told = np.flatnonzero(lengths[short] <= 64)
    if not len(told):
        return out
    used = np.unique(np.concatenate([short[told], long[told]]))
    place = np.zeros(len(titles), np.int64)
    place[used] = np.arange(len(used))
    points = [np.frombuffer(titles[k].encode("utf-32-le"), np.uint32) for k in used]
    kinds = np.unique(np.concatenate(points))
    letters = np.full((len(used), max(map(len, points)) + 1), len(kinds), np.int64)  # one kind that no title has
    masks = np.zeros((len(used), len(kinds) + 1), np.uint64)
    for k, p in enumerate(points):
        at = np.searchsorted(kinds, p)
        letters[k, : len(at)] = at
        if len(at) <= 64:
            np.bitwise_or.at(masks[k], at, np.uint64(1) << np.arange(len(at), dtype=np.uint64))
    for low in range(0, len(told), 1 << 15):
        some = told[low : low + (1 << 15)]
        a, b = place[short[some]], place[long[some]]
        v = np.full(len(some), ~np.uint64(0))
        for step in range(int(lengths[long[some]].max())):
            u = v & masks[a, letters[b, step]]
            v = (v + u) | (v - u)
        size = lengths[short[some]].astype(np.uint64)
        inside = np.where(size == 64, ~np.uint64(0), (np.uint64(1) << (size % np.uint64(64))) - np.uint64(1))
        out[some] = np.bitwise_count(~v & inside)
    return out


def overlap(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


class _Tile:
    """Titles that meet: rows (id, last, title, tokens, side), side 0 before side 1, and for candidates their bits."""

    def __init__(self, rows: pd.DataFrame, threshold: float):
        rows = rows.sort_values(["side", "id"], ignore_index=True)
        self.ids, self.last, self.titles, self.threshold = rows["id"], rows["last"], rows["title"].tolist(), threshold
        self.tokens = [frozenset(t) for t in rows["tokens"]]
        self.lengths = np.array([len(t) for t in self.titles])
        self.bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(len(rows), -1) if "bits" in rows else None
        self.across = int((rows["side"] == 0).sum()) if rows["side"].iat[-1] else 0

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that pass the bounds on lengths, letters, pairs of letters and common subsequences."""
        n, bits = len(self.titles), np.ascontiguousarray(self.bits.T)
        for low in range(0, self.across or n, ROWS):
            high = min(low + ROWS, self.across or n)
            begin = self.across or low
            both = self.lengths[low:high, None] + self.lengths[begin:]
            edits = ((1 - self.threshold) * both + _EPSILON).astype(np.int64)
            fits = np.abs(self.lengths[low:high, None] - self.lengths[begin:]) <= edits
            differ = lambda words: sum(np.bitwise_count(bits[w, low:high, None] ^ bits[w, begin:]).astype(np.int16) for w in words)
            fits &= differ(range(_COUNT_WORDS)) <= edits
            fits &= differ(range(_COUNT_WORDS, _COUNT_WORDS + PAIR_WORDS)) <= 3 * edits
            i, j = np.nonzero(fits)
            allowed = edits[i, j]
            i, j = i + low, j + begin
            keep = np.ones(len(i), bool) if self.across else i < j
            i, j, allowed = i[keep], j[keep], allowed[keep]
            if len(i):
                near = self.lengths[i] + self.lengths[j] - 2 * common_length(self.titles, i, j) <= allowed
                yield i[near], j[near]

    def scored(self, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        """(left, right, score, reverse) of the pairs at the threshold, the smaller id left.

        score is that of a smaller id of the left title and a larger one of the right, reverse that of the other order, where copies make both occur.
        """
        out: list[tuple] = []
        m = SequenceMatcher()
        for i, j in pairs:
            for a, b in sorted(zip(i.tolist(), j.tolist()), key=lambda p: p[1]):
                if self.ids[a] == self.ids[b]:
                    continue
                if self.ids[b] < self.ids[a]:
                    a, b = b, a
                words = overlap(self.tokens[a], self.tokens[b])
                m.set_seqs(self.titles[a], self.titles[b])
                score, reverse = max(m.ratio(), words), None
                if self.last[a] > self.ids[b]:
                    m.set_seqs(self.titles[b], self.titles[a])
                    reverse = max(m.ratio(), words)
                if score >= self.threshold or (reverse or 0) >= self.threshold:
                    out.append((self.ids[a], self.ids[b], float(score), reverse))
        return pd.DataFrame(out, columns=["left", "right", "score", "reverse"])

    def by_words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs whose word sets overlap by the threshold: sizes bound it, then common words are counted."""
        names: dict[str, int] = {}
        index = [[names.setdefault(w, len(names)) for w in t] for t in self.tokens]
        sizes = np.array([len(t) for t in self.tokens])
        holders: list[list[int]] = [[] for _ in names]
        for k in range(self.across, len(index)):
            for w in index[k]:
                holders[w].append(k)
        where = [np.array(h, np.int64) for h in holders]
        for a in range(self.across or len(index)):
            common = np.bincount(np.concatenate([where[w] for w in index[a]]), minlength=len(index)) if index[a] else np.zeros(len(index), int)
            union = sizes[a] + sizes - common
            b = np.flatnonzero((common > 0) & (common / np.maximum(union, 1) >= self.threshold - _EPSILON))
            b = b if self.across else b[b > a]
            if len(b):
                yield np.full(len(b), a), b


def _held(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows each key has, and blocks of at most TILE or so."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int"))


def _tile_rows(rows: DataFrame, keys: list[str], held: DataFrame, across: Column | None = None) -> DataFrame:
    """rows once for every tile that they belong to: keys, kind, i, j and the side; rows of keys that held lacks go.

    The rows of a key are cut into its blocks by a hash. Every two blocks of a key meet in a tile, and,
    where ``across`` gives the next key's last column, every block of a key and every one of the next.
    """
    *outer, last = keys
    own = [c for c in rows.columns if c not in keys]
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    placed = rows.alias("r").join(held.alias("h"), same).select("r.*", "blocks")
    if across is None:
        placed = placed.withColumn("above", F.lit(0)).withColumn("below", F.lit(0))
    else:
        for name, step in (("above", 1), ("below", -1)):
            other = held.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("blocks").alias(name))
            meets = [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in outer] + [F.col(f"_{last}") == F.col(last) + step]
            placed = placed.join(other, meets, "left").drop(*[f"_{k}" for k in keys]).withColumn(name, F.coalesce(name, F.lit(0)))
    placed = placed.withColumn("own", F.expr("cast(pmod(xxhash64(title), blocks) as int)"))
    upto = lambda n: F.expr(f"transform(if({n} > 0, sequence(0, {n} - 1), cast(array() as array<int>)), x -> x)")
    zero, one = F.lit(0), F.lit(1)
    tile = lambda kind, key, i, j, side: F.struct(kind.alias("kind"), key.alias("key"), i.alias("i"), j.alias("j"), side.alias("side"))
    within = F.transform(upto("blocks"), lambda o: tile(zero, F.col(last), F.least("own", o), F.greatest("own", o), F.when(F.col("own") > o, 1).otherwise(0)))
    parts = [within]
    if across is not None:
        parts.append(F.transform(upto("above"), lambda o: tile(one, F.col(last), F.col("own"), o, zero)))
        parts.append(F.transform(upto("below"), lambda o: tile(one, F.col(last) - 1, o, F.col("own"), one)))
    told = placed.withColumn("at", F.explode(F.concat(*parts)))
    return told.select(*outer, "at.*", *own)


def near_titles(titles: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(left, right, score, reverse): like titles of one year, among rows (id, title, year), null years equal.

    Titles are normalised (NFKC, plain quotes and dashes, case, white space); null and empty ones and null ids
    go. Equal titles of a year are one class, named by its smallest id: the result has a row for every other member with
    its class (score 1), and one for every two classes that are alike, by their smallest ids. For members x < y of two such
    classes the score is ``score`` when x is of the left class, and else ``reverse`` (the share of matching blocks depends on the order),
    which is null where no such members exist. A pair is told when either of them reaches the threshold (at least 0.5).

    No pair is lost. Work follows the like pairs and, by about ten nanoseconds each, the pairs of like length in a year;
    titles, however many are alike, meet in tiles of at most two blocks of about TILE. Copies meet as they are written,
    before they are normalised; the classes are checkpointed, and all that follows starts from there.
    """
    shared_folder(titles.sparkSession)
    kind = dict(titles.dtypes)["id"]
    year = dict(titles.dtypes)["year"]
    t = titles.select("id", "title", "year").where("title is not null and id is not null")
    forms = t.groupBy("title", "year").agg(F.min("id").alias("id"), F.max("id").alias("last")).withColumn("plain", normalised(F.col("title"))).where("plain <> ''")
    classes = forms.groupBy(F.col("plain").alias("title"), "year").agg(F.min("id").alias("id"), F.max("last").alias("last")).checkpoint()
    first = classes.select(F.col("title").alias("_plain"), F.col("year").alias("_of"), F.col("id").alias("_first"))
    of = forms.join(first, (F.col("plain") == F.col("_plain")) & F.col("year").eqNullSafe(F.col("_of"))).select(F.col("title").alias("_title"), F.col("year").alias("_year"), "_first")
    copies = t.join(of, (F.col("title") == F.col("_title")) & F.col("year").eqNullSafe(F.col("_year"))).where("id <> _first").select(F.col("_first").alias("left"), F.col("id").alias("right"), F.lit(1.0).alias("score"), F.lit(None).cast("double").alias("reverse")).distinct()

    known, told = classes.select("id", "last", "title", "year", title_tokens(F.col("title")).alias("tokens")), f"id {kind}, last {kind}, title string, year {year}, tokens array<string>"
    # Lengths of a pair are at most (1 + edits) / (1 - edits) apart: the same class or the next.
    step = np.log((2 - threshold) / threshold) if threshold < 1 else 1.0
    sized = lambda df: df.withColumn("size", F.floor(F.log(F.char_length("title")) / F.lit(float(step)) + F.lit(_EPSILON)).cast("int"))
    signed = known.mapInPandas(_with("bits", lambda b: [signature(x) for x in b["title"]]), f"{told}, bits binary")
    dealt = known.mapInPandas(_with("parts", lambda b: [[f"{n}/{k}/{p}" for p, n, k in word_parts(list(w), threshold)] for w in b["tokens"]]), f"{told}, parts array<string>")
    parted = dealt.withColumn("part", F.explode("parts")).drop("parts")
    schema = f"left {kind}, right {kind}, score double, reverse double"

    def by_letters(rows: pd.DataFrame) -> pd.DataFrame:
        tile = _Tile(rows, threshold)
        return tile.scored(tile.candidates())

    def by_words(rows: pd.DataFrame) -> pd.DataFrame:
        tile = _Tile(rows, threshold)
        return tile.scored(tile.by_words())

    letters = _tile_rows(sized(signed), ["year", "size"], _held(sized(classes), ["year", "size"]), F.col("size")).groupBy("year", "kind", "key", "i", "j").applyInPandas(by_letters, schema)
    words = _tile_rows(parted, ["year", "part"], _held(parted, ["year", "part"]).where("n > 1")).groupBy("year", "kind", "key", "i", "j").applyInPandas(by_words, schema)
    return letters.unionByName(words).distinct().unionByName(copies)
