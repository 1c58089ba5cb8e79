"""Names of a gazetteer in texts, as words: spans of every alias, and which places a text is about.

Names and texts meet on hashes of runs of words, white space counting as one space. A filter of fixed
size, made from the names by Spark, is all that is broadcast, however many names there are; a run of words that passes it leaves
the scan with the text around it, meets its names by a join, and is confirmed by the name's own pattern. Texts never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lorekeeper.operators.ranking import first_by

#: Words of a key: a name of so many words is hashed as a whole, any other one by as many of its first words as are listed.
WIDTHS = (1, 2, 3, 4, 8, 16)
#: Bits of the filter (4 MB), and letters of punctuation around a name's words that are looked for.
BITS, OUTER = 1 << 25, 32
#: Bytes of text that are hashed at once; a single longer text is taken as a whole.
SLICE_BYTES = 1 << 20
#: Parts that the mentions of one key are dealt into before they meet the key's names.
SALTS = 16
#: Bytes of names that one automaton holds, of names that are looked for within words.
BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C1B
_WORD, _SPACE = 1, 2


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: 1 in words, 2 in white space, 0 elsewhere; and its lower-case form where that is one."""
    kinds, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalnum() or x == "_":
            kinds[c] = _WORD
            if len(low := x.lower()) == 1:
                lower[c] = ord(low)
        elif x.isspace():
            kinds[c] = _SPACE
    return kinds, lower


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Runs:
    """Words of a text: where they start and end, and hashes of runs of them."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, lower = _letters()
        kind = kinds[codes]
        kept = np.ones(len(codes), bool)
        kept[1:] = (kind[1:] != _SPACE) | (kind[:-1] != _SPACE)  # runs of white space count as one space
        self.at = np.flatnonzero(kept)
        codes, kind = np.where(kind == _SPACE, 32, lower[codes])[kept].astype(np.uint64), kind[kept]
        self.codes, word = codes, kind == _WORD
        edges = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        size = 1 << max(len(codes), 1 << 12).bit_length()
        up, self.down = _powers(size)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mixed(codes + _U(1)) * up[: len(codes)], out=self.sums[1:])
        self.length = len(codes)

    def hashes(self, width: int, whole: bool) -> np.ndarray:
        """Of the runs of ``width`` words, by their first word."""
        if len(self.starts) < width:
            return np.zeros(0, np.uint64)
        s, e = self.starts[: len(self.starts) - width + 1], self.ends[width - 1 :]
        return _mixed((self.sums[e] - self.sums[s]) * self.down[s] + _U(2 * width + whole))


def _described(names: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The key of every name: (item_id, name, k, size)."""
    for batch in names:
        keys, told = [], []
        for k, name in enumerate(batch["name"]):
            runs = _Runs(name)
            n = len(runs.starts)
            if not n or runs.starts[0] > OUTER or runs.length - runs.ends[-1] > OUTER:
                continue
            whole = n in WIDTHS and runs.starts[0] == 0 and runs.ends[-1] == runs.length
            width = max(w for w in WIDTHS if w <= n)
            keys.append((int(runs.hashes(width, whole)[0].view(np.int64)), 0 if whole else runs.length))
            told.append(k)
        out = batch.iloc[told].copy()
        out["k"], out["size"] = pd.Series([x for x, _ in keys], out.index, np.int64), pd.Series([x for _, x in keys], out.index, np.int64)
        yield out


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & _U(BITS - 1)).astype(np.int64), ((hashes >> _U(32)) & _U(BITS - 1)).astype(np.int64)


def _filter(keyed: DataFrame) -> np.ndarray:
    """BITS bits, packed, of the keys: made by Spark word by word, so that what the driver gets has a fixed bound."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in _probes(b.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int32)), pa.array((_U(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["word", "bits"])

    told = keyed.select("k").mapInArrow(words, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # BITS / 64 rows at most
    out = np.zeros(BITS // 64, np.uint64)
    out[told["word"].to_numpy()] = told["bits"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends, at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


@lru_cache(1 << 14)
def _pattern(name: str) -> tuple[re.Pattern[str], bool]:
    """A name as a pattern, its first to last word a group, and whether it begins with a word."""
    runs = _Runs(name)
    name = "".join(chr(c) for c in runs.codes)
    low, high = int(runs.starts[0]), int(runs.ends[-1])
    part = lambda s: re.escape(s).replace(r"\ ", r"\s+")
    return re.compile(rf"(?<!\w){part(name[:low])}({part(name[low:high])}){part(name[high:])}(?!\w)", re.I), low == 0


def _matched(around: int):
    """Confirms mentions (doc_id, start, lead, near, item_id, name) by the name's own pattern."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, start, lead, near, item, name in zip(b["doc_id"], b["start"], b["lead"], b["near"], b["item_id"], b["name"]):
                form, bare = _pattern(name)
                m = form.match(near, lead) if bare else next((x for x in form.finditer(near, max(0, lead - 2 * OUTER)) if x.start(1) >= lead), None)
                if m is None or m.start(1) != lead:
                    continue
                evidence = near[max(0, m.start() - around) : m.end() + around]
                out.append((doc, item, start + m.start() - lead, start + m.end() - lead, " ".join(evidence.split()), m.group(0)))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "start", "end", "evidence", "printed"])

    return run


def mentions(docs: DataFrame, names: DataFrame, around: int = 90, every: bool = False, printed: bool = False) -> DataFrame:
    """(doc_id, item_id, start, end, evidence): where texts (doc_id, text) hold a name (item_id, name) as words.

    Case doesn't matter, a space of a name is any white space, and no letter, digit or underscore touches a mention. start and end
    are in characters, from 0, end exclusive; evidence is the text up to ``around`` characters on each side, white space
    collapsed; with ``printed`` a column of that name tells the mention as it stands. Without ``every`` only the first mention of a name in a text is sure to be told. Null texts and names hold nothing; a
    name without letters, digits and underscores, or with more than OUTER other characters before or after them, is not looked for.
    """
    kinds = {c: t for c, t in [("doc_id", dict(docs.dtypes)["doc_id"]), ("item_id", dict(names.dtypes)["item_id"])]}
    keyed = names.select("item_id", F.regexp_replace("name", r"(?U)^\s+|\s+$", "").alias("name")).where("name <> ''").mapInPandas(_described, f"item_id {kinds['item_id']}, name string, k long, size long")
    shared = docs.sparkSession.sparkContext.broadcast((_filter(keyed), int(keyed.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, longest = shared.value
        if not bits.any():
            return
        held = lambda at: (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        for batch in batches:
            for part in _pieces(batch):
                texts = part.column(1).to_pylist()
                joined = "\n".join(texts)
                begins = np.cumsum([0] + [len(t) + 1 for t in texts])
                runs = _Runs(joined)
                starts = runs.at[runs.starts]
                owner = np.searchsorted(begins, starts, "right") - 1
                rows = []
                for width in WIDTHS:
                    for whole in (True, False):
                        hashes = runs.hashes(width, whole)
                        one, two = _probes(hashes)
                        at = np.flatnonzero(held(one))
                        at = at[held(two[at])]
                        at = at[owner[at] == owner[at + width - 1]]
                        if whole and not every and len(at):  # the first of a text will do
                            _, first = np.unique(np.stack([owner[at].astype(np.uint64), hashes[at]]), axis=1, return_index=True)
                            at = at[first]
                        ends = runs.ends[at + width - 1]
                        if not whole:
                            ends = np.maximum(ends, np.minimum(runs.starts[at] + longest, runs.length))
                        ends = runs.at[ends - 1] + 1 if len(at) else ends
                        for i, e, h in zip(at.tolist(), ends.tolist(), hashes[at].view(np.int64).tolist()):
                            d = owner[i]
                            s = int(starts[i] - begins[d])
                            low = max(0, s - around - OUTER)
                            rows.append((d, h, s, s - low, texts[d][low : e - int(begins[d]) + around + OUTER + 1]))
                if rows:
                    d, h, s, lead, near = zip(*rows)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.array(d, np.int64))), pa.array(h, pa.int64()), pa.array(s, pa.int64()), pa.array(lead, pa.int32()), pa.array(near, pa.string())], ["doc_id", "k", "start", "lead", "near"])

    found = docs.select("doc_id", "text").where("text <> ''").mapInArrow(scan, f"doc_id {kinds['doc_id']}, k long, start long, lead int, near string")
    salted = keyed.drop("size").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = found.withColumn("salt", F.pmod(F.xxhash64("near", "start"), F.lit(SALTS)).cast("int")).join(salted, ["k", "salt"])
    found = pairs.select("doc_id", "start", "lead", "near", "item_id", "name").mapInPandas(_matched(around), f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, start long, end long, evidence string, printed string")
    return found if printed else found.drop("printed")


def first_mentions(docs: DataFrame, names: DataFrame, around: int = 90, printed: bool = False) -> DataFrame:
    """mentions, the first one of each name under each doc_id."""
    columns = ["start", "end", "evidence"] + ["printed"] * printed
    found = mentions(docs, names, around, printed=printed).groupBy("doc_id", "item_id").agg(F.min(F.struct(*columns)).alias("m"))
    return found.select("doc_id", "item_id", "m.*")


def _low(text: str) -> str:
    """A text in lower case, letter by letter, so that places stay."""
    return _letters()[1][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].tobytes().decode("utf-32-le", "surrogatepass")


@F.pandas_udf(StringType())
def _lowered(text: pd.Series) -> pd.Series:
    return text.map(_low, na_action="ignore")


def _held(names: list[str], around: int):
    """The first place of each of some lower-case names in each text, in one pass over it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = ahocorasick.Automaton()
        for name in names:
            found.add_word(name, name)
        found.make_automaton()
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["text"]):
                first: dict[str, int] = {}
                for last, name in found.iter(_low(text)):
                    first.setdefault(name, last + 1)
                for name, end in first.items():
                    start = end - len(name)
                    out.append((doc, name, start, end, " ".join(text[max(0, start - around) : end + around].split()), text[start:end]))
            yield pd.DataFrame(out, columns=["doc_id", "low", "start", "end", "evidence", "printed"])

    return run


def first_held(docs: DataFrame, names: DataFrame, around: int = 90) -> DataFrame:
    """(doc_id, item_id, start, end, evidence, printed): the first place where a text holds a name as it stands, within words too.

    Case doesn't matter, letter by letter: letters are equal if their lower-case forms of one letter are. A name's spaces are spaces. Different
    names are dealt into blocks of about BLOCK_BYTES; each block is an automaton and one pass over the texts, so names of any number do.
    A doc_id is taken as one text. Null and empty texts and names hold nothing; names may repeat under several item_ids.
    """
    kind = dict(docs.dtypes)["doc_id"]
    keyed = names.select("item_id", _lowered(F.col("name")).alias("low")).where("low <> ''")
    distinct = keyed.select("low").distinct()
    blocks = -(-int(distinct.agg(F.coalesce(F.sum(F.octet_length("low")), F.lit(0))).first()[0]) // BLOCK_BYTES)
    texts, schema = docs.select("doc_id", "text").where("text <> ''"), f"doc_id {kind}, low string, start long, end long, evidence string, printed string"
    found = docs.sparkSession.createDataFrame([], schema)
    for k in range(blocks):
        block = [r.low for r in distinct.where(F.pmod(F.xxhash64("low"), F.lit(blocks)) == k).collect()]  # about BLOCK_BYTES
        if block:
            found = found.unionAll(texts.mapInPandas(_held(block, around), schema))
    return found.join(keyed, "low").select("doc_id", "item_id", "start", "end", "evidence", "printed")


def _aliases(catalogue: DataFrame) -> DataFrame:
    return catalogue.where("alias <> '' and place is not null").select(F.struct("place", "place_order", "alias_order", "alias").alias("item_id"), F.col("alias").alias("name"))


def places_named(docs: DataFrame, catalogue: DataFrame, around: int = 90) -> DataFrame:
    """(doc_id, rank, place, alias, start, end, evidence): every place that a text names, once.

    The catalogue has rows (place, place_order, alias, alias_order). A place is known by the first of its aliases, in their
    order, that the text holds, at its first mention. Places are ranked from 1: the one with the longest alias first, then by their order.
    """
    longest = catalogue.groupBy("place").agg(F.max(F.char_length("alias")).alias("longest"))
    found = first_mentions(docs, _aliases(catalogue), around).select("doc_id", "item_id.*", "start", "end", "evidence")
    best = found.groupBy("doc_id", "place").agg(F.min("place_order").alias("place_order"), F.min(F.struct("alias_order", "start", "alias", "end", "evidence")).alias("m"))
    from pyspark.sql.window import Window as W

    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("longest"), "place_order", "place"))
    return best.join(longest, "place").withColumn("rank", rank).select("doc_id", "rank", "place", "m.alias", "m.start", "m.end", "m.evidence")


def first_place(docs: DataFrame, catalogue: DataFrame, near: Column | None = None, around: int = 360) -> DataFrame:
    """(doc_id, place, alias, evidence): the first place of the catalogue that a text names with what ``near`` asks of its evidence.

    The evidence of a place is around the first mention of its first alias found; near is a condition on the column evidence.
    """
    named = places_named(docs, catalogue, around)
    order = catalogue.groupBy("place").agg(F.min("place_order").alias("place_order"))
    kept = named.where(near if near is not None else F.lit(True)).join(order, "place")
    return first_by(kept, ["doc_id"], ["place_order", "place"]).select("doc_id", "place", "alias", "evidence")
