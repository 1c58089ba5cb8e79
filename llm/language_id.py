"""Language identification by n-gram filters of language bitmasks.

Every language has the set of letter 3- and 4-grams that are about as frequent in it as anywhere. The sets are
Bloom filters of one size, stored bit-sliced: slot i of the table is a bitmask of the languages whose
filter has bit i. The slots of an n-gram, and-ed, name all languages that contain it. A document's
hits are counted for each language, corrected for the false positives of that language's filter, and
the largest count decides.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import broadcast_if_few, slices, stored
from llm.words import mix, text_bytes

#: The classifier's sample: texts of a language and their bytes, and languages, the most frequent ones.
MAX_TEXTS, MAX_BYTES, LANGUAGES = 3000, 8 << 20, 256
#: Lengths of n-grams, the share of an n-gram's highest rate that puts it into a language's set, and hashes of the filters.
SIZES, SHARE, HASHES = (3, 4), 0.5, 4
#: Slots for each n-gram of the largest set, and the most slots (32 MB for up to 64 languages); a fuller filter has more false positives, which are corrected.
PER_GRAM, MAX_SLOTS = 16, 1 << 22
#: Bytes of text that are decoded at once.
BLOCK = 1 << 18
UNKNOWN = "und"
_FACTORS = np.random.default_rng(20240301).integers(1, 2**63, max(SIZES), dtype=np.uint64) | np.uint64(1)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """2 for letters, 1 for marks (which belong to words, but are no letters) and 0 for all other code points."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, owners, letters) of a few n-grams at a time: their texts' positions, and the positions of texts that have letters.

    Texts are lower-cased; everything but letters and marks is one boundary, which an n-gram may begin or
    end with. Texts of any length are read block by block.
    """
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    starts, keep = offsets[:-1], max(SIZES) - 1
    codes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low, end = int(offsets[0]), int(offsets[-1])
    while True:
        high = min(low + BLOCK, end)
        while high < end and data[high] & 0xC0 == 0x80:
            high += 1
        part = data[low:high]
        new = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32)
        # Texts that begin in this block, as positions in it; a boundary goes before each.
        first, last = np.searchsorted(starts, [low, high] if high < end else [low, end + 1])
        chars = np.cumsum((part & 0xC0) != 0x80)
        begin = np.where(starts[first:last] > low, chars[np.maximum(starts[first:last] - low - 1, 0)] if len(chars) else 0, 0)
        owner = np.searchsorted(begin, np.arange(len(new)), "right") + first - 1
        kinds = _kinds()[new]
        letters = np.unique(owner[kinds == 2])
        fresh = np.insert(np.where(kinds > 0, new, 0).astype(np.uint64), begin, 0)
        owner = np.insert(owner, begin, np.arange(first, last))
        if high == end:
            fresh, owner = np.append(fresh, np.uint64(0)), np.append(owner, len(starts) - 1)
        held = len(codes)
        codes, owners = np.concatenate([codes, fresh]), np.concatenate([owners, owner])
        told = np.ones(len(codes), bool)
        told[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        told[:held] = True
        codes, owners = codes[told], owners[told]
        hashes, whose = [], []
        for n in SIZES:
            at = max(held - n + 1, 0)  # n-grams that end in this block
            m = len(codes) - n + 1 - at
            if m <= 0:
                continue
            h, whole = np.full(m, n, np.uint64), np.ones(m, bool)
            for k in range(n):
                h += codes[at + k : at + k + m] * _FACTORS[k]
                if 0 < k < n - 1:
                    whole &= codes[at + k : at + k + m] != 0
            hashes.append(mix(h[whole]))
            whose.append(owners[at + 1 : at + 1 + m][whole])
        yield np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate([*whose, np.zeros(0, np.int64)]), letters
        codes, owners = codes[-keep:], owners[-keep:]
        low = high
        if low == end:
            return


def slots(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The slots of n-grams in a table of ``size``, a power of two, one array for each hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((hashes + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.intp)


@dataclass
class Filters:
    """The bit-sliced filters: languages, most frequent first, and a table (slots by words of 64 languages)."""

    languages: list[str]
    table: np.ndarray

    def false_positives(self) -> np.ndarray:
        """For every language the chance that its filter holds an n-gram that is not in its set."""
        return np.array([((self.table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(self.languages))]) ** HASHES

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hits (texts by languages), n-grams, and whether there is a letter, of every text."""
        n = len(column)
        hits, total, lettered = np.zeros((n, len(self.languages)), np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        for hashes, owners, letters in grams(column):
            lettered[letters] = True
            if not len(hashes):
                continue
            order = np.argsort(owners, kind="stable")
            hashes, owners = hashes[order], owners[order]
            told = np.unique(owners)
            edges = np.append(np.searchsorted(owners, told), len(owners))
            total[told] += np.diff(edges)
            masks = None
            for at in slots(hashes, len(self.table)):
                masks = self.table[at] if masks is None else masks & self.table[at]
            for k in range(len(self.languages)):
                bits = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                hits[told, k] += np.add.reduceat(bits.astype(np.int64), edges[:-1])
        return hits, total, lettered

    def decide(self, column: pa.Array, wrong: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of every text and its share of all corrected hits."""
        hits, total, lettered = self.counts(column)
        if not self.languages:
            return [UNKNOWN] * len(hits), np.zeros(len(hits))
        true = np.maximum(hits - wrong * total[:, None], 0) / np.maximum(1 - wrong, 1e-9)
        best, whole = true.argmax(1), true.sum(1)
        score = np.where(whole > 0, true[np.arange(len(true)), best] / np.where(whole > 0, whole, 1), 1 / len(self.languages))
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], np.where(lettered, score, 0.0)


def held_out(id_col: F.Column, folds: int = 4, fold: int = 2) -> F.Column:
    """Whether a row is kept from training; one with a null id isn't."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_sample(docs: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages, most frequent first, and (k, text): different whole texts of each, in the order of a hash, MAX_TEXTS at most.

    Only rows with a lang and a letter, outside the held-out fold. A language ends with the text that fills its MAX_BYTES.
    """
    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).where(~held_out(docs["doc_id"])).where("lang is not null").where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    known = stored(rows.groupBy("lang", "h").agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).cast("long").alias("n")), "texts")
    counted = known.groupBy("lang").agg(F.sum("copies").alias("c"), F.count("*").alias("n")).orderBy(F.desc("c"), "lang").limit(LANGUAGES).collect()
    languages = [r["lang"] for r in counted]
    # Hashes under a bound that about twice MAX_TEXTS of them keep, so that no language's texts are ranked in one task.
    bounds = [(k, r["lang"], min(1 << 20, -(-(2 * MAX_TEXTS << 20) // r["n"]))) for k, r in enumerate(counted)]
    names = F.broadcast(docs.sparkSession.createDataFrame(bounds, "k int, lang string, bound int"))  # LANGUAGES rows at most
    by_hash = Window.partitionBy("k").orderBy("h")
    some = known.join(names, "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("bound")).select("k", "h", "n").withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= MAX_TEXTS)
    some = some.withColumn("before", F.sum("n").over(by_hash) - F.col("n")).where(F.col("before") < MAX_BYTES).select("k", "h")
    picked = rows.join(names.drop("bound"), "lang").join(broadcast_if_few(stored(some, "sample")), ["k", "h"]).groupBy("k", "h").agg(F.min("text").alias("text"))
    return languages, stored(picked.select("k", "text"), "training")


def fit(docs: DataFrame) -> Filters:
    """Filters learned from text and lang of the rows of docs outside the held-out fold."""
    spark = docs.sparkSession
    languages, sample = training_sample(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            which = batch.column(0).to_numpy()
            for hashes, owners, _ in grams(batch.column(1)):
                for k in np.unique(which[owners]):
                    told, n = np.unique(hashes[which[owners] == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(told.view(np.int64)), pa.array(np.full(len(told), k, np.int32)), pa.array(n.astype(np.int64))], ["gram", "k", "n"])

    counts = stored(sample.mapInArrow(count, "gram long, k int, n long").groupBy("gram", "k").agg(F.sum("n").alias("n")), "grams")
    totals = F.broadcast(counts.groupBy("k").agg(F.sum("n").alias("total")))  # LANGUAGES rows at most
    rates = counts.join(totals, "k").select("gram", "k", (F.col("n") / F.col("total")).alias("rate"))
    by_gram = rates.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("k", "rate")).alias("ks"))  # LANGUAGES entries at most
    sets = stored(by_gram.select("gram", F.explode(F.filter("ks", lambda x: x["rate"] >= SHARE * F.col("best"))).alias("x")).select("gram", F.col("x.k").alias("k")), "sets")
    largest = max([r["n"] for r in sets.groupBy("k").agg(F.count("*").alias("n")).collect()], default=1)
    size = min(1 << (PER_GRAM * largest - 1).bit_length(), MAX_SLOTS)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ks = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            bits = (np.uint64(1) << (ks % 64).astype(np.uint64)).view(np.int64)
            for at in slots(hashes, size):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array((ks // 64).astype(np.int32)), pa.array(bits)], ["slot", "word", "bits"])

    filled = sets.mapInArrow(spread, "slot int, word int, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()  # MAX_SLOTS rows at most for 64 languages
    table = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
    table[filled["slot"].to_numpy(), filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    return Filters(languages, table)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs, from its whole text, however long.

    lang_pred is a learned language, or "und" with score 0 where the text is null, empty or without a letter (or no language was
    learned). score is the language's share of all corrected hits; a text with letters and no hits gets the
    most frequent language and 1 / the number of languages, and equal counts the more frequent one. held_out is false for a null id.
    Equal rows get equal rows; only doc_id and text of docs are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    wrong = filters.false_positives()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            languages, score = shared.value.decide(batch.column(1), wrong)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    out = docs.select(docs["doc_id"].alias("id"), docs["text"].alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
