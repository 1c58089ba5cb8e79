"""Toxicity by multiple-instance learning: document labels train a sentence model through noisy-or.

A sentence's logit is the sum of the weights of its words' features (the word, its first four and its
first six bytes, hashed) over that of a neutral sentence, one without any told word. What a sentence adds to
its document is its softplus less that of a neutral one, and never less than 0, so that length alone
makes nothing toxic; a document is toxic unless every sentence, and a leak as large as one neutral
sentence, are harmless: p = 1 - exp(-(leak + sum)). This is what is trained and what is scored. The
gradient of a document's loss falls on the sentences that explain the label, and the trained sentence
scores point at the offending ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import slices
from llm.words import PUNCTUATION, Words, mix, span_hashes

_BITS = 20
_PREFIXES = (4, 6)
_terminator = np.zeros(256, bool)
_terminator[list(b".!?\n")] = True

#: Bounds of the training sample, in rows of each class and bytes of each class's whole texts; the rows come in the order of a hash.
MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 2500, 5000, 24 << 20


@dataclass
class Bags:
    """Features of words, the first word of every sentence, and the first sentence of every document (n+1 entries)."""

    features: np.ndarray
    sentences: np.ndarray
    documents: np.ndarray
    words: Words


def bags(column: pa.Array | pa.ChunkedArray) -> Bags:
    """Sentences end at . ! ? and line ends, but at most once in each eight words of a document; one without words doesn't count."""
    w = Words(column, PUNCTUATION)
    kinds = [w.hashes, *(span_hashes(w.data, w.starts, np.minimum(w.ends, w.starts + k)) for k in _PREFIXES)]
    shift = np.uint64(64 - _BITS)
    features = np.stack([(mix(h + np.uint64(k)) >> shift).astype(np.int32) for k, h in enumerate(kinds)], 1)
    n = len(w.starts)
    if not n:
        return Bags(features, np.zeros(0, np.int64), np.zeros(len(w) + 1, np.int64), w)
    marks = np.concatenate([[0], np.cumsum(_terminator[w.data], dtype=np.int32)])
    first = np.ones(n, bool)
    first[1:] = marks[w.starts[1:]] > marks[w.ends[:-1]]
    begins = np.unique(w.at[:-1][w.at[:-1] < n])
    first[begins] = True  # whatever the text before ends with
    owner = np.searchsorted(begins, np.arange(n), "right") - 1
    at = np.flatnonzero(first)
    block = (at - begins[owner[at]]) // 8
    once = np.ones(len(at), bool)
    once[1:] = (block[1:] != block[:-1]) | (owner[at][1:] != owner[at][:-1])
    sentences = at[once]
    return Bags(features, sentences, np.searchsorted(sentences, w.at), w)


STEPS = 300
#: The logit of a neutral sentence, and what it would add: the leak of every document.
NEUTRAL = -5.0
LEAK = float(np.logaddexp(0, NEUTRAL))


@dataclass
class Model:
    weights: np.ndarray

    def sentence_logits(self, b: Bags) -> np.ndarray:
        """A word that a sentence repeats counts once; most words weigh nothing and drop out early."""
        z = np.full(len(b.sentences), NEUTRAL)
        by_word = self.weights[b.features].sum(1, dtype=np.float64)
        if len(told := np.flatnonzero(by_word)):
            owner = np.searchsorted(b.sentences, told, "right") - 1
            order = np.lexsort((b.words.hashes[told], owner))
            told, owner = told[order], owner[order]
            new = np.ones(len(told), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (b.words.hashes[told][1:] != b.words.hashes[told][:-1])
            z += np.bincount(owner[new], by_word[told[new]], len(z))
        return z


def added(logits: np.ndarray) -> np.ndarray:
    """What sentences of these logits add to their documents."""
    return np.maximum(np.logaddexp(0, logits) - LEAK, 0)


def noisy_or(logits: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """1 - exp(-(leak + what the sentences add)) for each document; the leak alone without sentences."""
    sums = np.concatenate([[0.0], np.cumsum(added(logits))])
    return -np.expm1(-(LEAK + sums[documents[1:]] - sums[documents[:-1]]))


def train(column: pa.Array | pa.ChunkedArray, toxic: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.4, lasso: float = 1e-3) -> Model:
    """Adagrad with an L1 step on the log-loss of document labels under noisy_or.

    At the neutral logit a sentence's gradient is that from above, so that training can start there; below,
    it adds nothing and has none, but in a toxic document keeps the slope of its softplus, so that what
    fell too far can come back. Small samples are passed over more often, for STEPS steps at least. Features of fewer than three documents stay at 0. The word and the long prefix are each left out
    of half of the batches, so that the short prefix alone comes to carry unseen word forms.
    """
    n = len(toxic)
    size = 1 << _BITS
    if not n or not 0 < toxic.sum() < n:
        return Model(np.zeros(size, np.float32))
    # The words of all documents as features, built from a few documents at a time.
    parts, at, documents, sentences, seen = [], [0], [0], [], np.zeros(size, np.int32)
    for k in range(0, n, 128):
        b = bags(column.slice(k, 128))
        parts.append(b.features)
        sentences.append(b.sentences + at[-1])
        documents += (b.documents[1:] + documents[-1]).tolist()
        for low, high in zip(b.words.at[:-1], b.words.at[1:]):
            seen[np.unique(b.features[low:high])] += 1
        at += (b.words.at[1:] + at[-1]).tolist()
    kept = np.flatnonzero(seen >= 3)
    ids = np.zeros(size, np.int32)
    ids[kept] = np.arange(1, len(kept) + 1)
    features = ids[np.concatenate(parts)]
    del parts, ids, seen
    sentences, documents = np.concatenate(sentences), np.array(documents)
    first, last = np.array(at[:-1]), np.array(at[1:])
    w = np.zeros(len(kept) + 1)
    squares = np.full(len(w), 1e-6)
    rng = np.random.default_rng(0)
    for _ in range(max(epochs, -(-STEPS * batch // n))):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            docs = order[k : k + batch]
            words = np.concatenate([np.arange(first[d], last[d]) for d in docs])
            sizes = np.concatenate([np.diff(np.append(sentences[documents[d] : documents[d + 1]], last[d])) for d in docs])
            counts = documents[docs + 1] - documents[docs]
            if not len(words):
                continue
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            f = features[words]
            f[:, [k for k in (0, 2) if rng.random() < 0.5]] = 0
            z = NEUTRAL + np.add.reduceat(w[f].sum(1), begins)
            owner = np.repeat(np.arange(len(docs)), counts)
            s = LEAK + np.bincount(owner, added(z), len(docs))
            slope = np.where(toxic[docs] == 1, -1 / np.expm1(np.minimum(s, 50)), 1.0)
            live = (z >= NEUTRAL) | (toxic[docs] == 1)[owner]
            g = slope[owner] * live / (1 + np.exp(-np.maximum(z, -500)))
            g_word = np.repeat(g, sizes)
            gradient = np.bincount(f.ravel(), np.repeat(g_word, f.shape[1]), len(w)) / len(docs)
            gradient[0] = 0
            squares += gradient**2
            step = rate / np.sqrt(squares)
            w -= step * gradient
            w = np.sign(w) * np.maximum(np.abs(w) - step * lasso, 0)
    full = np.zeros(size, np.float32)
    full[kept] = w[1:]
    return Model(full)


def held_out(id_col, folds: int = 5):
    """Whether a row is kept from training; one with a null id isn't, and has no label either."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, toxic, text): at most MAX_TOXIC and MAX_CLEAN labelled rows outside the held-out fold, in the order of a hash, with their whole texts.

    Rows that share an id and a text are one. A class ends with the row that fills its MAX_BYTES.
    """
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"), folds))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    pick = lambda rows, t, n: rows.where(F.col("toxic") == t).orderBy(*order[: len(rows.columns)]).limit(n)
    ids = pick(known, 1, MAX_TOXIC).unionAll(pick(known, 0, MAX_CLEAN))  # bounded, so it may be broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    sizes = texts.select("doc_id", "h", F.octet_length("text").cast("long").alias("n")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic", "h").agg(F.max("n").alias("n"))
    rows = pick(sizes, 1, MAX_TOXIC).unionAll(pick(sizes, 0, MAX_CLEAN))  # an id may have many texts
    so_far = F.sum("n").over(Window.partitionBy("toxic").orderBy(*order))  # over the rows chosen
    fit_in = rows.withColumn("before", so_far - F.col("n")).where(F.col("before") < MAX_BYTES).select("doc_id", "toxic", "h")
    return texts.join(F.broadcast(fit_in), ["doc_id", "h"]).groupBy("doc_id", "toxic", "h").agg(F.min("text").alias("text")).select("doc_id", "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    rows = training_sample(docs, labels, folds).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train(rows["text"], rows["toxic"].to_numpy())


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores under 0.5; null and empty texts among them."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value)
        for batch in slices(batches, text=at):
            b = bags(batch.column(at))
            yield batch.filter(pa.array(noisy_or(m.sentence_logits(b), b.documents) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_sentences, offending) for every row of docs.

    score is the noisy-or of the sentences of the whole text, however long (the leak, under 0.01, for null
    and empty texts and those without words); held_out is false for a null id; predicted is 1 from 0.5; offending lists start:end in bytes of UTF-8 of the
    sentences whose own score is 0.5 or more. Equal rows get equal rows; other columns of docs play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value)
        for batch in slices(batches):
            b = bags(batch.column(1))
            z = m.sentence_logits(b)
            scores = noisy_or(z, b.documents)
            offending = [""] * len(scores)
            if len(hot := np.flatnonzero(z >= 0)):
                last = np.append(b.sentences[1:], len(b.words.starts)) - 1
                for s, d in zip(hot, np.searchsorted(b.documents, hot, "right") - 1):
                    low = b.words.offsets[d]
                    span = f"{b.words.starts[b.sentences[s]] - low}:{b.words.ends[last[s]] - low}"
                    offending[d] += "," * bool(offending[d]) + span
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(np.diff(b.documents)), pa.array(offending, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "predicted", "n_sentences", "offending"])

    chosen = docs.select(docs["doc_id"].alias("id"), docs["text"].alias("text"))
    out = chosen.mapInArrow(run, f"id {kind}, score double, predicted int, n_sentences long, offending string").withColumnRenamed("id", "doc_id")
    return out.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", "predicted", "n_sentences", "offending")
