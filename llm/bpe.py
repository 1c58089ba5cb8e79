"""Byte-level BPE over a rank file: merges are taken from a hierarchical-bitmap rank queue.

Each merge rank owns a bucket of the linked-list positions whose pair has that rank. A three-level
bitmap over the ranks finds the lowest occupied bucket by find-first-set; within it the leftmost
position comes first. An entry is stale, and skipped, when the pair at its position has changed.
A piece of n bytes takes O(n log n), so one very long pre-token costs no more than many short ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from llm.frames import slices

#: 1 << k for k below 64.
_BIT = tuple(1 << k for k in range(64))


class RankQueue:
    """Three bitmap levels over the ranks and a bucket of positions for every occupied rank.

    The queue is empty between pieces, so one queue serves an encoder for good.
    """

    def __init__(self, n_ranks: int):
        n = max(1, -(-n_ranks // 64))
        self.low, self.mid, self.top = [0] * n, [0] * -(-n // 64), 0
        self.buckets: dict[int, list[int]] = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The content of a rank file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Encoder:
    """encode(text) as little-endian unsigned 32-bit ids; decode(ids) as bytes."""

    CACHED_PIECES, CACHED_LENGTH = 400_000, 48

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        encoder = self

        class Cache(dict):
            """Packed ids by piece, in two bounded generations: what a generation used outlives it. Long pieces don't stay."""

            older: dict[str, bytes] = {}

            def __missing__(self, piece: str) -> bytes:
                packed = self.older.get(piece) or np.array(encoder.merge(piece.encode()), "<u4").tobytes()
                if len(piece) <= encoder.CACHED_LENGTH:
                    if len(self) >= encoder.CACHED_PIECES:
                        self.older = dict(self)
                        self.clear()
                    self[piece] = packed
                return packed

        self.packed = Cache()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank merges first, the leftmost of equals.

        The queue's steps are written out here: calls would cost more than the work.
        """
        get, queue = self.ranks.get, self.queue
        if (whole := get(piece)) is not None:
            return [whole]
        low, mid, buckets, top = queue.low, queue.mid, queue.buckets, 0
        n = len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank_at = [-1] * (n + 1)
        fresh = [(get(piece[i : i + 2]), i) for i in range(n - 1)]
        while True:
            for r, i in fresh:
                rank_at[i] = -1 if r is None else r
                if r is None:
                    continue
                if r in buckets:
                    heappush(buckets[r], i)
                    continue
                buckets[r] = [i]
                word = r >> 6
                if not low[word]:
                    mid[word >> 6] |= _BIT[word & 63]
                    top |= 1 << (word >> 6)
                low[word] |= _BIT[r & 63]
            while top:  # find first set, level by level
                m = (top & -top).bit_length() - 1
                bits = mid[m]
                word = (m << 6) | ((bits & -bits).bit_length() - 1)
                bits = low[word]
                r = (word << 6) | ((bits & -bits).bit_length() - 1)
                bucket = buckets[r]
                i = heappop(bucket)
                if not bucket:
                    del buckets[r]
                    low[word] = bits = bits & (bits - 1)
                    if not bits:
                        mid[m] = bits = mid[m] & (mid[m] - 1)
                        if not bits:
                            top &= top - 1
                if rank_at[i] == r:  # else the entry is stale
                    break
            else:
                break
            gone = after[i]
            end = after[gone]
            after[i] = end
            rank_at[gone] = rank_at[i] = -1
            if end < n:
                before[end] = i
                fresh = [(get(piece[i : after[end]]), i)]
            else:
                fresh = []
            if (left := before[i]) >= 0:
                fresh.append((get(piece[left:end]), left))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.pieces(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_encoders: dict[int, Encoder] = {}


def encoder_of(data, pattern: str) -> Encoder:
    """The encoder of a broadcast rank file, made once in each Python worker."""
    key = hash((pattern, hashlib.sha256(data).digest()))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(id, ids array<int>, n_tokens, ids_sha256, decoded_sha256, exact) of every row of docs, whatever else docs holds.

    Ids may be of any type and null. A null text counts as empty; an empty text has no tokens and the
    digests of no bytes; a very long one is encoded whole, in n log n of its longest piece. Equal rows
    give equal rows. ``exact`` says that decoding gave the text's bytes back. ids is left out with
    keep_ids=False. The rank file (under 1 MB, fixed) is read by the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)[id_col]
    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in slices(batches):
            packed, digests, backs, exact = [], [], [], []
            for text in batch.column(1).to_pylist():
                p = encoder.encode(text or "")
                back = encoder.decode(p)
                packed.append(p)
                digests.append(sha(p))
                backs.append(sha(back))
                exact.append(back == (text or "").encode())
            lengths = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
            columns = [batch.column(0)]
            if keep_ids:
                ids = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), ids))
            columns += [pa.array(lengths), pa.array(digests, pa.string()), pa.array(backs, pa.string()), pa.array(exact, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", *(["ids"] if keep_ids else []), "n_tokens", "ids_sha256", "decoded_sha256", "exact"]
    schema = f"id {kind}, " + "ids array<int>, " * keep_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)
