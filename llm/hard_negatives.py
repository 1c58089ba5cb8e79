"""Hard-negative mining over a vector-approximation file.

Rows and anchors meet in tiles of bounded size. In a tile every dimension of the rows is quantised into
256 cells of about equal numbers of rows, one byte each. For an anchor, tables of what a cell adds to the
inner product at least and at most are summed by lookup, which gives a lower and an upper bound of every
row's score. Only rows whose bounds say that they may enter a window (the first of the same label, or the
first of other labels between two scores) are scored exactly. Each tile returns the few best rows of a
window, and a ranking over all tiles gives the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import broadcast_if_few, stored

#: Rows and anchors of a tile, and anchors whose bounds are summed at once.
ROWS, ANCHORS, AT_ONCE = 16_384, 1024, 128
CELLS = 256
#: Largest magnitude of a quantised component: inner products of up to 2^14 of them fit in a long.
LIMIT = 1 << 24
_LAST = np.iinfo(np.int64).max


class Approximation:
    """The cells of some vectors of one length: a code for every vector and dimension, and the least and greatest value of every cell."""

    def __init__(self, q: np.ndarray):
        n, dim = q.shape
        self.q, self.codes = q, np.zeros((dim, n), np.intp)
        self.low, self.high = np.zeros((dim, CELLS), np.int64), np.zeros((dim, CELLS), np.int64)
        for d in range(dim):
            values = np.sort(q[:, d])
            edges = values[np.arange(1, CELLS) * n // CELLS]
            self.codes[d] = np.searchsorted(edges, q[:, d], "right")
            cells = np.searchsorted(edges, values, "right")
            first, last = np.searchsorted(cells, np.arange(CELLS)), np.searchsorted(cells, np.arange(CELLS), "right") - 1
            held = last >= first
            self.low[d, held], self.high[d, held] = values[first[held]], values[last[held]]
        self.largest = int(np.abs(q).max(initial=0))

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (rows by anchors) of the inner products, summed from tables of cells by anchors."""
        n, m = self.codes.shape[1], len(anchors)
        kind = np.int32 if len(self.codes) * self.largest * int(np.abs(anchors).max(initial=0)) < 1 << 31 else np.int64
        lower, upper, held = np.zeros((n, m), kind), np.zeros((n, m), kind), np.zeros((n, m), kind)
        for d, codes in enumerate(self.codes):
            a = self.low[d][:, None] * anchors[:, d].astype(np.int64)
            b = self.high[d][:, None] * anchors[:, d].astype(np.int64)
            lower += np.take(np.minimum(a, b).astype(kind), codes, 0, held, "clip")
            upper += np.take(np.maximum(a, b).astype(kind), codes, 0, held, "clip")
        return lower, upper

    def exact(self, anchors: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Inner products of the pairs (row, anchor), in exact integers."""
        dim = self.q.shape[1]
        fits = dim * self.largest * int(np.abs(anchors).max(initial=0)) < 1 << 53
        kind = np.float64 if fits else np.int64
        if fits and len(rows) * 16 > len(self.q) * len(anchors):
            return (self.q.astype(kind) @ anchors.astype(kind).T)[rows, columns].astype(np.int64)
        out = np.zeros(len(rows), np.int64)
        for at in range(0, len(rows), 1 << 16):
            part = slice(at, at + (1 << 16))
            out[part] = np.einsum("ij,ij->i", self.q[rows[part]].astype(kind), anchors[columns[part]].astype(kind)).astype(np.int64)
        return out


def _threshold(lower: np.ndarray, told: np.ndarray, count: int) -> np.ndarray:
    """For every column the count-th largest of its told entries; the least number of the kind where fewer are told."""
    if len(lower) < count:
        return np.full(lower.shape[1], np.iinfo(lower.dtype).min, lower.dtype)
    masked = np.where(told, lower, np.iinfo(lower.dtype).min)
    return np.partition(masked, len(lower) - count, 0)[len(lower) - count]


def _first(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count`` of every group, higher scores first and smaller ids among equal ones."""
    order = np.lexsort((ids, -scores, groups))
    groups = groups[order]
    begin = np.searchsorted(groups, groups)
    return order[np.arange(len(order)) - begin < count]


def _vectors(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def _by_length(rows: pa.Table, anchors: pa.Table):
    """The pairs of rows and anchors whose vectors have one length, in turn."""
    one = lambda t: t.combine_chunks() if t.num_rows else t
    rows, anchors = one(rows), one(anchors)
    have, want = (np.asarray(pc.list_value_length(t["q"])) for t in (rows, anchors))
    for length in np.intersect1d(have, want):
        yield rows.filter(pa.array(have == length)), anchors.filter(pa.array(want == length))


def _order(column) -> np.ndarray:
    return pc.fill_null(column, int(_LAST)).to_numpy()


def best_positives(count: int):
    """Of a tile, the first ``count`` other rows of every anchor's label."""

    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "row": [], "score": []}
        ids = []
        for r, a in _by_length(rows, anchors):
            ra, la = r["label"].to_numpy(), a["label"].to_numpy()
            for label in np.intersect1d(ra, la):
                mine, its = r.filter(pa.array(ra == label)), a.filter(pa.array(la == label))
                file, q = Approximation(_vectors(mine["q"].combine_chunks())), _vectors(its["q"].combine_chunks())
                keys, order = mine["row"].to_numpy(), _order(mine["id"])
                for at in range(0, len(q), AT_ONCE):
                    some = q[at : at + AT_ONCE]
                    own = its["row"].to_numpy()[at : at + AT_ONCE]
                    lower, upper = file.bounds(some)
                    other = keys[:, None] != own
                    i, j = np.nonzero(other & (upper >= _threshold(lower, other, count)))
                    scores = file.exact(some, i, j)
                    top = _first(j, scores, order[i], count)
                    out["anchor"].append(own[j[top]])
                    out["row"].append(keys[i[top]])
                    out["score"].append(scores[top])
                    ids.append(mine["id"].combine_chunks().take(pa.array(i[top])))
        if not ids:
            return pa.table({"anchor": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        return pa.table({"anchor": np.concatenate(out["anchor"]), "row": np.concatenate(out["row"]), "id": pa.chunked_array(ids), "score": np.concatenate(out["score"])})

    return tile


def best_negatives(count: int, least: int, most: int):
    """Of a tile, the first ``count`` rows of other labels in the window of every positive of every anchor."""

    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "place": [], "row": [], "score": []}
        ids = []
        for r, a in _by_length(rows, anchors):
            file, q = Approximation(_vectors(r["q"].combine_chunks())), _vectors(a["q"].combine_chunks())
            keys, order, labels = r["row"].to_numpy(), _order(r["id"]), r["label"].to_numpy()
            own, its = a["row"].to_numpy(), a["label"].to_numpy()
            positives = a["scores"].to_pylist()
            for at in range(0, len(q), AT_ONCE):
                some = q[at : at + AT_ONCE]
                lower, upper = file.bounds(some)
                other = labels[:, None] != its[at : at + AT_ONCE]
                windows = positives[at : at + AT_ONCE]
                for place in range(max(map(len, windows))):
                    # Percent of the positive's score, rounded inwards; a window that is empty or missing holds nothing.
                    bounds = [(-(-least * w[place] // 100), most * w[place] // 100) if place < len(w) else (1, 0) for w in windows]
                    low, high = np.array(bounds, np.int64).T
                    sure = other & (lower >= low) & (upper <= high)
                    i, j = np.nonzero(other & (upper >= low) & (lower <= high) & (low <= high) & (upper >= _threshold(lower, sure, count)))
                    scores = file.exact(some, i, j)
                    inside = (scores >= low[j]) & (scores <= high[j])
                    i, j, scores = i[inside], j[inside], scores[inside]
                    top = _first(j, scores, order[i], count)
                    out["anchor"].append(own[at : at + AT_ONCE][j[top]])
                    out["place"].append(np.full(len(top), place, np.int32))
                    out["row"].append(keys[i[top]])
                    out["score"].append(scores[top])
                    ids.append(r["id"].combine_chunks().take(pa.array(i[top])))
        if not ids:
            return pa.table({"anchor": pa.array([], pa.int64()), "place": pa.array([], pa.int32()), "row": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        return pa.table({"anchor": np.concatenate(out["anchor"]), "place": np.concatenate(out["place"]), "row": np.concatenate(out["row"]), "id": pa.chunked_array(ids), "score": np.concatenate(out["score"])})

    return tile


def _block(salt: int, key: str, blocks) -> F.Column:
    return F.pmod(F.xxhash64(F.lit(salt), key), blocks).cast("int")


def _new(*names: str) -> list[F.Column]:
    """Columns of their own, so that a table can meet another one made from the same rows."""
    return [F.col(name).alias(name) for name in names]


def _parts(n: F.Column, size: int) -> F.Column:
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def hard_negatives(
    vectors: DataFrame, anchors: str = "vec_id % 100 = 0", relabel: str = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS DECIMAL(20,0)) + 1) % 10 ELSE label END",
    scale: int = 256, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` and ``relabel`` are SQL over the columns of vectors: which rows are anchors, and the label (a
    whole number) that counts. Components become floor(scale * x); a score is the integer inner product.
    An anchor's positives are its first other rows of the same label, and for each of them the first rows
    of other labels whose score lies between ``least`` and ``most`` percent of the positive's are returned;
    a negative positive score leaves no such rows. Higher scores come first, then smaller ids (null ids last).
    Rows with a null label or vector, or a component that is null, NaN, infinite or of a magnitude from LIMIT / scale on
    (whose scores might not fit in a long) take no part. Scores exist between vectors of one length only. Every row counts as a vector of its own,
    repeated rows and ids too. Other columns play no part; an empty table gives no rows.
    """
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x * scale) < LIMIT, F.lit(False)))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), F.expr(relabel).cast("long").alias("label"), vectors[vector_col].cast("array<double>").alias("v"), F.coalesce(F.expr(anchors), F.lit(False)).alias("asks"), vectors[label_col].alias("given"))
    rows = rows.where(F.col("given").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "asks", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("q")), "rows")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()

    # Positives: labels are dealt into bins, a bin into blocks of rows and of anchors.
    binned = rows.withColumn("bin", _block(0, "label", F.lit(max(1, n // ROWS))))
    sizes = binned.groupBy("bin").agg(_parts(F.count("*"), ROWS).alias("ni"), _parts(F.count_if("asks"), ANCHORS).alias("nj"))
    placed = binned.join(broadcast_if_few(stored(sizes, "sizes")), "bin")
    left = placed.withColumn("i", _block(1, "row", F.col("ni"))).withColumn("j", F.explode(F.expr("sequence(0, nj - 1)"))).select("bin", "i", "j", "row", "id", "label", "q")
    right = placed.where("asks").withColumn("j", _block(2, "row", F.col("nj"))).withColumn("i", F.explode(F.expr("sequence(0, ni - 1)"))).select(*_new("bin", "i", "j", "row", "label", "q"))
    found = left.groupBy("bin", "i", "j").cogroup(right.groupBy("bin", "i", "j")).applyInArrow(best_positives(positives), "anchor long, row long, id long, score long")
    by_rank = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    first = stored(found.withColumn("place", F.row_number().over(by_rank)).where(F.col("place") <= positives), "positives")

    # Negatives: all rows in blocks against all anchors in blocks, each anchor with the scores of its positives.
    windows = first.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("w"))
    windows = rows.where("asks").select("row", "label", "q").join(windows, "row").withColumn("scores", F.col("w.score")).drop("w")
    ni, nj = max(1, -(-n // ROWS)), max(1, -(-asked // ANCHORS))
    left = rows.withColumn("i", _block(1, "row", F.lit(ni))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nj - 1)))).select("i", "j", "row", "id", "label", "q")
    right = windows.withColumn("j", _block(2, "row", F.lit(nj))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(ni - 1)))).select(*_new("i", "j", "row", "label", "q", "scores"))
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(best_negatives(negatives, least, most), "anchor long, place int, row long, id long, score long")
    by_rank = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    last = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= negatives).select("anchor", (F.col("place") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = rows.where("asks").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    told = first.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(names, "anchor")
    return last.join(told, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
