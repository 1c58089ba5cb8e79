"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors of a label are projected on many random lines. On each line, sorted, a pair collides when one
lies in the window centred on the other. The number of collisions over all lines grows with the
cosine; pairs that reach a count chosen so that a pair at the threshold passes with the wanted
probability are verified in double precision. A line is cut into sixteen parts of equal size, a window
takes the parts that it touches, and the collisions of a pair are the bits that its two codes share.

Large labels are first cut into cells by a few wide-bucket projections, in as many independent tables
as the wanted recall needs; the number of cuts follows the logarithm of the label's size, so that
cells keep their size. A cell that stays large is compared block by block, exactly and in bounded
memory. Equal vectors are one class with a count, so copies are never paired with one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import components, named_components
from llm.frames import broadcast_if_few, stored
from llm.words import mix

LINES, RECALL = 32, 0.9995
#: Vectors in a cell that are compared at once; above, blocks of half as many. A label of up to twice as many is not cut.
CELL = 16_384
BUCKET = 2.0
#: Parts of a line, and rows and columns of a tile that are compared at once.
PARTS, ROWS, COLUMNS = 16, 64, 2048


def collision_rule(cosine: float, lines: int = LINES, recall: float = RECALL) -> tuple[float, int]:
    """Half-width of the windows, and the least count that a pair at the threshold reaches with probability ``recall``."""
    spread = math.sqrt(2 - 2 * cosine)
    width = 2.0 * spread
    p = math.erf(width / spread / math.sqrt(2))
    count, tail = lines + 1, 0.0
    while tail < recall and count > 0:
        count -= 1
        tail += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
    return width, count


def table_rule(n: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """Cuts of a label of n vectors, and tables of cells so that a pair at the threshold shares a cell in one of them."""
    together = lambda spread: 1 - spread * math.sqrt(2 / math.pi) / BUCKET  # noqa: E731  for spreads below the bucket
    near, far = together(math.sqrt(2 - 2 * cosine)), 0.5
    cuts = 0 if n <= 2 * CELL else math.ceil(math.log(n / CELL) / math.log(1 / far))
    return cuts, 1 if not cuts else math.ceil(math.log(1 - recall) / math.log(1 - near**cuts))


@lru_cache(64)
def _lines(dim: int, seed: int, n: int) -> np.ndarray:
    return np.random.default_rng([dim, seed]).normal(size=(dim, n))


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _cells(dim: int, units: np.ndarray, cuts: int, tables: int) -> np.ndarray:
    """The cell of every vector in every table, as a hash of the table and its cuts."""
    out = np.zeros((len(units), tables), np.uint64)
    for t in range(tables):
        key = np.full(len(units), t + 1, np.uint64)
        if cuts:
            offsets = np.random.default_rng([dim, t, 7]).uniform(0, BUCKET, cuts)
            buckets = np.floor((units @ _lines(dim, 1000 + t, cuts) + offsets) / BUCKET).astype(np.int64)
            for k in range(cuts):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + buckets[:, k].astype(np.uint64))
        out[:, t] = key
    return out


def _codes(units: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """One bit for the part of each line that holds the vector, and one for every part that its window touches, as 64-bit words."""
    n, dim = units.shape
    projected = units @ _lines(dim, 0, LINES)
    edges = np.sort(projected, 0)[np.arange(1, PARTS) * n // PARTS]
    place = np.arange(PARTS)
    own, window = np.zeros((n, LINES, PARTS), bool), np.zeros((n, LINES, PARTS), bool)
    for k in range(LINES):
        x = projected[:, k]
        own[:, k] = np.searchsorted(edges[:, k], x, "right")[:, None] == place
        low, high = np.searchsorted(edges[:, k], x - width, "right"), np.searchsorted(edges[:, k], x + width, "right")
        window[:, k] = (low[:, None] <= place) & (place <= high[:, None])
    return tuple(np.packbits(x.reshape(n, -1), 1).view(np.uint64) for x in (own, window))


def linked(units: np.ndarray, across: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j with the cosine, found by counting collisions, for a few i at a time; with ``across`` > 0 only those with i < across <= j."""
    n = len(units)
    width, least = collision_rule(cosine)
    own, window = _codes(units, width)
    own = np.ascontiguousarray(own.T)
    for low in range(0, across or n, ROWS):
        high = min(low + ROWS, across or n)
        left, right = [], []
        for begin in range(across or low, n, COLUMNS):
            end = min(begin + COLUMNS, n)
            counts = np.zeros((high - low, end - begin), np.uint8)
            for w in range(len(own)):
                counts += np.bitwise_count(window[low:high, w][:, None] & own[w, begin:end])
            i, j = np.nonzero(counts >= least)
            i, j = i + low, j + begin
            if not across:
                i, j = i[i < j], j[i < j]
            if len(i) * 16 > counts.size:
                ok = (units[low:high] @ units[begin:end].T)[i - low, j - begin] >= cosine
            else:
                ok = np.einsum("ij,ij->i", units[i], units[j]) >= cosine
            left.append(i[ok])
            right.append(j[ok])
        yield np.concatenate(left), np.concatenate(right)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position reachable from each of n over pairs (i, j)."""
    root = np.arange(n)
    while True:
        old = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == old).all():
            return root


def _spanning(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs with the same components as those of a few i: every j with one i, and the i that share a j."""
    if not len(i):
        return i, j
    base, first = i.min(), np.full(j.max() + 1, -1)
    first[j[::-1]] = i[::-1]
    told = np.flatnonzero(first >= 0)
    both = np.flatnonzero(np.bincount((i - base) * ROWS + first[j] - base, minlength=ROWS * ROWS))
    return np.concatenate([first[told], both // ROWS + base]), np.concatenate([told, both % ROWS + base])


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of vectors.

    Rows link when their labels are equal and not null, their vectors have one length, and the cosine
    is at least ``cosine`` (a pair just at it too). Vectors are arrays of any number type. Null, empty and zero vectors and those with null or non-finite components
    link with nothing. Every row counts as a vector of its own, repeated rows and ids too; component_id
    is the smallest id reachable and kept says that it is the row's own. Other columns play no part.
    """
    kinds = dict(vectors.dtypes)
    kind = kinds[vector_col] if kinds[vector_col] in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].cast(kind).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    # The class of a row, a digest of its label and vector. Rows that link with nothing have none.
    digest = F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), F.col("label").cast("string"), "v")), 16, "0") for k in (1, 2)]))
    rows = rows.withColumn("cls", F.when(fine, digest))
    named = stored(rows.select("id", "cls"), "vectors")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.count("*").alias("copies"), F.min("id").alias("least_id"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = stored(classes.select("cls", "copies", "least_id", F.xxhash64(F.col("label").cast("string"), F.size("v")).alias("part"), F.size("v").alias("dim"), "v"), "classes")
    sizes = stored(classes.groupBy("part").agg(F.count("*").alias("n")), "sizes")
    sized = classes.join(broadcast_if_few(sizes), "part").select("cls", "copies", "part", "dim", "n", "v")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ns = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
            for dim, n in sorted(set(zip(dims.tolist(), ns.tolist()))):
                part = batch.filter(pa.array((dims == dim) & (ns == n)))
                cuts, tables = table_rule(n, cosine)
                cells = _cells(dim, _units(part.column(5), dim), cuts, tables).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, cells.size + 1, tables, dtype=np.int32)), pa.array(cells.ravel()))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in (0, 1, 2, 5)), lists, pa.array(np.full(part.num_rows, t, np.int32)), pa.array(cells[:, t])], ["cls", "copies", "part", "v", "cells", "t", "cell"])

    cells = sized.mapInArrow(spread, f"cls binary, copies long, part long, v {kind}, cells array<long>, t int, cell long")
    # Only cells of more than CELL are cut into blocks; only labels of more can have them.
    large = sized.where(F.col("n") > CELL).mapInArrow(spread, cells.schema).groupBy("part", "t", "cell").agg(F.count("*").alias("held")).where(F.col("held") > CELL)
    large = stored(large.withColumn("blocks", F.ceil(F.col("held") / (CELL // 2 - CELL // 8)).cast("int")).drop("held"), "large")
    placed = cells.join(broadcast_if_few(large), ["part", "t", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    tiles = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("part", "t", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "copies", "v", "cells")

    def compare(tile: pa.Table) -> pa.Table:
        tile = tile.take(pa.array(np.argsort(tile["own"].to_numpy(), kind="stable")))
        n, table = tile.num_rows, tile["t"][0].as_py()
        v, copies = tile["v"].combine_chunks(), tile["copies"].to_numpy()
        cells_of = tile["cells"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        two = tile["i"][0].as_py() != tile["j"][0].as_py()
        across = int(np.count_nonzero(tile["own"].to_numpy() == tile["i"][0].as_py())) if two else 0
        degree = np.zeros(n, np.int64)
        left, right = [], []
        for i, j in linked(_units(v, len(v[0])), across, cosine) if n > 1 and across < n and (across or not two) else ():
            if table:  # a pair counts in the first table that holds it in one cell
                new = ~(cells_of[i, :table] == cells_of[j, :table]).any(1)
                i, j = i[new], j[new]
            degree += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
            i, j = _spanning(i, j)
            left.append(i)
            right.append(j)
        root = _roots(n, np.concatenate(left), np.concatenate(right)) if left else np.arange(n)
        told = np.flatnonzero(degree)
        cls = tile["cls"].combine_chunks()
        return pa.table({"a": cls.take(pa.array(told)), "b": cls.take(pa.array(root[told])), "degree": pa.array(degree[told])})

    links = stored(tiles.groupBy("part", "t", "cell", "i", "j").applyInArrow(compare, "a binary, b binary, degree long"), "links")
    degrees = links.groupBy(F.col("a").alias("cls")).agg(F.sum("degree").alias("linked"))
    roots = components(links.select("a", "b")).withColumnRenamed("node", "cls")
    members = classes.select("cls", "least_id", "copies").join(degrees, "cls", "left")
    told = named_components(members, roots, classes.count()).select("cls", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = named.join(told, "cls", "left")
    component = F.coalesce("component_id", "id").cast(kinds[id_col])
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
