"""Near-duplicate documents by a chosen-path similarity join over word shingles.

Documents with one shingle set form a class. Each of several independent trees branches the classes:
a node chooses one coordinate of a 64-fold minwise signature, sometimes two (1.25 on average, the
inverse of the threshold), and its children are the classes that agree on the token chosen there. Small
nodes are compared exhaustively on signatures; what could reach the threshold is confirmed on full
sets. A node that is still large after the last level is compared block by block, so nothing is lost
to a size limit. The number of trees sets the recall of a pair just at the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import components, named_components
from llm.frames import broadcast_if_few, nested, row_order, slices, stored
from llm.words import Words, shingles

COORDINATES, TREES, LEVELS = 64, 10, 4
#: Classes in a node that are compared at once.
NODE = 2048
#: Shingles whose sets are held at once for one block of a group (8 bytes each); a group of more is compared block by block.
SET_MEMBERS = 4 << 20
GROUP_BYTES = 32 << 20
#: Five standard deviations under what a pair at the threshold shares of 64 coordinates.
LEAST_SHARED = 36
_rng = np.random.default_rng(5)
_A = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64)
#: Coordinates that the roots choose: one for each tree, and a second one for every fourth.
_ROOTS = [(t, [t, *([TREES + t // 4] if t % 4 == 0 else [])]) for t in range(TREES)]
_FREE = TREES + -(-TREES // 4)
#: Bits of the filter that tells which documents' sets are wanted: 4 MB at any size of the input.
FILTER_BITS = 1 << 25


def _class(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _sets(batch_text: pa.Array, size: int) -> list[np.ndarray]:
    w = Words(batch_text)
    return [shingles(w.hashes[a:b], size) for a, b in zip(w.at[:-1], w.at[1:])]


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, cls, sig): the class of a document without words is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = _sets(batch.column(1), size)
            counts = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(counts)
            sig = np.zeros((len(sets), COORDINATES), np.int32)
            if len(some):
                flat = np.concatenate([sets[k] for k in some])
                begins = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
                for k in range(COORDINATES):
                    sig[some, k] = (np.minimum.reduceat(flat * _A[k] + _B[k], begins) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES), pa.array(sig.ravel()))
            classes = pa.array([_class(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), classes, lists], ["id", "n_shingles", "cls", "sig"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, n_shingles long, cls binary, sig array<int>")


def whole_groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by a column of longs or binaries, in tables that cut no group, with the groups' bounds.

    A table is passed on once it holds 4096 rows or GROUP_BYTES, so memory is bounded where groups are.
    """
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def flush(table: pa.Table):
        key = table.column(column).combine_chunks()
        change = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        return table, np.concatenate([[0], np.flatnonzero(change) + 1, [len(key)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows < 4096 and size < GROUP_BYTES:
            continue
        table, bounds = flush(pa.Table.from_batches(held))
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
            held = table.slice(bounds[-2]).to_batches()
            rows, size = sum(b.num_rows for b in held), sum(b.nbytes for b in held)
    if rows:
        yield flush(pa.Table.from_batches(held))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position reachable from each of n over pairs (i, j)."""
    root = np.arange(n)
    while len(i):
        old = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == old).all():
            break
    return root


def candidates(nodes: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (path, cls, sig, n, own, i, j) of small nodes: (gid, cls), groups that could hold a link.

    A group is joined by pairs whose signatures and sizes allow the threshold; equal groups of several
    nodes get one gid. A group whose sets hold over SET_MEMBERS members is cut into blocks, and every two
    blocks, the same ones in all nodes that give the group, are a group of their own: no pair is lost and
    what is compared at once stays bounded by two blocks or by two texts.
    """
    for table, bounds in whole_groups(nodes, 0):
        sig = table["sig"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        n = table["n"].to_numpy()
        own, ti, tj = (table[c].to_numpy() for c in ("own", "i", "j"))
        cls = np.array(table["cls"].to_pylist(), object)
        gids, members = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a < 2:
                continue
            s, m = sig[a:b], n[a:b]
            if b - a == 2:
                alike = np.count_nonzero(s[0] == s[1]) >= LEAST_SHARED and 100 * m.min() >= percent * m.max()
                i, j = (np.array([0]), np.array([1])) if alike else (np.zeros(0, int),) * 2
            else:
                shared = np.zeros((b - a, b - a), np.uint8)
                for k in range(COORDINATES):
                    shared += s[:, k][:, None] == s[:, k]
                fits = 100 * np.minimum(m[:, None], m) >= percent * np.maximum(m[:, None], m)
                i, j = np.nonzero(np.triu((shared >= LEAST_SHARED) & fits, 1))
            if ti[a] != tj[a]:  # two blocks of a large node: each block is compared in itself elsewhere
                across = own[a + i] != own[a + j]
                i, j = i[across], j[across]
            if not len(i):
                continue
            root = _roots(b - a, i, j)
            used = np.unique(np.concatenate([i, j]))
            for r in np.unique(root[used]):
                at = a + used[root[used] == r]
                at = at[np.argsort(cls[at])]
                for part in _parts(n[at]):
                    group = cls[at[part]].tolist()
                    gids += [hashlib.blake2b(b"".join(group), digest_size=16).digest()] * len(group)
                    members += group
        if gids:
            yield pa.RecordBatch.from_arrays([pa.array(gids, pa.binary()), pa.array(members, pa.binary())], ["gid", "cls"])


def _parts(sizes: np.ndarray) -> list[np.ndarray]:
    """Places of members of these sizes that are compared together: all of them, or every two blocks of at most SET_MEMBERS (or one member)."""
    if sizes.sum() <= SET_MEMBERS:
        return [np.arange(len(sizes))]
    block, held, of = 0, 0, []
    for size in sizes.tolist():
        if held and held + size > SET_MEMBERS:
            block, held = block + 1, 0
        held += size
        of.append(block)
    of = np.array(of)
    return [np.flatnonzero((of == i) | (of == j)) for i in range(block + 1) for j in range(i if not block else i + 1, block + 1)]


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, from those members that several sets hold."""
    if len(sets) == 2:
        return np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    told = counts[ids] > 1
    owner, column = owner[told], number[ids[told]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def confirmed(groups: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (gid, cls, set): (a, b), for every class linked in its group, b being the group's class that stands for its component."""
    for table, bounds in whole_groups(groups, 0):
        cls, members = table["cls"].to_pylist(), table["members"].to_pylist()
        left, right = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            sets = [np.frombuffer(x, np.uint64) for x in members[a:b]]
            if len(sets) < 2:
                continue
            both = overlaps(sets)
            sizes = np.array([len(s) for s in sets])
            i, j = np.nonzero(np.triu(100 * both >= percent * (sizes[:, None] + sizes - both), 1))
            root = _roots(len(sets), i, j)
            for k in np.flatnonzero(root != np.arange(len(sets))):
                left.append(cls[a + k])
                right.append(cls[a + root[k]])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])


def _leaves(classes: DataFrame) -> DataFrame:
    """(path, cls, sig, n, own, i, j): the rows of all nodes of at least two classes and at most NODE, block pairs of larger ones after the last level."""
    child = lambda path, c: F.struct(F.xxhash64(path, c, F.element_at("sig", c + 1)).alias("path"))
    first = [child(F.lit(t), F.lit(c)) for t, chosen in _ROOTS for c in chosen]
    rows = classes.select("cls", F.explode(F.array(*first)).alias("x")).select("cls", "x.path")
    found = []
    for level in range(LEVELS):
        full = rows.groupBy("path").agg(F.count("*").alias("held")).where("held > 1")
        rows = stored(rows.join(full, "path").select("path", "cls", "held"), f"level{level}")
        found.append(rows.where(F.col("held") <= NODE).select("path", "cls", F.lit(0).alias("own"), F.lit(0).alias("i"), F.lit(0).alias("j")))
        large = rows.where(F.col("held") > NODE)
        if large.isEmpty():
            break
        if level == LEVELS - 1:
            blocks = F.ceil(F.col("held") / (NODE * 3 // 8)).cast("int")
            cut = large.withColumn("blocks", blocks).withColumn("own", F.expr("cast(pmod(xxhash64(cls), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            cut = cut.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            found.append(cut.select(F.xxhash64("path", "i", "j").alias("path"), "cls", "own", "i", "j"))
            break
        pick = lambda salt: (F.lit(_FREE) + F.expr(f"cast(pmod(xxhash64(path, {salt}), {COORDINATES - _FREE}) as int)"))
        one = child(F.col("path"), pick(1))
        two = F.array(one, child(F.col("path"), pick(2)))
        chosen = F.when(F.expr("pmod(xxhash64(path, 3), 4) = 0"), two).otherwise(F.array(one))
        rows = large.select("path", "cls").join(classes.select("cls", "sig"), "cls").select("cls", F.explode(chosen).alias("x")).select("cls", "x.path").distinct()
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    return out.join(classes.select("cls", "sig", F.col("n_shingles").alias("n")), "cls").select("path", "cls", "sig", "n", "own", "i", "j")


def _wanted_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, members) for the classes wanted (cls, least_id): the sets of the documents that carry them, read again.

    A bit filter of fixed size over the ids, made by the executors, spares the other documents; the join
    on classes is exact.
    """
    place = lambda c: F.expr(f"pmod(xxhash64({c}), {FILTER_BITS})")
    marks = wanted.select(place("least_id").alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for k, part in marks.collect():  # at most FILTER_BITS / 32768 + 1 rows of 4 kB
        bits[k * 4096 : k * 4096 + len(part)] |= np.frombuffer(part, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).to_numpy(zero_copy_only=False) - 1  # Spark's buckets and positions count from bit 1
            p = p.astype(np.int64)
            told = _bit(shared.value, p)
            for part in slices(iter([batch.filter(pa.array(told))])):
                sets = [s for s in _sets(part.column(1), size) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([_class(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "members"])

    found = docs.select("id", "text", place("id").alias("p")).mapInArrow(run, "cls binary, members binary")
    return found.join(wanted.select("cls"), "cls").dropDuplicates(["cls"])


def _bit(bits: np.ndarray, p: np.ndarray) -> np.ndarray:
    # bitmap_bucket_number(v) is 1 + (v - 1) / 32768 for v > 0 and -v / 32768 else; the position is (v - 1) % 32768 and -v % 32768.
    v = p + 1
    bucket = np.where(v > 0, 1 + (v - 1) // 32768, 0)
    position = np.where(v > 0, (v - 1) % 32768, 0)
    return (bits[bucket * 4096 + position // 8] >> (position % 8).astype(np.uint8)) & 1 > 0


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs.

    Words are runs outside 0x20 and 0x09-0x0D with A-Z folded; a document's set holds its distinct runs
    of ``size`` words, or its whole sequence when shorter. Two documents link when
    100 * |intersection| >= percent * |union|. component_id is the smallest id reachable over links and
    kept says that it is the row's own. A null or empty text, or one of white space, has an empty set
    and links with nothing. A very long text is read whole. Pairs exactly at the threshold are links, and
    so are pairs above it, but for those that all trees miss (see the README). Repeated rows are documents of their own; a null id is never the smallest.
    Other columns of docs play no part.
    """
    docs = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    rows = stored(signatures(docs, size), "signatures")
    classes = stored(rows.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least_id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")), "classes")
    small = _leaves(classes).repartition("path").sortWithinPartitions("path")
    groups = stored(small.mapInArrow(lambda it: candidates(it, percent), "gid binary, cls binary").distinct(), "groups")
    wanted = groups.select("cls").distinct().join(classes.select("cls", "least_id"), "cls")
    sets = _wanted_sets(docs, wanted, size)
    full = groups.join(sets, "cls").select("gid", "cls", "members").repartition("gid").sortWithinPartitions("gid")
    links = stored(full.mapInArrow(lambda it: confirmed(it, percent), "a binary, b binary"), "links")
    roots = components(links).withColumnRenamed("node", "cls")
    named = named_components(classes.select("cls", "least_id"), roots, classes.count())
    out = rows.select("id", "n_shingles", "cls").join(named, "cls", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs, with all its columns, for each component of near_duplicates over rows of their own.

    A row's key is its id and its text's digest, so that rows that share an id, or have none, but not a
    text are documents of their own. Of a component the least key stays, a null id being the last; of
    rows with one id and text, the first in the order of the columns. The keys to drop, and not the
    texts, are what is gathered; rows are moved only if those keys are too many to broadcast.
    """
    text = docs[text_col]
    key = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    found = near_duplicates(docs.select(key.alias("_key"), text.alias("text")), size, percent, "_key", "text")
    found = stored(found.groupBy("_key").agg(F.count("*").alias("rows"), F.max("kept").alias("kept")), "kept")
    keyed = nested(docs, key=key)
    lost = broadcast_if_few(found.where("not kept or rows > 1").select(F.col("_key").alias("lost")))
    once = keyed.join(lost, F.col("key") == F.col("lost"), "left_anti").select("row.*")
    repeated = found.where("kept and rows > 1").select(F.col("_key").alias("lost"))
    if repeated.isEmpty():
        return once
    again = keyed.join(repeated, F.col("key") == F.col("lost"), "left_semi")
    least = again.groupBy("key").agg(F.min_by("row", row_order(docs, text_col)).alias("row"))
    return once.unionByName(least.select("row.*"))
