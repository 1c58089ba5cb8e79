"""A log-bilinear language model, trained in numpy by noise-contrastive estimation over all training texts.

The model predicts an output: one of the most frequent words, the end, or the class of any other word
(by its last two bytes). A context vector is the sum of the vectors of the last three outputs, each
through its position's matrix, and of the mean of the last sixteen through another; its products with
all output vectors, normalised, give the output's probability. The words of a class are the leaves of a
binary tree, whose nodes have vectors of their own: the context decides at every node, starting from the
corpus counts, so that a word's cost is the length of its path at any size of the vocabulary. Every word
that is common in the corpus has a leaf and a context vector to itself; the rarest words of a class share
one, and within it have their share by the counts. Every token of any text has a normalised probability.

Counts, and with them the noise distribution, come from all training documents. Every partition trains
on all of its training texts from the same start; the parameters are averaged by tokens.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import slices, stored
from llm.words import Words

WORDS, CLASSES, DIM, LAST, MEAN = 191, 64, 24, 3, 16
#: The leading coordinates of a context that the nodes of the trees read.
STEER = 24
END, OUTPUTS = WORDS, WORDS + 1 + CLASSES
#: The steps by which sums of MEAN rows double.
WIDTHS = [1 << k for k in range(MEAN.bit_length() - 1)]
#: Words that make up at least one in so many tokens have vectors and are broadcast with their counts: as many at most.
COMMON = 1 << 20
SLICE = 512 << 10
_U = np.uint64
#: The end token's key among the words' hashes.
END_KEY = 0x0123456789ABCDEF
_suffix_class = np.random.default_rng(8).integers(0, CLASSES, 65_536).astype(np.int64)
_lower = np.arange(256, dtype=np.int64)
_lower[65:91] += 32


def held_out(id_col, folds: int = 10):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def word_classes(w: Words) -> np.ndarray:
    last = _lower[w.data[w.ends - 1]]
    before = np.where(w.ends - w.starts > 1, _lower[w.data[np.maximum(w.ends - 2, 0)]], 0)
    return _suffix_class[before * 256 + last]


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, class, n): how often each word is in the rows that aren't held out; the end has class -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, ends = 0, 0

        def emit():
            h, c, n = (np.concatenate(x) for x in zip(*held))
            h, at, back = np.unique(h, return_index=True, return_inverse=True)
            return h, c[at], np.bincount(back, n).astype(np.int64)

        for batch in slices(batches):
            batch = batch.filter(pc.invert(batch.column(0)))
            w = Words(batch.column(1))
            ends += len(w) if batch.num_rows else 0
            h, at, n = np.unique(w.hashes, return_index=True, return_counts=True)
            if len(h):
                held.append((h, _classes_at(w, at), n))
                size += len(h)
            if size > 3_000_000:
                merged = emit()
                held, size = [merged], len(merged[0])
                if size > 1_500_000:
                    yield _count_batch(*merged)
                    held, size = [], 0
        if held:
            yield _count_batch(*emit())
        if ends:
            yield _count_batch(np.array([END_KEY], np.uint64), np.array([-1]), np.array([ends]))

    parts = docs.select("held_out", "text").mapInArrow(run, "h long, class int, n long")
    return parts.groupBy("h").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


def _classes_at(w: Words, at: np.ndarray) -> np.ndarray:
    part = object.__new__(Words)
    part.data, part.starts, part.ends = w.data, w.starts[at], w.ends[at]
    return word_classes(part)


def _count_batch(h, c, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(n.astype(np.int64))], ["h", "class", "n"])


@dataclass
class Tree:
    """Binary trees of the classes' words; leaf c is the rest of class c, the others are common words."""

    of_common: np.ndarray  # the leaf of each common word; n for the frequent ones, which are outputs
    n: int  # leaves
    begins: np.ndarray  # of each leaf's path (n+1 entries)
    nodes: np.ndarray
    left: np.ndarray  # 1 where the path goes left
    bias: np.ndarray  # of each node: the log of left to right by the counts
    log_rest: np.ndarray  # log10 of the smoothed counts of each class's rest
    rank: np.ndarray  # of each leaf from right to left, as the nodes are numbered: the leaves below a node are neighbours


def tree(of_common: np.ndarray, classes: np.ndarray, counts: np.ndarray, rest: np.ndarray) -> Tree:
    """The trees for words of these classes and counts; rest: smoothed counts of the other words of each class."""
    n = CLASSES + len(classes)
    leaf_class, weight = np.concatenate([np.arange(CLASSES), classes]), np.concatenate([rest, counts + 0.1])
    order = np.lexsort((-weight, leaf_class))
    bounds = np.searchsorted(leaf_class[order], np.arange(CLASSES + 1)).tolist()
    total = np.concatenate([[0.0], np.cumsum(weight[order])]).tolist()
    up, left = np.full(n, -1), np.zeros(n, np.int8)
    node_up, node_left, bias = [], [], []
    stack = [(a, b, -1, 0) for a, b in zip(bounds[:-1], bounds[1:])]
    while stack:
        a, b, parent, side = stack.pop()
        if b - a == 1:
            up[order[a]], left[order[a]] = parent, side
            continue
        half = (total[a] + total[b]) / 2
        m = bisect_left(total, half, a + 1, b - 1)
        m -= m > a + 1 and half - total[m - 1] < total[m] - half
        stack += [(a, m, len(bias), 1), (m, b, len(bias), 0)]
        node_up.append(parent)
        node_left.append(side)
        bias.append(np.log((total[m] - total[a]) / (total[b] - total[m])))
    node_up, node_left = np.array(node_up, np.int64), np.array(node_left, np.int8)
    leaves, nodes, sides = [], [], []
    at = np.flatnonzero(up >= 0)
    node, side = up[at], left[at]
    while len(at):
        leaves.append(at)
        nodes.append(node)
        sides.append(side)
        on = node_up[node] >= 0
        at, node, side = at[on], node_up[node[on]], node_left[node[on]]
    cat = lambda x, kind: np.concatenate([np.zeros(0, kind), *x]).astype(kind)
    leaves = cat(leaves, np.int64)
    by_leaf = np.argsort(leaves, kind="stable")
    begins = np.concatenate([[0], np.cumsum(np.bincount(leaves, minlength=n))])
    return Tree(of_common, n, begins, cat(nodes, np.int32)[by_leaf], cat(sides, np.int8)[by_leaf], np.array(bias, np.float64), np.log10(rest), n - 1 - np.argsort(order))


@dataclass
class Vocabulary:
    """What is broadcast of the counts: sizes bounded by WORDS, CLASSES and COMMON."""

    words: np.ndarray  # sorted hashes of the frequent words
    outputs: np.ndarray  # the output of each
    common: np.ndarray  # sorted hashes of common words
    common_counts: np.ndarray
    tokens: int  # N
    distinct: int  # V
    output_counts: np.ndarray  # tokens of every output
    class_distinct: np.ndarray  # words of every class outside the frequent ones
    tree: Tree | None = None

    def __post_init__(self):
        self.output_of_common = np.full(len(self.common), -1)  # frequent words are common, too
        self.output_of_common[np.searchsorted(self.common, self.words)] = self.outputs
        if self.tree is None:  # no word but the frequent ones has a vector to itself
            none = np.zeros(0, np.int64)
            self.tree = tree(np.full(len(self.common), CLASSES), none, none, self.output_counts[END + 1 :] + 0.1 * (self.class_distinct + 1))

    @property
    def noise(self) -> np.ndarray:
        return (self.output_counts + 0.5) / (self.output_counts + 0.5).sum()


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    n, v = total[0] or 0, total[1]
    words = counts.where("class >= 0")
    top = words.orderBy(F.desc("n"), "h").limit(WORDS).toArrow()
    # At most COMMON rows, as their counts add up to n at most, and the frequent words, whatever their counts.
    common = counts.where((F.col("class") >= 0) & ((F.col("n") * COMMON >= n) | F.col("h").isin(top["h"].to_pylist()))).toArrow()
    by_class = {r["class"]: (r.n, r.v) for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    output_counts, distinct = np.zeros(OUTPUTS, np.int64), np.zeros(CLASSES, np.int64)
    for c in range(CLASSES):
        output_counts[END + 1 + c], distinct[c] = by_class.get(c, (0, 0))
    output_counts[END] = by_class.get(-1, (0, 0))[0]
    for k, (c, m) in enumerate(zip(top["class"].to_pylist(), top["n"].to_pylist())):
        output_counts[k] = m
        output_counts[END + 1 + c] -= m
        distinct[c] -= 1
    h = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    ch, cn = common["h"].to_numpy().view(np.uint64), common["n"].to_numpy()
    corder = np.argsort(ch)
    ch, cn, cc = ch[corder], cn[corder], common["class"].to_numpy()[corder]
    own = ~np.isin(ch, h)
    of_common = np.where(own, CLASSES + np.cumsum(own) - 1, CLASSES + own.sum())
    rest = output_counts[END + 1 :] - np.bincount(cc[own], cn[own], CLASSES) + 0.1 * (distinct - np.bincount(cc[own], minlength=CLASSES) + 1)
    return Vocabulary(h[order], order, ch, cn, n, v, output_counts, distinct, tree(of_common, cc[own], cn[own], rest))


_filters: dict[int, tuple[np.ndarray, np.ndarray, np.uint64]] = {}


def _filter(keys: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Where the sorted keys with the same leading bits begin (and one entry more), made once for an array that stays."""
    held = _filters.get(id(keys))
    if held is None or held[0] is not keys:
        width = min(22, max(12, int(len(keys)).bit_length() + 1))
        shift = _U(64 - width)
        begins = np.zeros((1 << width) + 1, np.int32)
        np.cumsum(np.bincount((keys >> shift).view(np.int64), minlength=1 << width), out=begins[1:])
        if len(_filters) > 8:
            _filters.clear()
        held = _filters[id(keys)] = (keys, begins, shift)
    return held[1], held[2]


def find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of h is among the sorted keys, and its place there."""
    found, at = np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    if not len(keys):
        return found, at
    begins, shift = _filter(keys)
    lead = (h >> shift).view(np.int64)
    place, end = begins.take(lead), begins.take(lead + 1)
    rows = np.flatnonzero(place < end)
    place, end, h = place[rows], end[rows], h[rows]
    while len(rows):  # once for every key of the fullest lead
        ok = keys.take(place) == h
        found[rows[ok]] = True
        at[rows[ok]] = place[ok]
        more = np.flatnonzero(~ok & (place + 1 < end))
        rows, place, end, h = rows[more], place[more] + 1, end[more], h[more]
    return found, at


@dataclass
class Tokens:
    """Outputs of all tokens of a batch, each text followed by its end; the place of each token in its text; and the words' places."""

    outputs: np.ndarray
    places: np.ndarray
    bounds: np.ndarray
    of_word: np.ndarray
    classes: np.ndarray  # by word; -1 for the frequent ones
    leaves: np.ndarray  # by token; the tree's n for the frequent words and ends
    common: np.ndarray  # by word: whether it is among the common words, and its place there
    at: np.ndarray
    tree: Tree


def tokens(w: Words, v: Vocabulary) -> Tokens:
    counts = np.diff(w.at)
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    of_word = np.arange(len(w.starts)) + np.repeat(np.arange(len(counts)), counts)
    classes = word_classes(w)
    places = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts + 1)
    common, place = find(v.common, w.hashes)
    if len(v.common):
        output = np.where(common, v.output_of_common.take(place), -1)
        leaf = np.where(common, v.tree.of_common.take(place), classes)
    else:
        output, leaf = np.full(len(classes), -1), classes
    frequent = output >= 0
    outputs = np.full(bounds[-1], END, np.int64)
    outputs[of_word] = np.where(frequent, output, END + 1 + classes)
    leaves = np.full(bounds[-1], v.tree.n, np.int64)
    leaves[of_word] = leaf
    return Tokens(outputs, places, bounds, of_word, np.where(frequent, -1, classes), leaves, common, place, v.tree)


def fresh(v: Vocabulary, seed: int = 0) -> dict[str, np.ndarray]:
    """The start of training: the unigram distribution."""
    rng = np.random.default_rng(seed)
    p = {"q": rng.normal(0, 0.3, (OUTPUTS + 1, DIM)), "t": rng.normal(0, 0.3, (OUTPUTS, DIM)), "b": np.log(v.noise)}
    p["c"] = rng.normal(0, 0.02, (LAST + 1, DIM, DIM))
    p["e"] = np.zeros((v.tree.n + 1, DIM))  # what a leaf's word adds to its class as context; nothing in the last row
    p["u"] = np.zeros((len(v.tree.bias), STEER + 1))  # the nodes' vectors and biases
    p["u"][:, STEER] = v.tree.bias
    return {k: x.astype(np.float32) for k, x in p.items()}


class Context:
    """The context vectors of tokens low:high of a batch, and what their gradients need.

    All tokens look back equally far, so that whole slices are moved; the few whose text has just begun
    are then put right.
    """

    def __init__(self, p: dict, t: Tokens, low: int, high: int):
        base = max(low - MEAN, 0)
        self.place, self.m = t.places[low:high], high - low
        self.run, self.leaves = t.outputs[base:high], t.leaves[base:high]
        # MEAN rows of what stands before a text, and the vectors of the tokens.
        self.x = np.empty((MEAN + high - base, DIM), p["q"].dtype)
        self.x[:MEAN] = p["q"][OUTPUTS]
        np.add(p["q"].take(self.run, 0), p["e"].take(self.leaves, 0), out=self.x[MEAN:])
        self.off = MEAN + low - base  # the first token's row
        self.short = np.flatnonzero(self.place < MEAN)
        self.divisor = np.maximum(self.place[self.short], 1).astype(self.x.dtype)[:, None]
        begun = t.places[base:high]
        some = np.flatnonzero(begun < MEAN)
        self.begun, self.rows = begun[some], MEAN + some  # the rows of tokens whose text has just begun
        # Sums of what stands before every row in its text: of one, then of twice as many at a time.
        sums = np.zeros_like(self.x)
        sums[1:] = self.x[:-1]
        sums[self.rows[self.begun == 0]] = 0
        for width in WIDTHS:
            few = self.rows[self.begun < width]  # have them all
            more = sums.copy()
            more[width:] += sums[:-width]
            more[few] = sums[few]
            sums = more
        # What the matrices read, side by side: the last tokens, or what stands before a text, and the mean.
        self.fresh = [np.flatnonzero(self.place <= k) for k in range(LAST)]
        self.read = np.empty((self.m, LAST + 1, DIM), self.x.dtype)
        for k in range(LAST):
            self.read[:, k] = self.x[self._slice(k)]
            self.read[self.fresh[k], k] = p["q"][OUTPUTS]
        np.multiply(sums[self.off : self.off + self.m], self.x.dtype.type(1 / MEAN), out=self.read[:, LAST])
        self.read[self.short, LAST] = sums[self.off + self.short] / self.divisor
        self.read = self.read.reshape(self.m, -1)
        self.h = self.read @ p["c"].reshape(-1, DIM)

    def _slice(self, k: int) -> slice:
        return slice(self.off - 1 - k, self.off - 1 - k + self.m)

    def gradients(self, p: dict, dh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of q and c; those of the tokens' vectors are left in dx."""
        start = np.zeros(DIM, self.x.dtype)
        d = (dh @ p["c"].reshape(-1, DIM).T).reshape(self.m, LAST + 1, DIM)
        # Every row gets what those after it in its text pass to their means: of one, then of twice as many at a time.
        dx = np.zeros_like(self.x)
        each = dx[self.off - 1 : self.off - 1 + self.m]
        np.multiply(d[:, LAST], self.x.dtype.type(1 / MEAN), out=each)
        each[self.short] = d[self.short, LAST] / self.divisor
        dx[self.rows[self.begun == 0] - 1] = 0
        for width in WIDTHS:
            few = self.rows[self.begun < width] - width
            more = dx.copy()
            more[:-width] += dx[width:]
            more[few] = dx[few]
            dx = more
        for k in range(LAST):
            few = self.fresh[k]
            start += d[few, k].sum(0)
            d[few, k] = 0
            dx[self._slice(k)] += d[:, k]
        self.dx = dx[MEAN:]
        out = scatter(self.run, self.dx, OUTPUTS + 1)
        out[OUTPUTS] = start
        return out, np.ascontiguousarray((dh.T @ self.read).T).reshape(p["c"].shape)


def scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of values by row number."""
    if n > 1 << 15:
        return np.stack([np.bincount(rows, values[:, k], n) for k in range(values.shape[1])], 1)
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(rows):
        order = np.argsort(rows.astype(np.int16), kind="stable")  # short keys are sorted in linear time
        told = rows[order]
        begins = np.flatnonzero(np.diff(told, prepend=-1))
        out[told[begins]] = np.add.reduceat(values.take(order, 0), begins)
    return out


#: Tokens whose paths are worked on as one matrix.
TILE = 32


@dataclass
class Paths:
    """The paths of some tokens, in the order of their leaves.

    Neighbours share most of their nodes. So TILE tokens at a time meet all nodes of theirs in a matrix,
    although each of them has only some on its path: a small product takes less time than gathering
    vectors for every step.
    """

    tokens: np.ndarray
    lengths: np.ndarray  # steps of each
    cells: np.ndarray  # of every step: its place in the matrices, one after another
    left: np.ndarray
    z: np.ndarray  # and score
    bounds: list[int]  # where the nodes of every tile begin
    nodes: np.ndarray
    repeated: np.ndarray  # whether an earlier tile has the node, too
    times: np.ndarray  # how many steps it has in the tile
    h: np.ndarray  # what the nodes read, by token
    u: np.ndarray  # the nodes' vectors

    @property
    def rows(self) -> np.ndarray:
        """The token of every step."""
        return np.repeat(self.tokens, self.lengths)

    def gradients(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From those of the steps' scores: of what each token reads; the distinct nodes, of their vectors, and how many steps they have."""
        cells = np.zeros(TILE * len(self.u), self.u.dtype)
        cells[self.cells] = d
        dh, du = np.empty_like(self.h), np.empty_like(self.u)
        for k, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            tile, at = cells[TILE * a : TILE * b].reshape(TILE, b - a), slice(k * TILE, (k + 1) * TILE)
            np.matmul(tile, self.u[a:b], out=dh[at])
            np.matmul(tile.T, self.h[at], out=du[a:b])
        first, again = np.flatnonzero(~self.repeated), np.flatnonzero(self.repeated)
        nodes, du_first, times = self.nodes[first], du.take(first, 0), self.times[first]  # nodes in order, as leaves are
        if len(again):
            at, more, n = row_sums(np.searchsorted(nodes, self.nodes[again]), du.take(again, 0))
            du_first[at] += more
            np.add.at(times, np.searchsorted(nodes, self.nodes[again]), self.times[again])
        return dh[: len(self.tokens)], nodes, du_first, times


def paths(p: dict, t: Tokens, low: int, h: np.ndarray) -> Paths:
    leaves = t.leaves[low : low + len(h)]
    tokens = np.flatnonzero(leaves < t.tree.n)
    tokens = tokens[np.sort(t.tree.rank[leaves[tokens]] << 32 | np.arange(len(tokens))) & 0xFFFFFFFF]
    ends = t.tree.begins[leaves[tokens] + 1]
    lengths = ends - t.tree.begins[leaves[tokens]]
    depth = np.arange(lengths.max(initial=0))
    on = depth < lengths[:, None]
    flat = (ends[:, None] - 1 - depth)[on]  # from the root down
    node = np.full(on.shape, -1, np.int32)
    node[on] = t.tree.nodes[flat]
    new = on.copy()  # the first of its tile with the node
    new[1:] &= node[1:] != node[:-1]
    repeated = ~new & on
    new[::TILE] = on[::TILE]
    repeated = repeated[new]
    number = np.cumsum(new, dtype=np.int32).reshape(on.shape)
    number *= new
    number = np.maximum.accumulate(number, 0)[on] - 1
    nodes, tiles = node[new], -(-len(tokens) // TILE)
    bounds = np.zeros(tiles + 1, np.int64)
    if tiles:
        np.cumsum(np.add.reduceat(new.sum(1), np.arange(0, len(tokens), TILE)), out=bounds[1:])
    u, read = p["u"].take(nodes, 0), np.zeros((tiles * TILE, STEER + 1), p["u"].dtype)
    read[: len(tokens), :STEER] = h.take(tokens, 0)[:, :STEER]
    read[:, STEER] = 1
    row = np.arange(len(tokens))
    tile = row // TILE
    # Of a tile whose nodes begin at a and end at b, the matrix begins at TILE * a and has b - a columns.
    cells = number + np.repeat((TILE - 1) * bounds[tile] + row % TILE * np.diff(bounds)[tile], lengths)
    told, bounds = np.empty(TILE * len(nodes), u.dtype), bounds.tolist()
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        np.matmul(read[k * TILE : (k + 1) * TILE], u[a:b].T, out=told[TILE * a : TILE * b].reshape(TILE, b - a))
    return Paths(tokens, lengths, cells, t.tree.left[flat], told[cells], bounds, nodes, repeated, np.bincount(number, minlength=len(nodes)), read, u)


#: Up to so many rows are added one by one.
FEW = 3


def row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct row numbers, the sums of their rows of values, and how many they are.

    Most numbers have few rows: those are added all at once, first to first.
    """
    packed = np.sort(rows.astype(np.int64) << 32 | np.arange(len(rows)))  # sorting values is faster than sorting places
    order, told = packed & 0xFFFFFFFF, packed >> 32
    new = np.ones(len(told), bool)
    new[1:] = told[1:] != told[:-1]
    begins = np.flatnonzero(new)
    n = np.diff(begins, append=len(told))
    out = values.take(order[begins], 0)
    for k in range(1, FEW):
        more = np.flatnonzero((n > k) & (n <= FEW))
        out[more] += values.take(order[begins[more] + k], 0)
    many = np.flatnonzero(n > FEW)
    if len(many):
        out[many] = np.add.reduceat(values.take(order[np.repeat(n > FEW, n)], 0), np.cumsum(n[many]) - n[many])
    return told[begins], out, n


def nudge(p: dict, squares: dict, seen: dict, key: str, rows: np.ndarray, g: np.ndarray, times: np.ndarray, rate: float) -> None:
    """An Adagrad step of some distinct rows of a parameter, with their gradients and mentions; a row has one square."""
    square = squares[key].take(rows) + np.einsum("ij,ij->i", g, g) / g.shape[1]
    squares[key][rows] = square
    g *= (rate / np.sqrt(square)).astype(np.float32)[:, None]
    p[key][rows] = np.subtract(p[key].take(rows, 0), g, out=g)
    seen[key][rows] += times


#: Tokens whose scores are worked on at once.
ROOM = 1024


def train_step(p: dict, squares: dict, seen: dict, t: Tokens, low: int, high: int, noise: np.ndarray, log_noise: np.ndarray, rate: float) -> None:
    """One Adagrad step of NCE: the batch's tokens against noise samples that all of them share; the paths by their logistic loss."""
    y = t.outputs[low:high]
    c = Context(p, t, low, high)
    shift = (p["b"] - np.log(len(noise)) - log_noise).astype(np.float32)
    vectors = np.concatenate([p["t"], shift[:, None]], 1)  # the shift as one more coordinate
    h = np.ones((len(y), DIM + 1), np.float32)
    h[:, :DIM] = c.h
    own, others = vectors.take(y, 0), vectors[noise]
    with np.errstate(over="ignore"):  # 0 where the exponential overflows
        d_true = -1 / (1 + np.exp(np.einsum("ij,ij->i", h, own)))
        dh = np.multiply(own[:, :DIM], d_true[:, None])
        d_noise = np.zeros_like(others)
        for a in range(0, len(y), ROOM):  # blocks that stay in the cache
            false = h[a : a + ROOM] @ -others.T
            # The logistic function of the noise scores, in place.
            np.exp(false, out=false)
            false += 1
            np.reciprocal(false, out=false)
            dh[a : a + ROOM] += false @ others[:, :DIM]
            d_noise += false.T @ h[a : a + ROOM]
        way = paths(p, t, low, c.h)
        d = (1 / (1 + np.exp(-way.z)) - way.left).astype(np.float32)
    if len(d):
        told, *made = way.gradients(d)
        back = np.zeros((len(y), STEER + 1), np.float32)
        back[way.tokens] = told
        dh[:, :STEER] += back[:, :STEER]
        nudge(p, squares, seen, "u", *made, rate)
    dq, dc = c.gradients(p, dh)
    h *= d_true[:, None]
    dt = scatter(y, h, OUTPUTS) + scatter(noise, d_noise, OUTPUTS)
    dt, db = dt[:, :DIM], dt[:, DIM]
    for k, g in (("q", dq), ("c", dc), ("t", dt), ("b", db)):
        g = g / len(y)
        squares[k] += g * g
        p[k] -= (rate * g / np.sqrt(squares[k])).astype(np.float32)
    told = np.flatnonzero(c.leaves < t.tree.n)
    if len(told):
        nudge(p, squares, seen, "e", *row_sums(c.leaves[told], c.dx.take(told, 0)), rate)


def _packed(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, weighted sums, weights) with one row for each key."""
    k, x, n = (np.concatenate(part) for part in zip(*held))
    k, back = np.unique(k, return_inverse=True)
    return k, scatter(back, x, len(k)), np.bincount(back, n, len(k)).astype(np.int64)


DENSE, ROWS = ("b", "c", "q", "t"), ("e", "u")


def train(docs: DataFrame, v: Vocabulary, batch: int = 4096, samples: int = 64, rate: float = 0.08) -> dict[str, np.ndarray]:
    """One pass over all rows that aren't held out; each partition's parameters count by its tokens, rows of words and nodes by their mentions."""
    shared = docs.sparkSession.sparkContext.broadcast(v)
    width, p = DIM + 1, fresh(v)
    size = sum(p[k].size for k in DENSE)
    begins = np.cumsum([-(-size // width), *(len(p[k]) for k in ROWS)])

    def emitted(k: np.ndarray, x: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(k), 8192):
            part = x[a : a + 8192].astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * width), pa.array(part.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(k[a : a + 8192].astype(np.int32)), lists, pa.array(n[a : a + 8192].astype(np.int64))], ["k", "x", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        p = fresh(v)
        squares = {k: np.full(p[k].shape, 1e-6) for k in DENSE} | {k: np.ones(len(p[k])) for k in ROWS}
        mentions = {k: np.zeros(len(p[k]), np.int64) for k in ROWS}
        rng = np.random.default_rng(1)
        steps, log_noise, seen = np.cumsum(v.noise), np.log(v.noise), 0
        for part in slices(batches, limit=SLICE):
            part = part.filter(pc.invert(part.column(0)))
            if not part.num_rows:
                continue
            t = tokens(Words(part.column(1)), v)
            n = len(t.outputs)
            for low in range(0, n, batch):
                noise = np.minimum(np.searchsorted(steps, rng.random(samples)), OUTPUTS - 1)
                train_step(p, squares, mentions, t, low, min(low + batch, n), noise, log_noise, rate)
            seen += n
        if seen:
            flat = np.zeros(begins[0] * width, np.float32)
            flat[:size] = np.concatenate([p[k].ravel() for k in DENSE])
            yield from emitted(np.arange(begins[0]), flat.reshape(-1, width), np.full(begins[0], seen))
            for key, base in zip(ROWS, begins):
                told = np.flatnonzero(mentions[key])
                x = np.zeros((len(told), width), np.float32)
                x[:, : p[key].shape[1]] = p[key][told]
                yield from emitted(base + told, x, mentions[key][told])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The keys that this task has, and no others: packed whenever as much again has come.
        held, size, packed = [], 0, 0
        for b in batches:
            n = b.column(2).to_numpy()
            held.append((b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(-1, width) * n[:, None].astype(np.float64), n))
            size += len(n)
            if size > 2 * packed + 65_536:
                held = [_packed(held)]
                size = packed = len(held[0][0])
        if held:
            k, x, n = _packed(held)
            yield from emitted(k, x / n[:, None], n)

    schema = "k int, x array<float>, n long"
    averaged = docs.select("held_out", "text").mapInArrow(run, schema).repartition("k").mapInArrow(mean, schema).toArrow()  # one row for each vector
    if averaged.num_rows:
        k, x = averaged["k"].to_numpy(), averaged["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        flat = np.zeros((begins[0], width), np.float32)
        flat[k[k < begins[0]]] = x[k < begins[0]]
        flat, at = flat.ravel(), 0
        for key in DENSE:
            p[key] = flat[at : at + p[key].size].reshape(p[key].shape)
            at += p[key].size
        for key, base in zip(ROWS, begins):
            mine = (k >= base) & (k < base + len(p[key]))
            p[key][k[mine] - base] = x[mine, : p[key].shape[1]]
    return p


def steps(p: dict, t: Tokens, low: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token, side and score of every step of the paths, where nothing is learned; h ends in ones."""
    leaves = t.leaves[low : low + len(h)]
    rows = np.flatnonzero(leaves < t.tree.n)
    begins = t.tree.begins[leaves[rows]]
    n = t.tree.begins[leaves[rows] + 1] - begins
    flat = np.arange(n.sum()) + np.repeat(begins - np.cumsum(n) + n, n)
    rows = np.repeat(rows, n)
    read = h if STEER == DIM else np.concatenate([h[:, :STEER], h[:, DIM:]], 1)
    return rows, t.tree.left[flat], np.einsum("ij,ij->i", read.take(rows, 0), p["u"].take(t.tree.nodes[flat], 0))


def log_probabilities(p: dict, t: Tokens, batch: int = 4096) -> np.ndarray:
    """The natural log-probability of every token's output and leaf, normalised over all outputs and their leaves."""
    out = np.zeros(len(t.outputs))
    vectors = np.concatenate([p["t"], p["b"][:, None]], 1)  # the bias as one more coordinate
    longest, flat = np.sqrt((vectors * vectors).sum(1).max()), np.ones(OUTPUTS, p["t"].dtype)
    room = np.empty((ROOM // 4, OUTPUTS), p["t"].dtype)  # one matrix for all blocks, which stays in the cache
    for low in range(0, len(out), batch):
        high = min(low + batch, len(out))
        h, some = np.ones((high - low, DIM + 1), p["t"].dtype), out[low:high]
        h[:, :DIM] = Context(p, t, low, high).h
        large = np.sqrt(np.einsum("ij,ij->i", h, h).max()) * longest > 80  # beyond what single precision surely exponentiates
        for a in range(0, len(h), len(room)):
            part = h[a : a + len(room)]
            z, top = np.matmul(part, vectors.T, out=room[: len(part)]), 0.0
            own = z[np.arange(len(part)), t.outputs[low + a : low + a + len(part)]]
            if large:
                top = z.max(1)
                z -= top[:, None]
            some[a : a + len(room)] = own - top - np.log(np.exp(z, out=z) @ flat)
        rows, left, s = steps(p, t, low, h)
        np.negative(s, out=s, where=left > 0)
        # log(1 + exp(s)), without overflow
        some -= np.bincount(rows, np.maximum(s, 0) + np.log(1 + np.exp(-np.abs(s))), len(h))
    return out


def score_documents(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    Tokens are the text's words (runs outside 0x20 and 0x09-0x0D, A-Z folded) and one end. base_score
    is the smoothed unigram log10-probability and score the model's; a token is known when training
    rows hold it. Null and empty texts are an end alone; very long ones are read whole, a slice at a time. A row is held out when crc32 of its id as text
    leaves 0 (a null id never is). Equal rows count as rows of their own; other columns play no part.
    Without training rows, the model is uniform over what it can output.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(docs[id_col].alias("id"), held_out(docs[id_col], folds).alias("held_out"), docs[text_col].alias("text"))
    counts = stored(word_counts(rows), "counts")
    v = vocabulary(counts)
    shared = docs.sparkSession.sparkContext.broadcast((v, train(rows, v)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p = shared.value
        log_all = np.log10(v.tokens + 0.1 * (v.distinct + 1))
        ends = v.output_counts[END]
        for part in slices(batches, text=2, limit=SLICE):
            w = Words(part.column(2))
            t = tokens(w, v)
            n = np.diff(t.bounds)
            common, at = t.common, t.at
            logs = np.zeros(len(w.hashes))
            logs[common] = np.log10(v.common_counts[at[common]] + 0.1)
            shares = (t.classes >= 0) & ~common
            by_word = np.where(shares, -v.tree.log_rest[t.classes], 0)  # of a class's rest; any other word has its output or leaf to itself
            add = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[w.at])
            base = add(logs) + np.log10(ends + 0.1) - n * log_all
            model = np.diff(np.concatenate([[0.0], np.cumsum(log_probabilities(p, t))])[t.bounds]) / np.log(10) + add(by_word)
            # Words that aren't common: their counts come by a join.
            rare = np.flatnonzero(~common)
            doc = np.searchsorted(w.at, rare, "right") - 1
            order = np.lexsort((w.hashes[rare], doc))
            doc, h = doc[order], w.hashes[rare[order]]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(h)))
            lists = np.searchsorted(doc[first], np.arange(part.num_rows + 1)).astype(np.int32)
            known = add(common) + (ends > 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n), pa.array(known.astype(np.int64)), pa.array(base), pa.array(model), pa.ListArray.from_arrays(pa.array(lists), pa.array(h[first].view(np.int64))), pa.ListArray.from_arrays(pa.array(lists), pa.array(times.astype(np.int32)))],
                ["id", "held_out", "n_tokens", "known", "base", "model", "rare", "times"],
            )

    schema = f"id {kind}, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>, times array<int>"
    scored = stored(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    told = rare.join(counts.where(F.col("n") * COMMON < v.tokens).select("h", "n"), "h", "left")  # the documents' own words only
    sums = told.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("logs"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"))
    out = scored.drop("rare", "times").join(sums, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("model") + logs).alias("score"))
