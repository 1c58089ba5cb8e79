"""A bidirectional LSTM in numpy that labels each block of a page as main text or not.

A block is read as the mean vector of its path's steps, the mean vector of its hashed words and a few
lengths; both directions of the recurrence see the page's whole block sequence.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa

from llm.html_blocks import STEP_BITS, Block, step
from llm.words import PUNCTUATION, Words

_BITS, _PATH, _WORD, _PLAIN, _HIDDEN = 14, 16, 12, 6, 20
_INPUT = _PATH + _WORD + _PLAIN


@lru_cache(20_000)
def _path_ids(steps: int, leaf: str) -> np.ndarray:
    """The hashes of the steps, and the last element also as a leaf."""
    bits = np.unpackbits(np.frombuffer(steps.to_bytes((1 << STEP_BITS) // 8, "little"), np.uint8), bitorder="little")
    return np.append(np.flatnonzero(bits), step("leaf " + leaf))


def encode(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat path ids and their counts by block, flat word ids and theirs, and plain features, of all blocks in order."""
    blocks = [b for page in pages for b in page]
    paths = [_path_ids(b.steps, b.leaf) for b in blocks]
    w = Words(pa.array([b.text for b in blocks], pa.large_string()), PUNCTUATION)
    plain = np.zeros((len(blocks), _PLAIN), np.float32)
    k = 0
    for page in pages:
        for i, b in enumerate(page):
            n = len(b.text)
            plain[k] = (math.log1p(n) / 6, min(1.0, b.link_chars / n), i / len(page), math.log1p(len(page)) / 5, b.text[-1] in ".!?", b.depth / 20)
            k += 1
    word_ids = (w.hashes >> np.uint64(64 - _BITS)).astype(np.int64)
    return np.concatenate(paths) if paths else np.zeros(0, np.int64), np.array([len(p) for p in paths], np.int64), word_ids, np.diff(w.at), plain


def _means(table: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), table.shape[1]), np.float32)
    if len(ids):
        some = np.flatnonzero(counts)
        begins = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        out[some] = np.add.reduceat(table[ids], begins) / counts[some, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """Parameters p: embeddings "path" and "word"; "x0", "h0", "b0" forward and "x1", "h1", "b1" backward; "out", "c"."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        p = {"path": normal(0.5, 1 << STEP_BITS, _PATH), "word": normal(0.1, 1 << _BITS, _WORD), "out": normal(0.2, 2 * _HIDDEN), "c": np.zeros(1, np.float32)}
        for d in "01":
            p |= {f"x{d}": normal(0.2, _INPUT, 4 * _HIDDEN), f"h{d}": normal(0.15, _HIDDEN, 4 * _HIDDEN), f"b{d}": np.zeros(4 * _HIDDEN, np.float32)}
            p[f"b{d}"][_HIDDEN : 2 * _HIDDEN] = 1  # remember at first
        return cls(p)

    def inputs(self, encoded) -> np.ndarray:
        path_ids, path_n, word_ids, word_n, plain = encoded
        return np.concatenate([_means(self.p["path"], path_ids, path_n), _means(self.p["word"], word_ids, word_n), plain], 1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (steps, pages, hidden); direction 1 reads from the end. Steps beyond a page change nothing."""
        steps, pages, _ = x.shape
        gates = x @ self.p[f"x{d}"] + self.p[f"b{d}"]
        h = c = np.zeros((pages, _HIDDEN), np.float32)
        out = np.zeros((steps, pages, _HIDDEN), np.float32)
        for t in range(steps) if d == "0" else reversed(range(steps)):
            z = gates[t] + h @ self.p[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * _HIDDEN : (k + 1) * _HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * _HIDDEN :])
            new = f * c + i * g
            tanh = np.tanh(new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tanh, m))
            h, c = np.where(m, o * tanh, h), np.where(m, new, c)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        both = [self._run(x, mask, d, keep[int(d)] if keep else None) for d in "01"]
        if keep is not None:
            keep[0].append(both)
        return np.concatenate(both, 2) @ self.p["out"] + self.p["c"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log-loss, by parameter, and of the inputs."""
        keep: tuple[list, list] = ([], [])
        z = self.logits(x, mask, keep)
        both = keep[0].pop()
        dz = (_sigmoid(z) - y) * mask / max(1, mask.sum())
        g = {"out": np.einsum("tp,tph->h", dz, np.concatenate(both, 2)), "c": np.array([dz.sum()], np.float32)}
        dx = np.zeros_like(x)
        for d in "01":
            k = int(d)
            dout = dz[:, :, None] * self.p["out"][k * _HIDDEN : (k + 1) * _HIDDEN]
            dh = dc = np.zeros((x.shape[1], _HIDDEN), np.float32)
            gh = np.zeros_like(self.p[f"h{d}"])
            dgates = np.zeros((*x.shape[:2], 4 * _HIDDEN), np.float32)
            for t, h, c, i, f, o, gg, tanh, m in reversed(keep[k]):
                dh = dh + dout[t]
                dnew = np.where(m, dc + dh * o * (1 - tanh**2), 0)
                dhm = np.where(m, dh, 0)
                dzt = np.concatenate([dnew * gg * i * (1 - i), dnew * c * f * (1 - f), dhm * tanh * o * (1 - o), dnew * i * (1 - gg**2)], 1)
                dgates[t] = dzt
                gh += h.T @ dzt
                dh = np.where(m, dzt @ self.p[f"h{d}"].T, dh)
                dc = np.where(m, dnew * f, dc)
            g |= {f"h{d}": gh, f"b{d}": dgates.sum((0, 1)), f"x{d}": np.einsum("tpi,tpg->ig", x, dgates)}
            dx += dgates @ self.p[f"x{d}"].T
        return g, dx

    def predict(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The probability of main text for every block; pages of like length run together, in bounded batches."""
        counts = np.array([len(p) for p in pages], np.int64)
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        if not counts.sum():
            return out
        x = self.inputs(encode(pages))
        begins = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(counts, kind="stable")
        order = order[counts[order] > 0]
        k = 0
        while k < len(order):
            to = k + 1
            while to < len(order) and counts[order[to]] * (to - k + 1) <= 16_384:
                to += 1
            group = order[k:to]
            steps = int(counts[group].max())
            mask = np.arange(steps)[:, None] < counts[group]
            padded = np.zeros((steps, len(group), _INPUT), np.float32)
            for j, page in enumerate(group):
                padded[: counts[page], j] = x[begins[page] : begins[page + 1]]
            p = _sigmoid(self.logits(padded, mask))
            for j, page in enumerate(group):
                out[page] = p[: counts[page], j]
            k = to
        return out


def train(pages: list[list[Block]], labels: list[list[int]], epochs: int = 10, batch: int = 48, rate: float = 0.015, seed: int = 0) -> Labeller:
    """Adam on the blocks' log-loss, at a falling rate. Path steps and words are dropped at random, so that no single one decides."""
    model = Labeller.fresh(seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step, steps_in_all = 0, max(1, epochs * -(-len(pages) // batch))
    for _ in range(epochs):
        order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i]) // 8)
        groups = [order[k : k + batch] for k in range(0, len(order), batch)]
        for group in (groups[i] for i in rng.permutation(len(groups))):
            chosen = [pages[i] for i in group]
            path_ids, path_n, word_ids, word_n, plain = encode(chosen)
            stays = rng.random(len(path_ids)) > 0.05
            owner = np.repeat(np.arange(len(path_n)), path_n)
            path_ids, path_n = path_ids[stays], np.bincount(owner[stays], minlength=len(path_n))
            # All words of a fifth of the blocks go: where the structure is clear it has to do without them.
            owner = np.repeat(np.arange(len(word_n)), word_n)
            stays = (rng.random(len(word_n)) > 0.2)[owner]
            word_ids, word_n = word_ids[stays], np.bincount(owner[stays], minlength=len(word_n))
            encoded = (path_ids, path_n, word_ids, word_n, plain)
            flat = model.inputs(encoded)
            counts = [len(p) for p in chosen]
            steps = max(counts)
            mask = np.arange(steps)[:, None] < np.array(counts)
            x, y = np.zeros((steps, len(group), _INPUT), np.float32), np.zeros((steps, len(group)), np.float32)
            at = np.concatenate([[0], np.cumsum(counts)])
            for j, i in enumerate(group):
                x[: counts[j], j], y[: counts[j], j] = flat[at[j] : at[j + 1]], labels[i]
            g, dx = model.gradients(x, mask, y)
            dflat = np.concatenate([dx[: counts[j], j] for j in range(len(group))])
            for key, ids, n, part in (("path", path_ids, path_n, dflat[:, :_PATH]), ("word", word_ids, word_n, dflat[:, _PATH : _PATH + _WORD])):
                each = np.repeat(part / np.maximum(n, 1)[:, None], n, 0)
                g[key] = np.stack([np.bincount(ids, each[:, k], len(model.p[key])) for k in range(each.shape[1])], 1)
            step += 1
            slower = rate * (1.05 - step / steps_in_all)  # to a twentieth
            for key, v in g.items():
                pace = slower * (0.25 if key == "word" else 1)  # words are many, and most tell nothing
                first[key] += 0.1 * (v - first[key])
                second[key] += 0.01 * (v**2 - second[key])
                model.p[key] -= (pace * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model
