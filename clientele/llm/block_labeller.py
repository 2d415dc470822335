"""A recurrent labeller of a page's leaf blocks (operator 11).

A bidirectional LSTM in numpy reads one vector a leaf, its hashed tag path and
words, and gives each leaf the probability that it belongs to the main text.
Both directions see the whole page, so a block is judged by what surrounds it.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np

from clientele.llm.html_leaves import Leaf

N_PATH, N_WORD, N_PLAIN = 128, 48, 6
WIDTH = N_PATH + N_WORD + N_PLAIN
#: Steps whose inputs are in memory at once, and rows of them.
STEPS, ROWS = 256, 8192

_WORDS = re.compile(r"\w+")


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Signed hash of the path's elements, and of the innermost three with their distance."""
    out = np.zeros(N_PATH, np.float32)
    tags = [t for t in path if not t.startswith(".")]
    named = {*path, *(f"{i}>{t}" for i, t in enumerate(reversed(tags[-3:])))}
    for name in named:
        h = zlib.crc32(name.encode())
        out[h % N_PATH] += 1.0 if h >> 31 else -1.0
        out[(h >> 8) % N_PATH] += 1.0 if (h >> 30) & 1 else -1.0
    return out


class Page:
    """The vectors of one page's leaves, built a stretch at a time."""

    def __init__(self, found: list[Leaf]):
        self.paths = [leaf.path for leaf in found]
        words = [_WORDS.findall(leaf.text.lower()) for leaf in found]
        starts, at = [0], []
        for ws in words:
            at += [zlib.crc32(w.encode()) % N_WORD for w in ws]
            starts.append(len(at))
        self.starts, self.word_at = np.array(starts), np.array(at, np.int16)
        n = len(found)
        chars = np.array([len(leaf.text) for leaf in found], np.float32)
        marks = np.array([sum(map(leaf.text.count, ".,;:!?")) for leaf in found], np.float32)
        linked = np.array([leaf.linked for leaf in found], np.float32)
        self.plain = np.stack(
            [
                np.log1p(chars) / 8, np.log1p(np.diff(self.starts)) / 6, np.minimum(linked / np.maximum(chars, 1), 1),
                np.minimum(10 * marks / np.maximum(chars, 1), 1),
                np.arange(n) / max(1, n - 1), np.full(n, np.log1p(n) / 8),
            ], axis=1,
        ).astype(np.float32)

    def __len__(self) -> int:
        return len(self.paths)

    def vectors(self, a: int, b: int) -> np.ndarray:
        out = np.empty((b - a, WIDTH), np.float32)
        out[:, :N_PATH] = [_path_vector(p) for p in self.paths[a:b]]
        rows = np.repeat(np.arange(b - a), np.diff(self.starts[a : b + 1]))
        flat = rows * N_WORD + self.word_at[self.starts[a] : self.starts[b]]
        counts = np.bincount(flat, minlength=(b - a) * N_WORD).reshape(b - a, N_WORD)
        out[:, N_PATH : N_PATH + N_WORD] = np.log1p(counts) / np.maximum(1.0, np.log1p(counts.sum(axis=1, keepdims=True)))
        out[:, N_PATH + N_WORD :] = self.plain[a:b]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gates(pre: np.ndarray, h: int) -> tuple[np.ndarray, ...]:
    """input, forget, output gate and candidate."""
    s = _sigmoid(pre[:, : 3 * h])
    return s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(pre[:, 3 * h :])


class Labeller:
    """Weights: for each direction input, recurrent and bias; and the last layer over both."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.hidden = weights["f_rec"].shape[0]

    @classmethod
    def fresh(cls, hidden: int, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"{d}_in"] = rng.normal(0, 0.5 / np.sqrt(WIDTH), (WIDTH, 4 * hidden))
            w[f"{d}_rec"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            w[f"{d}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)
        w["out"], w["out_bias"] = rng.normal(0, 1 / np.sqrt(hidden), 2 * hidden), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    # -- labelling -----------------------------------------------------------

    def _states(self, pages: list[Page], back: bool) -> list[np.ndarray]:
        """Each page's hidden states in its own order; ``pages`` is sorted by length, longest first."""
        d, h = "b" if back else "f", self.hidden
        w_in, w_rec, bias = (self.weights[f"{d}_{k}"] for k in ("in", "rec", "bias"))
        out = [np.empty((len(p), h), np.float32) for p in pages]
        lengths = np.array([len(p) for p in pages])
        state, cell = np.zeros((len(pages), h), np.float32), np.zeros((len(pages), h), np.float32)
        stretch = max(1, min(STEPS, ROWS // len(pages)))
        for start in range(0, int(lengths[0]), stretch):
            pre = []
            for p in pages[: int((lengths > start).sum())]:
                stop = min(len(p), start + stretch)
                a, b = (len(p) - stop, len(p) - start) if back else (start, stop)
                x = p.vectors(a, b) @ w_in + bias
                pre.append(x[::-1] if back else x)
            for t in range(start, min(int(lengths[0]), start + stretch)):
                n = int((lengths > t).sum())
                now = np.stack([x[t - start] for x in pre[:n]]) + state[:n] @ w_rec
                i, f, o, g = _gates(now, h)
                cell = f * cell[:n] + i * g
                state = o * np.tanh(cell)
                for k in range(n):
                    out[k][len(pages[k]) - 1 - t if back else t] = state[k]
        return out

    def probabilities(self, pages: list[Page]) -> list[np.ndarray]:
        """For every page the probability of each leaf; pages of like length share the work."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
        for at in range(0, len(order), 128):
            some = order[at : at + 128]
            group = [pages[i] for i in some]
            for i, f, b in zip(some, self._states(group, False), self._states(group, True), strict=True):
                out[i] = _sigmoid(np.concatenate([f, b], axis=1) @ self.weights["out"] + self.weights["out_bias"])
        return out

    # -- training ------------------------------------------------------------

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy and its gradients; x: (page, step, WIDTH), padded behind, mask 0 there."""
        w, (n, steps, _), h = self.weights, x.shape, self.hidden
        seen = np.zeros((n, steps, 2 * h), np.float32)
        kept = {}
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            pre = x @ w[f"{d}_in"] + w[f"{d}_bias"]
            state, cell, trace = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                m = mask[:, t : t + 1]
                i, f, o, g = _gates(pre[:, t] + state @ w[f"{d}_rec"], h)
                fresh = f * cell + i * g
                squashed = np.tanh(fresh)
                trace.append((t, m, i, f, o, g, cell, squashed, state))
                cell, state = m * fresh + (1 - m) * cell, m * (o * squashed) + (1 - m) * state
                seen[:, t, part] = state
            kept[d] = trace
        p = _sigmoid(seen @ w["out"] + w["out_bias"])
        total = mask.sum()
        loss = -(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total
        slope = mask * (p - y) / total
        grads = {"out": (seen * slope[:, :, None]).sum(axis=(0, 1)), "out_bias": slope.sum(keepdims=True).reshape(1)}
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            back = slope[:, :, None] * w["out"][part]
            d_pre = np.zeros((n, steps, 4 * h), np.float32)
            d_rec = np.zeros_like(w[f"{d}_rec"])
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, m, i, f, o, g, before, squashed, state in reversed(kept[d]):
                d_state = d_state + back[:, t]
                inner = m * d_state
                own = m * d_cell + inner * o * (1 - squashed**2)
                step = np.concatenate(
                    [own * g * i * (1 - i), own * before * f * (1 - f), inner * squashed * o * (1 - o), own * i * (1 - g**2)],
                    axis=1,
                )
                d_pre[:, t] = step
                d_rec += state.T @ step
                d_state = (1 - m) * d_state + step @ w[f"{d}_rec"].T
                d_cell = (1 - m) * d_cell + own * f
            flat = d_pre.reshape(-1, 4 * h)
            grads |= {f"{d}_in": x.reshape(-1, x.shape[2]).T @ flat, f"{d}_rec": d_rec, f"{d}_bias": flat.sum(axis=0)}
        return float(loss), grads

    def fit(self, pages: list[Page], labels: list[np.ndarray], epochs: int, seed: int, rate: float = 0.01) -> None:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        step = 0
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                some = batches[k]
                longest = max(len(pages[i]) for i in some)
                x, y = np.zeros((len(some), longest, WIDTH), np.float32), np.zeros((len(some), longest), np.float32)
                mask = np.zeros_like(y)
                for r, i in enumerate(some):
                    n = len(pages[i])
                    x[r, :n], y[r, :n], mask[r, :n] = pages[i].vectors(0, n), labels[i], 1
                _, grads = self.gradients(x, y, mask)
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                step += 1
                for name, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g**2
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = (self.weights[name] - rate * change).astype(np.float32)
