"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

EMBEDDED = 12
HIDDEN = 16
PAD, OTHER = 0, 1
# Code points 0 to 255 have codes of their own, all others share one.
CODES = 258


def codes_of(points: np.ndarray) -> np.ndarray:
    return np.where(points < 256, points.astype(np.int64) + 2, OTHER).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Tags 0 (none) and, for kind k from 0, 2k + 1 (first character) and 2k + 2 (further ones)."""

    def __init__(self, kinds: int, seed: int = 0):
        random = np.random.default_rng(seed)
        tags = 2 * kinds + 1
        normal = lambda *shape: (random.normal(size=shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)
        self.p = {"embedding": random.normal(size=(CODES, EMBEDDED)).astype(np.float32), "out": normal(2 * HIDDEN, tags)}
        self.p |= {"bias": np.zeros(tags, np.float32), "turn": np.zeros((tags, tags), np.float32), "start": np.zeros(tags, np.float32)}
        for side in "lr":
            self.p |= {f"x{side}": normal(EMBEDDED, 4 * HIDDEN), f"h{side}": normal(HIDDEN, 4 * HIDDEN)}
            self.p[f"b{side}"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1
        # A further character follows only a character of its kind.
        self.allowed = np.ones((tags, tags), bool)
        for k in range(kinds):
            self.allowed[:, 2 * k + 2] = False
            self.allowed[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True

    def _run(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction over x[time, window, gates]; what the gradient needs of each step."""
        n = x.shape[1]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.empty((len(x), n, HIDDEN), np.float32), []
        for t in range(len(x)) if side == "l" else range(len(x) - 1, -1, -1):
            z = x[t] + h @ self.p[f"h{side}"]
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before = c
            c = f * c + i * new
            wide = np.tanh(c)
            kept.append((t, h, before, i, f, o, new, wide))
            h = o * wide
            out[t] = h
        return out, kept

    def emissions(self, codes: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores[time, window, tag] of codes[window, time]."""
        time_major = np.ascontiguousarray(codes.T)
        sides, kept = [], {}
        for side in "lr":
            table = self.p["embedding"] @ self.p[f"x{side}"] + self.p[f"b{side}"]
            states, kept[side] = self._run(table[time_major], side)
            sides.append(states)
        both = np.concatenate(sides, axis=2)
        return both @ self.p["out"] + self.p["bias"], {"both": both, "kept": kept, "codes": time_major}

    def _weights(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        local = np.exp(scores - scores.max(axis=2, keepdims=True))
        return local, np.where(self.allowed, np.exp(self.p["turn"]), 0).astype(np.float32), np.exp(self.p["start"])

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability[time, window, tag], and the sum over windows of that of each two neighbouring tags[time, tag, tag]."""
        local, turn, start = self._weights(scores)
        forward, backward = np.empty_like(local), np.empty_like(local)
        forward[0] = local[0] * start
        forward[0] /= forward[0].sum(1, keepdims=True)
        for t in range(1, len(local)):
            forward[t] = (forward[t - 1] @ turn) * local[t]
            forward[t] /= forward[t].sum(1, keepdims=True)
        backward[-1] = 1
        pairs = np.zeros((len(local), *turn.shape), np.float32)
        for t in range(len(local) - 1, 0, -1):
            ahead = local[t] * backward[t]
            backward[t - 1] = ahead @ turn.T
            weight = 1 / np.maximum((forward[t - 1] * backward[t - 1]).sum(1, keepdims=True), 1e-30)
            pairs[t] = ((forward[t - 1] * weight).T @ ahead) * turn
            backward[t - 1] /= backward[t - 1].sum(1, keepdims=True)
        both = forward * backward
        return both / both.sum(2, keepdims=True), pairs

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest tags[window, time], and the marginal probability of each."""
        scores, _ = self.emissions(codes)
        turn = np.where(self.allowed, self.p["turn"], -1e4).astype(np.float32)
        best = scores[0] + self.p["start"]
        came = np.zeros(scores.shape, np.int8)
        for t in range(1, len(scores)):
            ways = best[:, :, None] + turn
            came[t] = ways.argmax(1)
            best = ways.max(1) + scores[t]
        tags = np.zeros(codes.shape, np.int8)
        at, rows = best.argmax(1), np.arange(len(codes))
        for t in range(len(scores) - 1, -1, -1):
            tags[:, t] = at
            at = came[t, rows, at]
        sure = self.marginals(scores)[0].transpose(1, 0, 2)
        return tags, np.take_along_axis(sure, tags[:, :, None].astype(np.int64), 2)[:, :, 0]

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log-likelihood of the given tags[window, time]."""
        scores, seen = self.emissions(codes)
        sure, pairs = self.marginals(scores)
        t_len, n, _ = scores.shape
        gold = np.eye(scores.shape[2], dtype=np.float32)[tags.T]
        d_scores = (gold - sure) / n
        g = {"bias": d_scores.sum((0, 1)), "start": d_scores[0].sum(0)}
        followed = np.zeros_like(self.p["turn"])
        np.add.at(followed, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        g["turn"] = np.where(self.allowed, followed - pairs.sum(0), 0) / n
        flat = d_scores.reshape(t_len * n, -1)
        g["out"] = seen["both"].reshape(t_len * n, -1).T @ flat
        d_both = d_scores @ self.p["out"].T
        g["embedding"] = np.zeros_like(self.p["embedding"])
        for k, side in enumerate("lr"):
            d_out = d_both[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            d_z = np.empty((t_len, n, 4 * HIDDEN), np.float32)
            recurrent = np.zeros_like(self.p[f"h{side}"])
            for t, h, before, i, f, o, new, wide in reversed(seen["kept"][side]):
                d_h = d_h + d_out[t]
                d_c = d_c + d_h * o * (1 - wide**2)
                parts = (d_c * new * i * (1 - i), d_c * before * f * (1 - f), d_h * wide * o * (1 - o), d_c * i * (1 - new**2))
                d_z[t] = np.concatenate(parts, axis=1)
                recurrent += h.T @ d_z[t]
                d_h, d_c = d_z[t] @ self.p[f"h{side}"].T, d_c * f
            g[f"h{side}"], g[f"b{side}"] = recurrent, d_z.sum((0, 1))
            by_code = np.zeros((CODES, 4 * HIDDEN), np.float32)
            np.add.at(by_code, seen["codes"].ravel(), d_z.reshape(-1, 4 * HIDDEN))
            g[f"x{side}"] = self.p["embedding"].T @ by_code
            g["embedding"] += by_code @ self.p[f"x{side}"].T
        return g

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, rate: float = 0.03, seed: int = 0) -> Tagger:
        """Adam on batches drawn at random, with a rate that falls to a tenth."""
        random = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            some = random.integers(0, len(codes), batch)
            g = self.gradients(codes[some], tags[some])
            size = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
            speed = rate * (1 - 0.9 * step / steps) * min(1, 20 / (size + 1e-9))
            for k, x in g.items():
                mean[k] = 0.9 * mean[k] + 0.1 * x
                square[k] = 0.99 * square[k] + 0.01 * x**2
                self.p[k] = self.p[k] + speed * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
        return self
