"""A character tagger in numpy: embedding, bidirectional LSTM, linear-chain CRF."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """Tags of equally long sequences of symbol numbers, (batch, time).

    ``allowed[a, b]`` says whether tag b may follow tag a, ``first[b]`` whether it may come first.
    """

    FORBIDDEN = -1e4

    def __init__(self, symbols: int, allowed: np.ndarray, first: np.ndarray, width: int = 12, hidden: int = 24, seed: int = 0):
        draw = np.random.default_rng(seed)
        tags = len(allowed)
        self.hidden = hidden
        self.p = {"embed": draw.normal(0, 0.3, (symbols, width)), "out": draw.normal(0, 0.2, (2 * hidden, tags)), "bias": np.zeros(tags),
                  "trans": np.zeros((tags, tags))}
        for side in "lr":
            self.p |= {f"x{side}": draw.normal(0, 0.25, (width, 4 * hidden)), f"h{side}": draw.normal(0, 0.2, (hidden, 4 * hidden)), f"b{side}": np.zeros(4 * hidden)}
            self.p[f"b{side}"][hidden:2 * hidden] = 1  # keep the cell's content at the start
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.closed = np.where(allowed, 0, self.FORBIDDEN).astype(np.float32)
        self.start = np.where(first, 0, self.FORBIDDEN).astype(np.float32)

    # --- LSTM -----------------------------------------------------------------------------------

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        h = c = np.zeros((len(x), self.hidden), np.float32)
        inputs = x @ self.p[f"x{side}"] + self.p[f"b{side}"]
        states, kept = np.empty((*x.shape[:2], self.hidden), np.float32), []
        n = self.hidden
        for t in range(x.shape[1]):
            z = inputs[:, t] + h @ self.p[f"h{side}"]
            gates, g = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
            before, c = c, f * c + i * g
            squeezed = np.tanh(c)
            kept.append((h, before, gates, g, squeezed))
            h = o * squeezed
            states[:, t] = h
        return states, kept

    def _lstm_back(self, x: np.ndarray, kept: list, grad: np.ndarray, side: str, out: dict) -> np.ndarray:
        n = self.hidden
        dz = np.empty((*x.shape[:2], 4 * n), np.float32)
        dh = dc = np.zeros((len(x), n), np.float32)
        back = self.p[f"h{side}"].T
        recurrent = np.zeros_like(self.p[f"h{side}"])
        for t in range(x.shape[1] - 1, -1, -1):
            h, before, gates, g, squeezed = kept[t]
            i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - squeezed ** 2)
            z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squeezed * o * (1 - o), dc * i * (1 - g ** 2)], 1)
            dz[:, t] = z
            recurrent += h.T @ z
            dh, dc = z @ back, dc * f
        flat = dz.reshape(-1, 4 * n)
        out[f"h{side}"] = recurrent
        out[f"x{side}"] = x.reshape(-1, x.shape[2]).T @ flat
        out[f"b{side}"] = flat.sum(0)
        return dz @ self.p[f"x{side}"].T

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        x = self.p["embed"][symbols]
        left, _ = self._lstm(x, "l")
        right, _ = self._lstm(x[:, ::-1], "r")
        return np.concatenate([left, right[:, ::-1]], 2) @ self.p["out"] + self.p["bias"]

    # --- CRF ------------------------------------------------------------------------------------

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """The best tag sequence of each row (Viterbi)."""
        emit, trans = self.emissions(symbols), self.p["trans"] + self.closed
        score = emit[:, 0] + self.start
        best = np.empty(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            through = score[:, :, None] + trans
            best[:, t] = through.argmax(1)
            score = through.max(1) + emit[:, t]
        tags = np.empty(symbols.shape, np.int8)
        tags[:, -1] = score.argmax(1)
        rows = np.arange(len(symbols))
        for t in range(emit.shape[1] - 1, 0, -1):
            tags[:, t - 1] = best[rows, t, tags[:, t]]
        return tags

    def loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradient."""
        x = self.p["embed"][symbols]
        left, kept_left = self._lstm(x, "l")
        flipped = np.ascontiguousarray(x[:, ::-1])
        right, kept_right = self._lstm(flipped, "r")
        both = np.concatenate([left, right[:, ::-1]], 2)
        emit, trans = both @ self.p["out"] + self.p["bias"], self.p["trans"] + self.closed
        rows, times, k = *symbols.shape, len(trans)
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + self.start
        for t in range(1, times):
            alpha[:, t] = _logsumexp(alpha[:, t - 1, :, None] + trans, 1) + emit[:, t]
        for t in range(times - 2, -1, -1):
            beta[:, t] = _logsumexp(trans + (beta[:, t + 1] + emit[:, t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[:, -1], 1)
        gold = np.take_along_axis(emit, tags[:, :, None], 2)[:, :, 0].sum(1) + self.start[tags[:, 0]] + trans[tags[:, :-1], tags[:, 1:]].sum(1)
        demit = np.exp(alpha + beta - total[:, None, None])
        pairs = alpha[:, :-1, :, None] + trans + (beta + emit)[:, 1:, None, :] - total[:, None, None, None]
        dtrans = np.exp(pairs).sum((0, 1))
        np.subtract.at(dtrans, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        demit[np.arange(rows)[:, None], np.arange(times), tags] -= 1
        demit, dtrans = (demit / rows).astype(np.float32), (dtrans / rows).astype(np.float32)
        grads = {"trans": dtrans, "out": both.reshape(-1, both.shape[2]).T @ demit.reshape(-1, k), "bias": demit.sum((0, 1))}
        dboth = demit @ self.p["out"].T
        dx = self._lstm_back(x, kept_left, dboth[:, :, :self.hidden], "l", grads)
        dx = dx + self._lstm_back(flipped, kept_right, dboth[:, ::-1, self.hidden:], "r", grads)[:, ::-1]
        grads["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grads["embed"], symbols.ravel(), dx.reshape(-1, dx.shape[2]))
        return float((total - gold).mean()), grads

    def train(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 0) -> None:
        """Adam with a falling rate."""
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, step = epochs * -(-len(symbols) // batch), 0
        for _ in range(epochs):
            order = draw.permutation(len(symbols))
            for at in range(0, len(order), batch):
                chosen = order[at:at + batch]
                _, grads = self.loss(symbols[chosen], tags[chosen])
                norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
                step += 1
                now, shrink = rate * (1 - (step - 1) / steps), min(1.0, 5 / (norm + 1e-9))
                for k, g in grads.items():
                    g = g * np.float32(shrink)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] -= now * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
