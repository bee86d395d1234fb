"""A gated recurrent language model in numpy.

Input weights are one table row per token. The output is factored: a softmax
over word classes, then one over the words of the class, so a token costs the
classes plus one class instead of the whole vocabulary. Biases start at the
log counts, so an untrained net is the unigram model.

Documents run in lanes side by side; a lane is a row of whole documents, its
state starts at zero at each document and is carried from window to window.
Training is back-propagation truncated at the windows.
"""

from __future__ import annotations

import numpy as np

WIDTH = 16  # state
LANES = 1024
WINDOW = 16  # steps of truncated back-propagation
SCORE_LANES = 512
LEAST_LANES = 16
STRETCH = 512  # tokens
RATE = 0.05
SPREAD = 0.1
SAFE = 60.0  # exponentials of scores this far from 0, and their sums, lie well within single precision


def classes_of(counts: np.ndarray, classes: int) -> np.ndarray:
    """First word of each class (and the end): words in falling order of counts, cut at equal shares of the counts' roots."""
    if not counts.sum():
        return np.array([0, len(counts)])
    root = np.sqrt(counts.astype(np.float64))
    share = np.cumsum(root) / root.sum()
    cls = np.minimum((share - root / root.sum() / 2) * classes, classes - 1).astype(np.int64)
    return np.append(np.unique(cls, return_index=True)[1], len(counts))


class Net:
    """Weights by name, all float32. Words 0..n-1 in class order; inputs may have more rows than there are words."""

    def __init__(self, counts: np.ndarray, inputs: int, classes: int, width: int = WIDTH, seed: int = 11) -> None:
        rng = np.random.RandomState(seed)
        self.width = width
        self.edge = classes_of(counts, classes)
        n, k = len(counts), len(self.edge) - 1
        self.cls = np.repeat(np.arange(k), np.diff(self.edge))
        p = (counts + 0.1) / (counts + 0.1).sum()
        p_cls = np.add.reduceat(p, self.edge[:-1])
        self.w = {
            "inputs": rng.normal(0, SPREAD, (inputs, 3 * width)), "state": rng.normal(0, 1 / np.sqrt(width), (width, 3 * width)) * 0.5,
            "cls": rng.normal(0, SPREAD, (width, k)), "cls_bias": np.log(p_cls),
            "word": rng.normal(0, SPREAD, (n, width)), "word_bias": np.log(p / p_cls[self.cls])}
        self.w = {name: v.astype(np.float32) for name, v in self.w.items()}

    # weights as one vector, for averaging
    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.w.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name, v in self.w.items():
            self.w[name] = flat[at:at + v.size].astype(np.float32).reshape(v.shape)
            at += v.size

    # ---- lanes ----
    @staticmethod
    def lanes(docs: list[tuple[np.ndarray, np.ndarray]], count: int):
        """(inputs, targets, document numbers, starts, lane lengths): documents dealt to the shortest lane,
        longest first; lanes in falling order of length, so that the running ones come first."""
        import heapq
        order = sorted(range(len(docs)), key=lambda d: -len(docs[d][1]))
        heap = [(0, k) for k in range(min(count, len(docs)))]
        members: list[list[int]] = [[] for _ in heap]
        for d in order:
            size, k = heapq.heappop(heap)
            members[k].append(d)
            heapq.heappush(heap, (size + len(docs[d][1]), k))
        lengths = np.array([sum(len(docs[d][1]) for d in m) for m in members])
        rank = np.argsort(-lengths, kind="stable")
        steps = int(lengths.max())
        x, y = (np.zeros((steps, len(members)), np.uint16) for _ in range(2))  # fewer than 65,536 words
        who = np.zeros((steps, len(members)), np.int32)
        begins = np.zeros((steps, len(members)), bool)
        for col, k in enumerate(rank):
            at = 0
            for d in members[k]:
                n = len(docs[d][1])
                x[at:at + n, col], y[at:at + n, col], who[at:at + n, col] = docs[d][0], docs[d][1], d
                begins[at, col] = True
                at += n
        return x, y, who, begins, lengths[rank]

    # ---- forward ----
    def _steps(self, x: np.ndarray, begins: np.ndarray, h: np.ndarray, keep: bool = False):
        """(states after each step, what the backward pass needs)."""
        n, u = self.width, self.w["state"]
        steps, lanes = x.shape
        given = self.w["inputs"][x]
        out = np.empty((steps, lanes, n), np.float32)
        kept = [np.empty((steps, lanes, k), np.float32) for k in (n, 2 * n, n, n)] if keep else None
        fresh = begins.any(axis=1)
        for t in range(steps):
            if fresh[t]:
                h = h.copy()
                h[begins[t]] = 0
            pre, rec = given[t], h @ u
            gates = pre[:, :2 * n] + rec[:, :2 * n]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = gates[:, n:] * rec[:, 2 * n:]
            new += pre[:, 2 * n:]
            np.tanh(new, out=new)
            if keep:
                kept[0][t], kept[1][t], kept[2][t], kept[3][t] = h, gates, rec[:, 2 * n:], new
            h = h - new
            h *= gates[:, :n]
            h += new
            out[t] = h
        return out, kept

    @staticmethod
    def _exponentials(z: np.ndarray, at: np.ndarray, y: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
        """(scores at `y`, sums of the rows' exponentials); `z` becomes the exponentials. No score is further from 0 than
        `largest`: only where that is too much for single precision is each row's largest score taken off first."""
        if not largest < SAFE:
            z -= z.max(axis=1, keepdims=True)
        picked = z[at, y]
        np.exp(z, out=z)
        return picked, z @ np.ones(z.shape[1], z.dtype)

    def _out(self, h: np.ndarray, y: np.ndarray, learn: bool = False):
        """Log probabilities of the words `y` after states `h`; with `learn` also the gradients."""
        w = self.w
        rows = np.arange(len(y))
        c = self.cls[y]
        z = h @ w["cls"] + w["cls_bias"]
        # states lie between -1 and 1
        picked, total = self._exponentials(z, rows, c, float((np.abs(w["cls"]).sum(axis=0) + np.abs(w["cls_bias"])).max()))
        logp = picked - np.log(total)
        grads, dh = {}, None
        if learn:
            z /= total[:, None]
            z[rows, c] -= 1
            grads["cls"], grads["cls_bias"] = h.T @ z, z.sum(axis=0)
            dh = z @ w["cls"].T
            # words without a target in their class keep a gradient of 0, which moves nothing
            grads["word"], grads["word_bias"] = np.zeros_like(w["word"]), np.zeros_like(w["word_bias"])
        largest = float((np.abs(w["word"]).sum(axis=1) + np.abs(w["word_bias"])).max())
        order = np.argsort(c.astype(np.int16), kind="stable")  # 16 bits: a radix sort
        ends = np.append(0, np.cumsum(np.bincount(c, minlength=len(self.edge) - 1)))
        h, y = h[order], y[order]
        more, dh_more = np.zeros_like(logp), None if dh is None else np.zeros_like(dh)
        for k in range(len(self.edge) - 1):
            lo, hi = self.edge[k], self.edge[k + 1]
            if hi - lo == 1 or ends[k] == ends[k + 1]:
                continue
            sel = slice(ends[k], ends[k + 1])
            hk, yk = h[sel], y[sel] - lo
            z = hk @ w["word"][lo:hi].T + w["word_bias"][lo:hi]
            at = rows[:len(yk)]
            picked, total = self._exponentials(z, at, yk, largest)
            more[sel] = picked - np.log(total)
            if learn:
                z /= total[:, None]
                z[at, yk] -= 1
                grads["word"][lo:hi], grads["word_bias"][lo:hi] = z.T @ hk, z.sum(axis=0)
                dh_more[sel] = z @ w["word"][lo:hi]
        logp[order] += more
        if learn:
            dh[order] += dh_more
        return logp, grads, dh

    # ---- scoring ----
    def score(self, docs: list[tuple[np.ndarray, np.ndarray]], lanes: int = SCORE_LANES, window: int = 64) -> np.ndarray:
        """Natural log probability of each document's targets. As many lanes run as the longest document lets fill evenly."""
        total = np.zeros(len(docs))
        if not docs:
            return total
        sizes = [len(y) for _, y in docs]
        lanes = max(LEAST_LANES, min(lanes, sum(sizes) // max(sizes)))
        x, y, who, begins, lengths = self.lanes(docs, lanes)
        h = np.zeros((x.shape[1], self.width), np.float32)
        for lo in range(0, len(x), window):
            live = int(np.searchsorted(-lengths, -lo, side="left"))
            part = slice(lo, lo + window)
            out, _ = self._steps(x[part, :live], begins[part, :live], h[:live])
            h = out[-1]
            on = (np.arange(lo, lo + len(out))[:, None] < lengths[None, :live]).ravel()
            logp = self._out(out.reshape(-1, self.width)[on], y[part, :live].ravel()[on])[0]
            total += np.bincount(who[part, :live].ravel()[on], logp, len(docs))
        return total

    # ---- training ----
    def train(self, docs: list[tuple[np.ndarray, np.ndarray]], memory: dict, lanes: int = LANES, window: int = WINDOW,
              rate: float = RATE) -> float:
        """One pass over the documents; AdaGrad, its sums in `memory`. Returns the mean loss.
        Documents are learnt in stretches of `STRETCH` tokens, each from a zero state, which fills the lanes evenly."""
        docs = [(x[at:at + STRETCH], y[at:at + STRETCH]) for x, y in docs for at in range(0, len(y), STRETCH)]
        if not docs:
            return 0.0
        x, y, who, begins, lengths = self.lanes(docs, lanes)
        h = np.zeros((x.shape[1], self.width), np.float32)
        loss = count = 0.0
        for lo in range(0, len(x), window):
            live = int(np.searchsorted(-lengths, -lo, side="left"))
            part = slice(lo, lo + window)
            on = np.arange(lo, min(lo + window, len(x)))[:, None] < lengths[None, :live]
            xs, bs = x[part, :live], begins[part, :live]
            out, keep = self._steps(xs, bs, h[:live], True)
            h = out[-1]
            flat = on.ravel()
            n_on = int(flat.sum())
            logp, grads, dh_on = self._out(out.reshape(-1, self.width)[flat], y[part, :live].ravel()[flat], True)
            loss -= float(logp.sum())
            count += n_on
            dout = np.zeros((len(xs) * live, self.width), np.float32)
            dout[flat] = dh_on
            self._learn(xs, bs, keep, dout.reshape(len(xs), live, self.width), grads, memory, rate, 1.0 / n_on)
        return loss / max(1.0, count)

    def _learn(self, xs, begins, keep, dout, grads, memory, rate, scale) -> None:
        n = self.width
        ut = np.ascontiguousarray(self.w["state"].T)
        before, gates, rec, new = keep
        z, r = gates[..., :n], gates[..., n:]
        # factors of the state's gradient that do not depend on it
        z, r = np.ascontiguousarray(z), np.ascontiguousarray(r)
        rest = 1 - z
        to_z = before - new
        to_z *= z
        to_z *= rest
        to_new = new * new
        np.subtract(1, to_new, out=to_new)
        to_new *= rest
        to_r = to_new * rec
        to_r *= r
        np.subtract(1, r, out=rest)
        to_r *= rest
        to_rec = to_new * r
        d_rec = np.empty((*xs.shape, 3 * n), np.float32)
        d_new = np.empty_like(dout)
        fresh = begins.any(axis=1)
        dh = np.zeros_like(dout[0])
        for t in range(len(xs) - 1, -1, -1):
            dh += dout[t]
            g = d_rec[t]
            np.multiply(dh, to_z[t], out=g[:, :n])
            np.multiply(dh, to_r[t], out=g[:, n:2 * n])
            np.multiply(dh, to_rec[t], out=g[:, 2 * n:])
            np.multiply(dh, to_new[t], out=d_new[t])
            dh = dh * z[t]
            dh += g @ ut
            if fresh[t]:
                dh[begins[t]] = 0
        d_in = d_rec.copy()
        d_in[..., 2 * n:] = d_new
        before = before.reshape(-1, n)
        self._step("state", slice(None), before.T @ d_rec.reshape(-1, 3 * n), memory, rate, scale)
        self._step("cls", slice(None), grads["cls"], memory, rate, scale)
        self._step("cls_bias", slice(None), grads["cls_bias"], memory, rate, scale)
        self._step("word", slice(None), grads["word"], memory, rate, scale)
        self._step("word_bias", slice(None), grads["word_bias"], memory, rate, scale)
        tokens = xs.ravel()
        order = np.argsort(tokens, kind="stable")
        counts = np.bincount(tokens)
        used = np.flatnonzero(counts)
        first = np.append(0, np.cumsum(counts[used])[:-1])
        self._step("inputs", used, np.add.reduceat(d_in.reshape(-1, 3 * n)[order], first, axis=0), memory, rate, scale)

    def _step(self, name, rows, grad, memory, rate, scale) -> None:
        g = grad * np.float32(scale)
        if name not in memory:
            memory[name] = np.full_like(self.w[name], 1e-4)
        m = memory[name][rows] + g * g
        memory[name][rows] = m
        self.w[name][rows] -= np.float32(rate) * g / np.sqrt(m)
