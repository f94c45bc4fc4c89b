"""The gated recurrent language model: cell, truncated backpropagation and class-factored softmax, in numpy.

Documents stand one behind the other in lanes; all lanes step together, and a window of WINDOW steps is worked on at a time.
The state is carried from window to window and reset where a document begins, so a document of any length is scored whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

LANES, WINDOW = 384, 24
#: Rows of logits worked on at once, so that they stay in the cache.
_ROWS = 1024


def _gate(y: np.ndarray) -> None:
    """1 / (1 + e^y), in place: a gate opens as y falls. An overflow to infinity closes it, as it should."""
    np.exp(y, out=y)
    y += 1
    np.reciprocal(y, out=y)


def _scores(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, unused: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, their exponentials and the exponentials' sums. States are within 1, so weights tell if a shift is needed."""
    logits = states @ weights
    logits += bias if unused is None else bias + unused
    if float((np.abs(weights).sum(axis=0) + np.abs(bias)).max()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    powers = np.exp(logits)
    return logits, powers, powers @ np.ones(powers.shape[1], powers.dtype)


class GatedModel:
    """inputs: symbols read. classes: symbol classes predicted. The first len(sizes) of them hold sizes[k] symbols each."""

    def __init__(self, inputs: int, classes: int, sizes: list[int], hidden: int = 32, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        slots = max([1, *sizes])
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(hidden)).astype(np.float32)
        self.hidden = hidden
        self.weights = {
            "embed": draw(inputs, 3 * hidden), "recur": draw(hidden, 3 * hidden),
            "to_class": draw(hidden, classes), "class_bias": np.zeros(classes, np.float32),
            "to_slot": draw(len(sizes), hidden, slots), "slot_bias": np.zeros((len(sizes), slots), np.float32),
        }
        self.unused = np.zeros((len(sizes), slots), np.float32)  # added to the logits of slots without a symbol
        for k, n in enumerate(sizes):
            self.unused[k, n:] = -1e9

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name, w in self.weights.items():
            self.weights[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size

    def forward(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """x, fresh: steps by lanes; fresh marks the first step of a document. Returns the states before each prediction."""
        w, n = self.weights, self.hidden
        out, kept = np.empty((*x.shape, n), w["recur"].dtype), []
        gates, resets = w["embed"][x], fresh.any(axis=1)
        for t in range(len(x)):
            if resets[t]:
                h = h * ~fresh[t][:, None]
            u = h @ w["recur"]
            g = gates[t]
            zr = g[:, : 2 * n]
            zr += u[:, : 2 * n]
            _gate(zr)
            c, uc = g[:, 2 * n :], u[:, 2 * n :]
            c += zr[:, n:] * uc
            np.tanh(c, out=c)
            new = out[t]
            np.subtract(h, c, out=new)
            new *= zr[:, :n]
            new += c
            if keep:
                kept.append((h, uc))
            h = new
        if keep:
            kept.append(gates)  # by now gates and candidates
        return out, kept

    def log_probabilities(self, states: np.ndarray, classes: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Natural log of each target's class and, in classes with slots, of its slot (slot -1: none)."""
        w = self.weights
        out = np.empty(len(classes))
        for at in range(0, len(classes), _ROWS):
            part = slice(at, at + _ROWS)
            logits, _, sums = _scores(states[part], w["to_class"], w["class_bias"])
            out[part] = logits[np.arange(len(sums)), classes[part]] - np.log(sums)
        for k, rows in _by_class(classes, slots):
            logits, _, sums = _scores(states[rows], w["to_slot"][k], w["slot_bias"][k], self.unused[k])
            out[rows] += logits[np.arange(len(rows)), slots[rows]] - np.log(sums)
        return out

    def gradients(self, x: np.ndarray, fresh: np.ndarray, live: np.ndarray, classes: np.ndarray, slots: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean negative log probability over the live steps of a window; the state after it; the loss."""
        w, n = self.weights, self.hidden
        with np.errstate(over="ignore"):
            states, kept = self.forward(x, fresh, h, True)
        at = np.flatnonzero(live.ravel())
        s, c, j = states.reshape(-1, n)[at], classes.ravel()[at], slots.ravel()[at]
        scale = np.float32(1 / max(1, len(at)))
        grads = {k: np.zeros_like(v) for k, v in w.items()}

        def output(rows_states: np.ndarray, weights: np.ndarray, bias: np.ndarray, unused: np.ndarray | None, target: np.ndarray) -> tuple[np.ndarray, float]:
            logits, d, sums = _scores(rows_states, weights, bias, unused)
            every = np.arange(len(target))
            loss = float(np.log(sums).sum() - logits[every, target].sum())
            d *= (scale / sums)[:, None]
            d[every, target] -= scale
            return d, loss

        loss, ds = 0.0, np.empty_like(s)
        for part in (slice(k, k + _ROWS) for k in range(0, len(c), _ROWS)):
            d, more = output(s[part], w["to_class"], w["class_bias"], None, c[part])
            loss += more
            grads["to_class"] += s[part].T @ d
            grads["class_bias"] += d.sum(axis=0)
            np.matmul(d, w["to_class"].T, out=ds[part])
        for k, rows in _by_class(c, j):
            d, more = output(s[rows], w["to_slot"][k], w["slot_bias"][k], self.unused[k], j[rows])
            loss += more
            grads["to_slot"][k], grads["slot_bias"][k] = s[rows].T @ d, d.sum(axis=0)
            ds[rows] += d @ w["to_slot"][k].T
        dstates = np.zeros((x.size, n), states.dtype)
        dstates[at] = ds
        dstates = dstates.reshape(*x.shape, n)
        gates = kept.pop()
        dh = np.zeros_like(h)
        before, uc = np.stack([k[0] for k in kept]), np.stack([k[1] for k in kept])
        z, r, cand = gates[..., :n], gates[..., n : 2 * n], gates[..., 2 * n :]
        # what one unit of a state's gradient is at the inputs; a gate falls by gate * (1 - gate) as its input rises
        of_cand = (1 - z) * (1 - cand * cand)
        of_gates = np.concatenate((z * (z - 1) * (before - cand), of_cand * uc * r * (r - 1), of_cand * r), axis=2)
        through = np.empty_like(of_gates)
        back, resets = w["recur"].T.copy(), fresh.any(axis=1)
        for t in range(len(x) - 1, -1, -1):
            dh += dstates[t]
            dstates[t] = dh
            np.multiply(of_gates[t].reshape(-1, 3, n), dh[:, None, :], out=through[t].reshape(-1, 3, n))
            dh *= z[t]
            dh += through[t] @ back
            if resets[t]:
                dh *= ~fresh[t][:, None]
        grads["recur"] += before.reshape(-1, n).T @ through.reshape(-1, 3 * n)
        gates[..., : 2 * n] = through[..., : 2 * n]
        gates[..., 2 * n :] = dstates * of_cand
        flat = gates.reshape(-1, 3 * n)
        ids = x.ravel().astype(np.int16) if len(w["embed"]) < 1 << 15 else x.ravel()  # short numbers sort by radix
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        begins = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        grads["embed"][ids[begins]] = np.add.reduceat(flat[order], begins, axis=0)
        return grads, states[-1], loss * float(scale)


def _by_class(classes: np.ndarray, slots: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    rows = np.flatnonzero(slots >= 0)
    rows = rows[np.argsort(classes[rows].astype(np.int16), kind="stable")]
    held = classes[rows]
    cuts = np.flatnonzero(held[1:] != held[:-1]) + 1
    for part in np.split(rows, cuts) if len(rows) else ():
        yield int(classes[part[0]]), part


class Adam:
    def __init__(self, model: GatedModel, rate: float) -> None:
        self.model, self.rate, self.t = model, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        clip = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for k, g in grads.items():
            g *= clip
            m, v = self.m[k], self.v[k]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            self.model.weights[k] -= rate * m / (np.sqrt(v) + np.float32(1e-8))


class Lanes:
    """Documents (arrays of symbol numbers that end with the end symbol) dealt to lanes of about equal length.

    Only the documents' own symbols are held; the arrays of a window are gathered when it comes.
    """

    def __init__(self, docs: list[np.ndarray], start: int, lanes: int = LANES) -> None:
        parts: list[list[int]] = [[] for _ in range(min(lanes, len(docs)))]
        heap = [(0, k) for k in range(len(parts))]
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):  # the longest to the emptiest lane
            size, k = heapq.heappop(heap)
            parts[k].append(i)
            heapq.heappush(heap, (size + len(docs[i]), k))
        parts.sort(key=lambda p: -sum(len(docs[i]) for i in p))
        order = [i for p in parts for i in p]
        self.lengths = np.array([sum(len(docs[i]) for i in p) for p in parts], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        sizes = np.array([len(docs[i]) for i in order], np.int64)
        self.target = np.concatenate([docs[i] for i in order]) if order else np.zeros(0, np.int32)
        self.owner = np.repeat(np.array(order, np.int32), sizes)
        self.fresh = np.zeros(len(self.target), bool)
        self.fresh[np.cumsum(sizes) - sizes] = True
        self.input = np.empty_like(self.target)
        self.input[1:] = self.target[:-1]
        self.input[self.fresh] = start

    def windows(self, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
        """Input, target, fresh, owner and live of each window, steps by lanes: the first lanes, as many as still run."""
        for t in range(0, int(self.lengths.max(initial=0)), window):
            running = int((self.lengths > t).sum())
            steps = np.arange(t, min(t + window, int(self.lengths[0])))[:, None]
            live = steps < self.lengths[:running]
            at = self.begins[:running] + np.minimum(steps, self.lengths[:running] - 1)
            yield self.input[at], self.target[at], self.fresh[at], self.owner[at], live
