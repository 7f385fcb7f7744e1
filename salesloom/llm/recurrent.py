"""A gated recurrent language model in numpy, with a class-factored output.

The next symbol's class is a softmax over all classes; for a word of the model's own vocabulary its
place in the class is a second softmax. Words beyond the vocabulary are symbols of their class only.
Documents run through lanes side by side; the state is carried from window to window until a
document ends, and gradients are cut at the window's start. Long documents are learnt in stretches
side by side, each from the state that the document up to there gives.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

GATES = 3


class Shape(NamedTuple):
    hidden: int
    own: int  # classes of own words
    width: int  # words in each of them
    other: int  # classes of all other words

    @property
    def words(self) -> int:
        return self.own * self.width

    @property
    def symbols(self) -> int:
        return self.words + self.other

    @property
    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, c = self.hidden, self.own + self.other
        return {
            "enter": (self.symbols, GATES * h),
            "turn": (h, GATES * h),
            "pick": (h, c),
            "pick_bias": (c,),
            "word": (self.own, h, self.width),
            "word_bias": (self.own, self.width),
        }


Weights = dict[str, np.ndarray]


def fresh(shape: Shape, counts: np.ndarray, seed: int = 3) -> Weights:
    """Weights that start as the distribution of ``counts`` by symbol."""
    rng = np.random.default_rng(seed)
    out = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in shape.sizes.items()}
    own = counts[: shape.words].reshape(shape.own, shape.width) + 0.5
    total = np.concatenate([own.sum(axis=1), counts[shape.words :] + 0.5])
    out["pick_bias"] = np.log(total / total.sum()).astype(np.float32)
    out["word_bias"] = np.log(own / own.sum(axis=1, keepdims=True)).astype(np.float32)
    return out


def packed(weights: Weights, shape: Shape) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in shape.sizes])


def unpacked(flat: np.ndarray, shape: Shape) -> Weights:
    out, at = {}, 0
    for k, s in shape.sizes.items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


class Lanes(NamedTuple):
    symbols: np.ndarray  # steps x lanes
    real: np.ndarray  # not padding
    last: np.ndarray  # ends of documents
    place: np.ndarray  # of each document's first symbol, in lane order
    order: np.ndarray  # documents in that order
    sizes: np.ndarray  # of the lanes, the longest first


def lay(docs: list[np.ndarray], lanes: int) -> Lanes:
    """Whole documents in lanes of about one length, the longest first into the shortest lane."""
    import heapq

    lanes = max(1, min(lanes, len(docs)))
    heap = [(0, i) for i in range(lanes)]
    held: list[list[int]] = [[] for _ in range(lanes)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        size, lane = heap[0]
        held[lane].append(i)
        heapq.heapreplace(heap, (size + len(docs[i]), lane))
    held.sort(key=lambda row: -sum(len(docs[i]) for i in row))
    sizes = np.array([sum(len(docs[i]) for i in row) for row in held])
    steps = int(sizes[0])
    symbols = np.zeros((lanes, steps), np.int32)
    real, last = np.zeros((lanes, steps), bool), np.zeros((lanes, steps), bool)
    place, order = [], []
    for lane, row in enumerate(held):
        at = 0
        for i in row:
            n = len(docs[i])
            symbols[lane, at : at + n] = docs[i]
            real[lane, at : at + n] = True
            last[lane, at + n - 1] = True
            place.append(lane * steps + at)
            order.append(i)
            at += n
    return Lanes(symbols.T.copy(), real.T.copy(), last.T.copy(), np.array(place), np.array(order), sizes)


Entries = dict[int, tuple[np.ndarray, np.ndarray]]  # by step: lanes, and the states they start from


def _run(w: Weights, x: np.ndarray, last: np.ndarray, state: np.ndarray, keep: bool, entries: Entries | None = None):
    """States before each symbol of a window, the state after it, and what a backward pass needs."""
    steps, lanes = x.shape
    h = state.shape[1]
    before = np.empty((steps, lanes, h), np.float32)
    entered = w["enter"][x]
    kept = []
    stay, ends = ~last, last.any(axis=1)
    for t in range(steps):
        if entries and t in entries:
            lane, entry = entries[t]
            state = state.copy()
            state[lane] = entry
        before[t] = state
        turned = state @ w["turn"]
        zr = entered[t, :, : 2 * h] + turned[:, : 2 * h]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        n = zr[:, h:] * turned[:, 2 * h :]
        n += entered[t, :, 2 * h :]
        np.tanh(n, out=n)
        if keep:
            kept.append((zr, n, turned[:, 2 * h :]))
        state = n + zr[:, :h] * (state - n)
        if ends[t]:
            state = state * stay[t][:, None]
    return before, state, kept


def _classes(w: Weights, shape: Shape, symbols: np.ndarray) -> np.ndarray:
    return np.where(symbols < shape.words, symbols // shape.width, symbols - shape.words + shape.own)


def _exponentials(logits: np.ndarray, most: float) -> tuple[np.ndarray, np.float32]:
    """The softmax's denominators and the logarithm of what they were divided by; turns the logits
    into the numerators.

    ``most`` bounds the logits, so one number, the same for all rows, keeps them in range.
    """
    shift = np.float32(max(0.0, most - 60.0))
    if shift:
        logits -= shift
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    return np.maximum(total, 1e-30, out=total), shift


def _normal(logits: np.ndarray, most: float) -> np.ndarray:
    """Natural log of the softmax's denominators; turns the logits into their exponentials."""
    total, shift = _exponentials(logits, most)
    return np.log(total) + shift


def _most(weights: np.ndarray, bias: np.ndarray) -> float:
    """The largest logit that a state, whose components lie between -1 and 1, can give."""
    return float((np.abs(weights).sum(axis=-2) + bias).max())


def _by_class(shape: Shape, classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(classes, kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(shape.own + 1))
    for c in range(shape.own):
        if cuts[c] < cuts[c + 1]:
            yield c, order[cuts[c] : cuts[c + 1]]


def log_probabilities(w: Weights, shape: Shape, docs: list[np.ndarray], lanes: int = 512, window: int = 32) -> np.ndarray:
    """Natural log probability of each document's symbols, the whole document long."""
    if not docs:
        return np.empty(0)
    laid = lay(docs, lanes)
    steps, width = laid.symbols.shape
    found = np.zeros((steps, width), np.float64)
    state = np.zeros((width, shape.hidden), np.float32)
    most, most_inner = _most(w["pick"], w["pick_bias"]), _most(w["word"], w["word_bias"])
    for at in range(0, steps, window):
        # Lanes that have run out are left behind.
        cut = (slice(at, at + window), slice(0, int((laid.sizes > at).sum())))
        x, real = laid.symbols[cut], laid.real[cut]
        before, state, _ = _run(w, x, laid.last[cut], state[cut[1]], False)
        h, y = before[real], x[real]
        classes = _classes(w, shape, y)
        logits = h @ w["pick"]
        logits += w["pick_bias"]
        score = logits.ravel()[np.arange(0, logits.size, logits.shape[1]) + classes].astype(np.float64)
        score -= _normal(logits, most)
        for c, rows in _by_class(shape, classes):
            inner = h[rows] @ w["word"][c]
            inner += w["word_bias"][c]
            part = inner.ravel()[np.arange(0, inner.size, shape.width) + (y[rows] - c * shape.width)]
            score[rows] += part - _normal(inner, most_inner)
        found[cut][real] = score
    out = np.empty(len(docs))
    out[laid.order] = np.add.reduceat(found.T.ravel(), laid.place)
    return out


def states_at(w: Weights, shape: Shape, docs: list[np.ndarray], stretch: int, lanes: int = 512, window: int = 32) -> list[np.ndarray]:
    """For each document the states before its symbols 0, ``stretch``, twice ``stretch`` and so on."""
    found = [np.zeros((max(1, -(-len(d) // stretch)), shape.hidden), np.float32) for d in docs]
    if not docs:
        return found
    laid = lay(docs, lanes)
    steps, width = laid.symbols.shape
    lane, first = laid.place // steps, laid.place % steps
    # What comes before a document's last wanted state is all that has to be run.
    wanted = [(int(f) + i * stretch, int(at), doc, i) for doc, at, f in zip(laid.order, lane, first) for i in range(1, len(found[doc]))]
    wanted.sort()
    state, seen = np.zeros((width, shape.hidden), np.float32), 0
    for at in range(0, steps, window):
        if seen == len(wanted):
            break
        cut = (slice(at, at + window), slice(0, int((laid.sizes > at).sum())))
        before, state, _ = _run(w, laid.symbols[cut], laid.last[cut], state[cut[1]], False)
        while seen < len(wanted) and wanted[seen][0] < at + window:
            step, row, doc, i = wanted[seen]
            found[doc][i] = before[step - at, row]
            seen += 1
    return found


class Learner:
    """Adam on windows of lanes, the state carried over."""

    def __init__(self, weights: Weights, shape: Shape, rate: float = 0.01):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.shape, self.rate, self.step = shape, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def learn(self, docs: list[np.ndarray], lanes: int = 128, window: int = 32, stretch: int = 1024) -> None:
        """One pass over the documents. Long ones are learnt in stretches in different lanes, so that
        no lane runs on alone; a stretch starts from the state in which the weights at the pass's
        start leave the document before it.
        """
        long = [i for i, d in enumerate(docs) if len(d) > stretch]
        states = dict(zip(long, states_at(self.w, self.shape, [docs[i] for i in long], stretch)))
        parts, entry = [], []
        for i, d in enumerate(docs):
            for number, at in enumerate(range(0, len(d), stretch)):
                parts.append(d[at : at + stretch])
                entry.append(states[i][number] if number else None)
        if not parts:
            return
        laid = lay(parts, lanes)
        steps, width = laid.symbols.shape
        entries: dict[int, list] = {}
        for part, place in zip(laid.order, laid.place):
            if entry[part] is not None:
                entries.setdefault(int(place % steps), []).append((place // steps, entry[part]))
        state = np.zeros((width, self.shape.hidden), np.float32)
        for at in range(0, steps, window):
            cut = (slice(at, at + window), slice(0, int((laid.sizes > at).sum())))
            here = {
                t - at: (np.array([lane for lane, _ in entries[t]]), np.stack([e for _, e in entries[t]]))
                for t in range(at, min(at + window, steps))
                if t in entries
            }
            state = self._window(laid.symbols[cut], laid.real[cut], laid.last[cut], state[cut[1]], here)

    def _window(self, x, real, last, state, entries: Entries) -> np.ndarray:
        w, shape, h = self.w, self.shape, self.shape.hidden
        before, after, kept = _run(w, x, last, state, True, entries)
        hs, y = before[real], x[real]
        n = max(1, len(y))
        grads = {}
        classes = _classes(w, shape, y)
        soft = hs @ w["pick"]
        soft += w["pick_bias"]
        total, _ = _exponentials(soft, _most(w["pick"], w["pick_bias"]))
        soft *= (1 / (n * total))[:, None]
        soft[np.arange(len(y)), classes] -= np.float32(1 / n)
        grads["pick"], grads["pick_bias"] = hs.T @ soft, soft.sum(axis=0)
        back = soft @ w["pick"].T
        most_inner = _most(w["word"], w["word_bias"])
        grads["word"], grads["word_bias"] = np.zeros_like(w["word"]), np.zeros_like(w["word_bias"])
        for c, rows in _by_class(shape, classes):
            of_class = hs[rows]
            inner = of_class @ w["word"][c]
            inner += w["word_bias"][c]
            total, _ = _exponentials(inner, most_inner)
            inner *= (1 / (n * total))[:, None]
            inner[np.arange(len(rows)), y[rows] - c * shape.width] -= np.float32(1 / n)
            grads["word"][c], grads["word_bias"][c] = of_class.T @ inner, inner.sum(axis=0)
            back[rows] += inner @ w["word"][c].T
        slope = np.zeros_like(before)
        slope[real] = back
        turn = np.zeros_like(w["turn"])
        entered = np.empty((*x.shape, GATES * h), np.float32)
        ahead = np.zeros_like(state)
        for t in range(len(x) - 1, -1, -1):
            zr, new, raw = kept[t]
            z, r, old = zr[:, :h], zr[:, h:], before[t]
            ahead = ahead * ~last[t][:, None]
            d = entered[t]
            dn = ahead * (1 - z) * (1 - new * new)
            d[:, :h] = ahead * (old - new) * z * (1 - z)
            d[:, h : 2 * h] = dn * raw * r * (1 - r)
            d[:, 2 * h :] = dn
            through = np.concatenate([d[:, : 2 * h], dn * r], axis=1)
            turn += old.T @ through
            ahead = ahead * z + through @ w["turn"].T + slope[t]
        grads["turn"] = turn
        flat, order = x.ravel(), np.argsort(x.ravel(), kind="stable")
        seen, starts = np.unique(flat[order], return_index=True)
        rows = np.add.reduceat(entered.reshape(-1, GATES * h)[order], starts, axis=0)
        self._update(grads, seen, rows)
        return after

    def _update(self, grads: Weights, seen: np.ndarray, rows: np.ndarray) -> None:
        self.step += 1
        bias = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, at, g in [("enter", seen, rows), *((k, slice(None), g) for k, g in grads.items())]:
            m, v = self.first[k], self.second[k]
            g = np.clip(g, -1, 1)
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            self.w[k][at] -= self.rate * bias * m[at] / (np.sqrt(v[at]) + 1e-6)
