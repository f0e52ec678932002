"""A causal self-attention model over subword ids, trained and run in numpy.

Ids are read as classes: the most frequent ids have a class of their own, the others share the remaining classes by their
frequency, so that each of these has about the same mass; a token's probability is that of its class in context times its
share of the class.  Texts are cut into blocks
of ``STRIDE`` positions; each block is a window of the ``STRIDE`` positions before it and its own, so windows overlap,
and scores its own positions once.  All windows of a batch go through one masked attention.  With ``whole`` a position
attends to every earlier one of its text: those before the window weigh by their class and share one distance, so their
sum needs no more than how often each class was read there.
"""

from __future__ import annotations

import copy
import math

import numpy as np

STRIDE = 8
HEAD, TAIL, SIZE = 48, 16, 16
# A logit is at most so large; a weight is at least e to the minus so much of the largest one's pair and place, each.
_LARGE, _FAR = np.float32(60), np.float32(40)
# A position before the window starts with e to this as its weight, next to 1 in the window.
_DISTANT = np.float32(-4)
DISTANCE = STRIDE + np.arange(STRIDE)[:, None] - np.arange(2 * STRIDE)


# Large arrays of one step, kept for the next one: fresh memory costs more than what is done with it.
_ROOMS: dict[tuple[str, str], np.ndarray] = {}


def _room(name: str, shape: tuple[int, ...], kind) -> np.ndarray:
    """An array of this process for one use within a step; its old content is lost."""
    size, key = math.prod(shape), (name, np.dtype(kind).str)
    if key not in _ROOMS or len(_ROOMS[key]) < size:
        _ROOMS[key] = np.empty(size, kind)
    return _ROOMS[key][:size].reshape(shape)


def _summed(rows: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Sums of the rows of every owner."""
    order = np.argsort(owner, kind="stable")
    met, first = np.unique(owner[order], return_index=True)
    out = np.zeros((owners, rows.shape[1]), rows.dtype)
    out[met] = np.add.reduceat(rows.take(order, axis=0, out=_room("sorted", rows.shape, rows.dtype), mode="clip"), first, axis=0)
    return out


def _at(rows: np.ndarray | None, part) -> np.ndarray | None:
    return None if rows is None else rows[part]


def _bands(mass: np.ndarray, bands: int) -> np.ndarray:
    """Stretches of about equal mass, none of them empty if there are enough values."""
    first = np.searchsorted(np.cumsum(mass) - mass / 2, mass.sum() * np.arange(bands) / bands)
    first = np.maximum.accumulate(first - np.arange(bands)) + np.arange(bands)
    first = np.minimum(first, np.maximum(0, len(mass) - bands + np.arange(bands)))
    return np.maximum(np.searchsorted(first, np.arange(len(mass)), "right") - 1, 0)


class AttentionModel:
    def __init__(self, vocabulary: int, counts: np.ndarray, head: int = HEAD, tail: int = TAIL, size: int = SIZE, seed: int = 0, whole: bool = False):
        """``counts``: how often each id of the vocabulary was met; with one more id for the end of a text."""
        rng = np.random.default_rng(seed)
        self.start, self.pad = head + tail, head + tail + 1  # classes that are read but never predicted
        order = np.lexsort((np.arange(vocabulary), -counts))
        smooth = counts + 0.5
        self.classes = np.empty(vocabulary, np.uint8)
        self.classes[order[:head]] = np.arange(min(head, vocabulary))
        self.classes[order[head:]] = head + _bands(smooth[order[head:]], tail)
        mass = np.bincount(self.classes, smooth, head + tail)
        self.within = np.log(smooth / mass[self.classes])
        normal = lambda *shape: (rng.standard_normal(shape) * shape[0] ** -0.5).astype(np.float32)
        c, d = head + tail, size
        self.params = {
            "e": normal(c + 2, d) * 2, "q": normal(d, d), "k": normal(d, d), "v": normal(d, d), "r": np.zeros(2 * STRIDE, np.float32),
            "o": normal(2 * d, c), "u": normal(c + 2, d) * 2, "b": np.zeros(c, np.float32),
        }
        if whole:
            self.params["f"] = np.full(1, _DISTANT)

    def windows(self, texts: list[np.ndarray]):
        """Blocks of all texts: read classes of the window, classes to predict (pad where there is none), first blocks."""
        lengths = np.array([len(t) for t in texts])
        blocks = -(-lengths // STRIDE)
        at = STRIDE * np.concatenate([[0], np.cumsum(blocks + 1)])  # each text behind STRIDE pads
        read, want = np.full(at[-1], self.pad, np.uint8), np.full(at[-1], self.pad, np.uint8)
        flat = self.classes[np.concatenate(texts)]
        place = np.arange(len(flat)) + np.repeat(at[:-1] + STRIDE - (np.cumsum(lengths) - lengths), lengths)
        want[place] = flat
        read[place[1:]] = flat[:-1]
        read[at[:-1] + STRIDE] = self.start
        first = np.repeat(at[:-1] // STRIDE + 1, blocks) + np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        opening = np.zeros(blocks.sum(), bool)
        opening[np.cumsum(blocks) - blocks] = True
        read, want = read.reshape(-1, STRIDE), want.reshape(-1, STRIDE)
        return np.concatenate([read[first - 1], read[first]], axis=1), want[first], opening, blocks

    def earlier(self, texts: list[np.ndarray]) -> np.ndarray | None:
        """How often each class was read before the window of each block, in the order of ``windows``; for ``whole`` only."""
        if "f" not in self.params:
            return None
        lengths = np.array([len(t) for t in texts])
        blocks, classes = -(-lengths // STRIDE), len(self.params["e"])
        first, starts = np.cumsum(blocks) - blocks, np.cumsum(lengths) - lengths
        read = self.classes[np.concatenate(texts)].astype(np.intp)
        read[1:] = read[:-1].copy()
        read[starts] = self.start
        block = np.repeat(first, lengths) + (np.arange(len(read)) - np.repeat(starts, lengths)) // STRIDE
        met = np.bincount(block * classes + read, minlength=blocks.sum() * classes).reshape(-1, classes).astype(np.int32)
        upto = np.cumsum(met, axis=0, dtype=np.int32) - met
        upto -= np.repeat(upto[first], blocks, axis=0)  # read in the blocks of the text before each
        out = np.zeros(upto.shape, np.float32)
        out[1:] = upto[:-1]
        out[first] = 0
        return out

    def _distant(self, own: np.ndarray, pairs: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Weight of each class before the window at each position, before the division by the sum."""
        p = self.params
        far = np.exp(np.maximum(p["f"] - p["r"].max(), -_FAR))
        out = pairs.take(own.reshape(-1), axis=0, out=_room("distant", (own.size, pairs.shape[1]), pairs.dtype), mode="clip")
        spread = out.reshape(*own.shape, -1)
        spread *= (earlier * far).astype(pairs.dtype)[:, None, :]
        return out

    def _tables(self) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """What a read class and a pair of them stand for: query, key and value rows; weights of pairs and of places.

        Classes are few, so the scaled product of every query with every key is one small table, and a weight before its
        division by the sum is an entry of that table's exponentials times that of the distance (0 behind the position).
        """
        p, d = self.params, self.params["q"].shape[0]
        rows = {n: p["e"] @ p[n] for n in "qkv"}
        pairs = rows["q"] @ rows["k"].T * p["q"].dtype.type(d**-0.5)
        near = np.exp(np.maximum(p["r"] - p["r"].max(), -_FAR))
        places = np.where(DISTANCE >= 0, near[np.clip(DISTANCE, 0, None)], 0)
        return rows, np.exp(np.maximum(pairs - pairs.max(1, keepdims=True), -_FAR)), places.astype(p["r"].dtype)

    def _attend(self, window: np.ndarray, opening: np.ndarray, earlier: np.ndarray | None = None):
        rows, pairs, places = self._tables()
        own = window[:, STRIDE:]
        shape = (*own.shape, window.shape[1])
        code = np.add((own.astype(np.intp) * len(pairs))[:, :, None], window[:, None, :], out=_room("code", shape, np.intp))
        weights = pairs.reshape(-1).take(code, out=_room("weights", shape, pairs.dtype), mode="clip")
        weights *= places
        weights[opening, :, :STRIDE] = 0
        mass, distant = np.einsum("bij->bi", weights), None
        if earlier is not None:
            distant = self._distant(own, pairs, earlier)
            mass = mass + (distant @ np.ones(distant.shape[1], distant.dtype)).reshape(own.shape)
            distant /= mass.reshape(-1, 1)
        weights /= mass[:, :, None]
        table = rows["v"]
        values = table.take(window, axis=0, out=_room("values", (*window.shape, table.shape[1]), table.dtype), mode="clip")
        mixed = np.matmul(weights, values, out=_room("mixed", (*own.shape, table.shape[1]), table.dtype))
        mixed = mixed.reshape(own.size, -1)
        if distant is not None:
            mixed += distant @ table
        return rows, own.reshape(-1), code, weights, values, distant, mixed

    def _logits(self, own: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """The read class adds the same row wherever it stands."""
        p, d = self.params, self.params["q"].shape[0]
        shape, kind = (len(own), p["o"].shape[1]), p["o"].dtype
        logits = np.matmul(mixed, p["o"][:d], out=_room("logits", shape, kind))
        logits += (p["u"] @ p["o"][d:] + p["b"]).take(own, axis=0, out=_room("sorted", shape, kind), mode="clip")
        return np.minimum(logits, _LARGE, out=logits) if logits.max(initial=0) > _LARGE else logits

    def log_probs(self, window: np.ndarray, want: np.ndarray, opening: np.ndarray, earlier: np.ndarray | None = None) -> np.ndarray:
        """Natural log probability of the class to predict at every position; 0 at pads."""
        _, own, *_, mixed = self._attend(window, opening, earlier)
        logits = self._logits(own, mixed)
        real = want.reshape(-1) != self.pad
        picked = logits[np.arange(len(logits)), np.where(real, want.reshape(-1), 0)]
        np.exp(logits, out=logits)
        return np.where(real, picked - np.log(logits @ np.ones(logits.shape[1], logits.dtype)), 0).reshape(want.shape)

    def score(self, texts: list[np.ndarray], blocks_at_once: int = 512) -> np.ndarray:
        """log10 probability of each text (ids, the end included)."""
        window, want, opening, blocks = self.windows(texts)
        earlier = self.earlier(texts)
        per_block = np.empty(len(window))
        for lo in range(0, len(window), blocks_at_once):
            part = slice(lo, lo + blocks_at_once)
            per_block[part] = self.log_probs(window[part], want[part], opening[part], _at(earlier, part)).sum(1, dtype=np.float64)
        lengths = [len(t) for t in texts]
        classes = np.add.reduceat(per_block, np.cumsum(blocks) - blocks)
        members = np.add.reduceat(self.within[np.concatenate(texts)], np.cumsum(lengths) - lengths)
        return (classes + members) / np.log(10)

    def gradients(
        self, window: np.ndarray, want: np.ndarray, opening: np.ndarray, earlier: np.ndarray | None = None
    ) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of the classes and its gradients."""
        p, d = self.params, self.params["q"].shape[0]
        rows, own, code, weights, values, distant, mixed = self._attend(window, opening, earlier)
        probs = self._logits(own, mixed)
        real = want.reshape(-1) != self.pad
        n, target, at = max(1, int(real.sum())), np.where(real, want.reshape(-1), 0), np.arange(len(own))
        picked = probs[at, target]
        np.exp(probs, out=probs)
        mass = probs @ np.ones(probs.shape[1], probs.dtype)
        loss = float((np.log(mass) - picked)[real].sum()) / n
        probs *= (real / (n * mass)).astype(probs.dtype)[:, None]
        probs[at, target] -= real.astype(probs.dtype) / probs.dtype.type(n)
        by_class = _summed(probs, own, len(p["u"]))
        g = {"o": np.concatenate([mixed.T @ probs, p["u"].T @ by_class]), "b": by_class.sum(0), "u": by_class @ p["o"][d:].T}
        kind = probs.dtype
        dmixed = np.matmul(probs, p["o"][:d].T, out=_room("dmixed", (len(own), d), kind)).reshape(*weights.shape[:2], d)
        dvalues = np.matmul(weights.transpose(0, 2, 1), dmixed, out=_room("dvalues", values.shape, kind))
        dscores = np.matmul(dmixed, values.transpose(0, 2, 1), out=_room("dscores", weights.shape, kind))
        shared = np.einsum("bij,bij->bi", dscores, weights)
        if distant is not None:
            flat = dmixed.reshape(-1, d)
            ddistant = np.matmul(flat, rows["v"].T, out=_room("ddistant", distant.shape, kind))
            ddistant *= distant
            more = ddistant @ np.ones(ddistant.shape[1], kind)
            shared = shared + more.reshape(shared.shape)
            ddistant -= distant * shared.reshape(-1, 1)
        dscores -= shared[:, :, None]
        dscores *= weights
        g["r"] = np.bincount(np.clip(DISTANCE, 0, None).reshape(-1), (dscores.sum(0) * (DISTANCE >= 0)).reshape(-1), 2 * STRIDE)
        wide = _room("wide", (dscores.size,), np.float64)
        wide[:] = dscores.reshape(-1)
        dpairs = np.bincount(code.reshape(-1), wide, len(p["e"]) ** 2).reshape(len(p["e"]), -1) * d**-0.5
        dv = _summed(dvalues.reshape(-1, d), window.reshape(-1), len(p["e"]))
        if distant is not None:
            dpairs += _summed(ddistant, own, len(p["e"])) * d**-0.5
            dv = dv + distant.T @ flat
            g["f"] = ddistant.sum(dtype=np.float64).reshape(1)
        tables = {"q": dpairs @ rows["k"], "k": dpairs.T @ rows["q"], "v": dv}
        g["e"] = sum(t @ p[n].T for n, t in tables.items())
        for n, t in tables.items():
            g[n] = p["e"].T @ t
        return loss, g

    def fit(self, texts: list[np.ndarray], steps: int = 250, blocks: int = 512, rate: float = 0.02, seed: int = 1) -> list[float]:
        """Steps over blocks drawn at random, with a falling rate."""
        rng = np.random.default_rng(seed)
        window, want, opening, _ = self.windows(texts)
        picks = (rng.integers(0, len(window), blocks) for _ in range(steps))
        return self._descend(window, want, opening, self.earlier(texts), picks, [rate * (1 - 0.9 * step / steps) for step in range(1, steps + 1)])

    def fit_once(self, texts: list[np.ndarray], blocks: int = 512, rate: float = 0.002, seed: int = 1) -> int:
        """One pass over all blocks at a steady rate; returns their number."""
        window, want, opening, _ = self.windows(texts)
        order = np.random.default_rng(seed).permutation(len(window))
        picks = np.array_split(order, -(-len(order) // blocks))
        self._descend(window, want, opening, self.earlier(texts), picks, [rate] * len(picks))
        return len(window)

    def _descend(
        self, window: np.ndarray, want: np.ndarray, opening: np.ndarray, earlier: np.ndarray | None, picks, rates: list[float]
    ) -> list[float]:
        state = self.state
        first, second, losses = np.zeros_like(state), np.zeros_like(state), []
        for step, (pick, now) in enumerate(zip(picks, rates), 1):
            loss, grads = self.gradients(window[pick], want[pick], opening[pick], _at(earlier, pick))
            g = np.concatenate([grads[k].reshape(-1) for k in self.params])
            first = 0.9 * first + 0.1 * g
            second = 0.99 * second + 0.01 * g * g
            m, v = first / (1 - 0.9**step), second / (1 - 0.99**step)
            state = (state - now * m / (np.sqrt(v) + 1e-7)).astype(state.dtype)
            self.params = self.with_state(state).params
            losses.append(loss)
        return losses

    @property
    def state(self) -> np.ndarray:
        """All weights in one row."""
        return np.concatenate([v.reshape(-1) for v in self.params.values()])

    def with_state(self, state: np.ndarray) -> AttentionModel:
        """The same classes with other weights."""
        other, at = copy.copy(self), 0
        other.params = {}
        for k, v in self.params.items():
            other.params[k] = state[at : at + v.size].reshape(v.shape).astype(v.dtype)
            at += v.size
        return other
