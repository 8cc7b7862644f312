"""A causal self-attention language model on subword ids, in numpy: one layer over overlapping windows, added to count tables.

The next id is predicted in two steps, its class and then the id in its class. Class logits are a table of the present
id, from counts over the whole corpus, plus what attention over the ids before it contributes; ids in a class follow counts
given the class of the present id. All tables are probabilities over the whole vocabulary and the end mark.
"""

from __future__ import annotations

import numpy as np

#: Queries of a window, and keys before them; each id is a query of one window only.
STRIDE = 32
CONTEXT = 16
WIDTH = STRIDE + CONTEXT
DIM = 32
#: Ids with a class of their own, and the classes the others share.
SINGLES = 192
SHARED = 32
CLASSES = SINGLES + SHARED
#: Ids with an embedding and a row of class counts of their own; the others use their class's.
SLOTS = 768
#: Ids with counts given the class before them.
TAIL = 3072
#: Strength of the coarser estimate under each count table.
PRIOR = 20.0
#: Windows scored at once; their arrays stay in the processor's cache, and are used again for the next ones.
CHUNK = 48
#: Rows of class probabilities a training step makes at once, for the same reason.
ROWS = 512
#: Exponents that are bounded by this need no row maximum.
SAFE = 60.0


class Vocabulary:
    """Classes and input slots of ids, by their rank in the corpus."""

    def __init__(self, counts: np.ndarray, kinds: np.ndarray):
        """counts: of every id, the end mark last. kinds: a small group number of every id, from the look of its bytes."""
        self.size = len(counts)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(self.size, dtype=np.int64)
        rank[order] = np.arange(self.size)
        band = np.minimum(np.log2(rank / SINGLES + 1).astype(np.int64), 3)
        #: Ids of one look and of about the same rank share a class.
        self.class_of = np.where(rank < SINGLES, rank, SINGLES + (kinds * 4 + band) % SHARED).astype(np.int32)
        self.slot_of = np.where(rank < SLOTS, rank, SLOTS + self.class_of).astype(np.int32)
        self.tail_of = np.where(rank < TAIL, rank, TAIL).astype(np.int32)
        self.share_out(counts)

    def share_out(self, counts: np.ndarray) -> None:
        """Set the share that every id has of its class, from counts of all ids."""
        weight = counts + 0.5
        totals = np.bincount(self.class_of, weights=weight, minlength=CLASSES)
        self.in_class = np.log(weight / totals[self.class_of]).astype(np.float32)


class Counts:
    """Class counts after every slot, and counts of frequent ids after every class."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.next_class = np.zeros(((SLOTS + CLASSES), CLASSES))
        self.next_id = np.zeros((CLASSES, TAIL + 1))

    def add(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """Count a run of texts' ids; `starts` marks places that begin a text, whose pair with the place before is skipped."""
        v = self.vocabulary
        ok = ~starts[1:]
        a, b = ids[:-1][ok], ids[1:][ok]
        pair = v.slot_of[a].astype(np.int64) * CLASSES + v.class_of[b]
        self.next_class += np.bincount(pair, minlength=self.next_class.size).reshape(self.next_class.shape)
        pair = v.class_of[a].astype(np.int64) * (TAIL + 1) + v.tail_of[b]
        self.next_id += np.bincount(pair, minlength=self.next_id.size).reshape(self.next_id.shape)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """log p(class | slot), and log p(id | its class, class before) for frequent ids."""
        v = self.vocabulary
        base = self.next_class.sum(0) + 0.5 * np.bincount(v.class_of, minlength=CLASSES).clip(max=1)
        base /= base.sum()
        # Slots of a class share what is known of the class.
        slot_class = np.zeros(SLOTS + CLASSES, dtype=np.int64)
        slot_class[v.slot_of] = v.class_of
        by_class = np.zeros((CLASSES, CLASSES))
        np.add.at(by_class, slot_class, self.next_class)
        by_class = (by_class + PRIOR * base) / (by_class.sum(1, keepdims=True) + PRIOR)
        after = (self.next_class + PRIOR * by_class[slot_class]) / (self.next_class.sum(1, keepdims=True) + PRIOR)
        # Frequent ids: their share of their class in this place, mixed with their share in all places.
        frequent = np.flatnonzero(v.tail_of < TAIL)
        static = np.zeros(TAIL + 1)
        static[v.tail_of[frequent]] = np.exp(v.in_class[frequent])
        classes = np.zeros(TAIL + 1, dtype=np.int64)
        classes[v.tail_of[frequent]] = v.class_of[frequent]
        totals = np.zeros((CLASSES, CLASSES))
        np.add.at(totals.T, classes[:TAIL], self.next_id.T[:TAIL])
        # What the class's rarer ids hold of it stays theirs: frequent ids share out the rest.
        held = np.bincount(classes[:TAIL], weights=static[:TAIL], minlength=CLASSES)
        within = (self.next_id + PRIOR * static) / (totals[:, classes] + PRIOR * np.maximum(held[classes], 1e-12)) * held[classes]
        return np.log(np.maximum(after, 1e-30)).astype(np.float32), np.log(np.maximum(within, 1e-30)).astype(np.float32)


def starting_weights(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return {
        "embed": normal(SLOTS + CLASSES, DIM, scale=0.5), "q": normal(DIM, DIM, scale=DIM**-0.5), "k": normal(DIM, DIM, scale=DIM**-0.5),
        "v": normal(DIM, DIM, scale=DIM**-0.5), "out": normal(DIM, CLASSES, scale=0.02), "bias": np.zeros(WIDTH, dtype=np.float32),
    }


_QUERY, _KEY = np.arange(STRIDE)[:, None] + CONTEXT, np.arange(WIDTH)[None, :]
_FAR = np.clip(_QUERY - _KEY, 0, WIDTH - 1)
_FUTURE = _KEY > _QUERY


def windows(length: int) -> np.ndarray:
    """Places in a text of `length` inputs, a row a window: CONTEXT keys before the queries, then the queries; outside the text -1."""
    count = -(-length // STRIDE)
    at = np.arange(count)[:, None] * STRIDE - CONTEXT + np.arange(WIDTH)[None, :]
    return np.where((at >= 0) & (at < length), at, -1)


def added_up(rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Sums of rows by their numbers, of which none is left out: a row a number."""
    numbers = numbers.astype(np.min_scalar_type(SLOTS + CLASSES))
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    return np.add.reduceat(rows[order], np.flatnonzero(np.diff(numbers, prepend=-1)), axis=0)


def longest(rows: np.ndarray) -> float:
    """The length of the longest row."""
    return float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0)))


class Rooms:
    """Arrays that are kept and used again: new large arrays cost more than the work done in them."""

    def __init__(self, dtype: np.dtype = np.dtype(np.float32)):
        self.dtype, self.held = dtype, {}

    def __call__(self, name: str, n: int, *shape: int) -> np.ndarray:
        """An array of n rows of this shape."""
        held = self.held.get(name)
        if held is None or len(held) < n:
            held = self.held[name] = np.empty((n, *shape), dtype=self.dtype)
        return held[:n]


class Trainer:
    """Adam on the attention weights; the count tables stay."""

    def __init__(self, weights: dict[str, np.ndarray], vocabulary: Vocabulary, after: np.ndarray, rate: float = 4e-3):
        self.w = {name: w.copy() for name, w in weights.items()}
        self.vocabulary, self.after, self.rate, self.steps = vocabulary, after, rate, 0
        self.m = {name: np.zeros_like(w) for name, w in weights.items()}
        self.s = {name: np.zeros_like(w) for name, w in weights.items()}
        self.room = Rooms(weights["embed"].dtype)

    def step(self, inputs: np.ndarray, targets: np.ndarray, valid: np.ndarray) -> float:
        """One batch of windows: input slots (n, WIDTH), target classes of the queries (n, STRIDE), which inputs are text.

        Queries, keys and values are rows of tables of the slots met, made once a step.
        """
        w, kind, room, n = self.w, self.w["embed"].dtype.type, self.room, len(inputs)
        scale = kind(DIM**-0.5)
        met = np.zeros(SLOTS + CLASSES, dtype=bool)
        met[inputs] = True
        slots, numbers = np.flatnonzero(met), (np.cumsum(met) - 1)[inputs]
        embed, queries = w["embed"][slots], inputs[:, CONTEXT:]
        joined = np.concatenate((w["k"], w["v"], w["q"] * scale), axis=1)
        table = embed @ joined
        held = np.take(table, numbers, axis=0, out=room("held", n, WIDTH, 3 * DIM), mode="clip")
        k, v, q = held[:, :, :DIM], held[:, :, DIM:-DIM], held[:, CONTEXT:, -DIM:]
        shares = np.matmul(q, k.transpose(0, 2, 1), out=room("shares", n, STRIDE, WIDTH))
        shares += np.where(_FUTURE, kind(-1e4), w["bias"][_FAR])
        odd = np.flatnonzero(~valid.all(axis=1))
        if len(odd):
            shares[odd] += np.where(valid[odd], kind(0), kind(-1e4))[:, None, :]
        # Lengths bound all products; only where exponentials might overflow are they taken from a row's largest.
        if not longest(table[:, :DIM]) * longest(table[:, -DIM:]) + np.abs(w["bias"]).max() < SAFE:
            shares -= shares.max(axis=2, keepdims=True)
        np.exp(shares, out=shares)
        # Shares are divided by their sums where that takes fewest products: in outputs, and in the gradients of outputs.
        part = 1 / np.maximum(shares @ np.ones(WIDTH, dtype=kind), kind(1e-30))[:, :, None]
        h = np.matmul(shares, v, out=room("h", n, STRIDE, DIM))
        h *= part
        dh = room("dh", n, STRIDE, DIM)
        dh.fill(0)
        loss, grads = self._classes(h.reshape(-1, DIM), dh.reshape(-1, DIM), queries.ravel(), targets.ravel(), np.flatnonzero(valid[:, CONTEXT:]))
        dh *= part
        dscore = np.matmul(dh, v.transpose(0, 2, 1), out=room("dscore", n, STRIDE, WIDTH))
        dscore -= np.einsum("nij,nij->ni", dh, h)[:, :, None]
        dscore *= shares
        grads["bias"] = np.bincount(_FAR.ravel(), weights=np.where(_FUTURE, 0, dscore.sum(axis=0)).ravel(), minlength=WIDTH).astype(kind)
        d = room("d", n, WIDTH, 3 * DIM)
        np.matmul(dscore.transpose(0, 2, 1), q, out=d[:, :, :DIM])
        np.matmul(shares.transpose(0, 2, 1), dh, out=d[:, :, DIM:-DIM])
        np.matmul(dscore, k, out=d[:, CONTEXT:, -DIM:])
        d[:, :CONTEXT, -DIM:] = 0
        d = d.reshape(-1, 3 * DIM)
        own = np.take(embed, numbers, axis=0, out=room("own", n, WIDTH, DIM), mode="clip").reshape(-1, DIM)
        grads["k"], grads["v"], grads["q"] = np.split(own.T @ d, 3, axis=1)
        grads["q"] = grads["q"] * scale
        grads["embed"] = np.zeros_like(w["embed"])
        # A place's gradient is summed over its uses first, and added up by slot then.
        grads["embed"][slots] = added_up(np.matmul(d, joined.T, out=own), numbers.ravel())
        self.steps += 1
        rate = self.rate * (1 - 0.98**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        for name, g in grads.items():
            m, s = self.m[name], self.s[name]
            m *= kind(0.9)
            m += kind(0.1) * g
            s *= kind(0.98)
            s += kind(0.02) * g * g
            w[name] -= kind(rate) * m / (np.sqrt(s) + kind(1e-8))
        return loss

    def _classes(self, h: np.ndarray, dh: np.ndarray, slots: np.ndarray, wanted: np.ndarray, real: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the real rows and gradient of `out`; the gradient of h goes into dh. Class probabilities are made ROWS rows at a time."""
        out, kind, n = self.w["out"], h.dtype.type, max(1, len(real))
        total, grad, ones = 0.0, np.zeros_like(out), np.ones(CLASSES, dtype=kind)
        back, safe, whole = np.ascontiguousarray(out.T), longest(h) * longest(out.T) < SAFE, len(real) == len(h)
        for start in range(0, len(real), ROWS):
            rows = slice(start, start + ROWS) if whole else real[start : start + ROWS]
            hs, to = h[rows], wanted[rows]
            p, table, at = self.room("p", len(hs), CLASSES), self.room("after", len(hs), CLASSES), np.arange(len(hs))
            np.matmul(hs, out, out=p)
            p += np.take(self.after, slots[rows], axis=0, out=table, mode="clip")
            if not safe:
                p -= p.max(axis=1, keepdims=True)
            total -= p[at, to].sum(dtype=np.float64)
            np.exp(p, out=p)
            sums = p @ ones
            total += np.log(sums).sum(dtype=np.float64)
            p[at, to] -= sums
            # Probabilities are divided by their sums where that takes fewest products.
            part = (1 / (sums * kind(n)))[:, None]
            grad += (hs * part).T @ p
            dh[rows] = (p @ back) * part
        return float(total / n), {"out": grad}

    def run(self, texts: list[np.ndarray], least: int = 0, batch: int = 32, group: int = 16_384) -> int:
        """Train on the windows of texts (ids, from the end mark before the text to the one behind it); returns their number.

        Texts are gone over again until `least` windows are done. The rate falls to a twentieth on the way.
        """
        parts = [ids[i : i + group + 1] for ids in texts for i in range(0, len(ids) - 1, group)]
        total = sum(-(-(len(p) - 1) // STRIDE) for p in parts)
        if not total:
            return 0
        passes, top, done = max(1, -(-least // total)), self.rate, 0
        for turn in range(passes):
            order = np.random.default_rng(turn).permutation(len(parts))
            start = 0
            while start < len(order):
                held, size = [], 0
                while start < len(order) and size < group:
                    held.append(window_arrays(self.vocabulary, parts[order[start]]))
                    size += len(held[-1][0])
                    start += 1
                inputs, targets, _, valid = (np.concatenate(x) for x in zip(*held))
                mixed = np.random.default_rng(done).permutation(size)
                for first in range(0, size, batch):
                    at = mixed[first : first + batch]
                    self.rate = top * max(0.05, 1 - done / (total * passes))
                    self.step(inputs[at], targets[at], valid[at])
                    done += len(at)
        self.rate = top
        return total


def window_arrays(v: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Input slots, target classes, target ids and validity of a text's windows; the last id is a target only."""
    at = windows(len(ids) - 1)
    valid = at >= 0
    held = np.maximum(at, 0)
    wanted = ids[held[:, CONTEXT:] + 1]
    return v.slot_of[ids[held]], v.class_of[wanted], wanted, valid


class Model:
    """Everything needed to score texts: a few MB, whatever the corpus."""

    def __init__(self, vocabulary: Vocabulary, after: np.ndarray, within: np.ndarray, weights: dict[str, np.ndarray]):
        self.vocabulary, self.after, self.within, self.out = vocabulary, after, within, weights["out"]
        self.q, self.k, v = (weights["embed"] @ weights[name] for name in "qkv")
        self.q = self.q * np.float32(DIM**-0.5)
        # A column of ones makes attention return the sum of its shares beside their weighted values.
        self.v = np.concatenate((v, np.ones((len(v), 1), dtype=np.float32)), axis=1)
        self.mask = np.where(_FUTURE, np.float32(-1e4), weights["bias"][_FAR])
        self._room = Rooms()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_room": Rooms()}

    def log_probabilities(self, texts: list[np.ndarray], chunk: int = CHUNK) -> list[float]:
        """Natural log probability of each text's ids after the first; each id is scored once, with CONTEXT ids or more before it if there are."""
        sizes = np.array([-(-max(0, len(ids) - 1) // STRIDE) for ids in texts], dtype=np.int64)
        totals = np.zeros(len(texts))
        owner = np.repeat(np.arange(len(texts)), sizes)
        if not len(owner):
            return totals.tolist()
        v, flat = self.vocabulary, np.concatenate(texts)
        slots, classes, tails, rare = v.slot_of[flat], v.class_of[flat], v.tail_of[flat], v.in_class[flat]
        lengths = np.array([len(ids) for ids in texts], dtype=np.int64)
        first = (np.cumsum(lengths) - lengths)[owner]
        number = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
        for start in range(0, len(owner), chunk):
            part = slice(start, start + chunk)
            at = (number[part] * STRIDE - CONTEXT)[:, None] + np.arange(WIDTH)[None, :]
            valid = (at >= 0) & (at < lengths[owner[part], None] - 1)
            at = np.where(valid, at, 0) + first[part, None]
            found = self._score(at, valid, slots, classes, tails, rare)
            totals += np.bincount(owner[part], weights=found, minlength=len(texts))
        return totals.tolist()

    def _score(self, at: np.ndarray, valid: np.ndarray, slots: np.ndarray, classes: np.ndarray, tails: np.ndarray, rare: np.ndarray) -> np.ndarray:
        n, held = len(at), slots[at]
        queries = held[:, CONTEXT:]
        q = np.take(self.q, queries, axis=0, out=self._room("q", n, STRIDE, DIM), mode="clip")
        k = np.take(self.k, held, axis=0, out=self._room("k", n, WIDTH, DIM), mode="clip")
        v = np.take(self.v, held, axis=0, out=self._room("v", n, WIDTH, DIM + 1), mode="clip")
        scores = np.matmul(q, k.transpose(0, 2, 1), out=self._room("scores", n, STRIDE, WIDTH))
        scores += self.mask
        odd = np.flatnonzero(~valid.all(axis=1))
        if len(odd):
            scores[odd] += np.where(valid[odd], np.float32(0), np.float32(-1e4))[:, None, :]
        np.exp(scores, out=scores)
        h = np.matmul(scores, v, out=self._room("h", n, STRIDE, DIM + 1)).reshape(-1, DIM + 1)
        # Queries outside the text have no keys at all.
        h = h[:, :-1] / np.maximum(h[:, -1:], np.float32(1e-30))
        logits = np.matmul(h, self.out, out=self._room("logits", n, STRIDE, CLASSES).reshape(-1, CLASSES))
        logits += np.take(self.after, queries.ravel(), axis=0, out=self._room("after", n, STRIDE, CLASSES).reshape(-1, CLASSES), mode="clip")
        now = at[:, CONTEXT:].ravel()
        wanted = classes[now + 1]
        picked = logits[np.arange(len(logits)), wanted]
        np.exp(logits, out=logits)
        lp = picked - np.log(logits @ np.ones(CLASSES, dtype=np.float32))
        tail = tails[now + 1]
        lp += np.where(tail < TAIL, self.within[classes[now], tail], rare[now + 1])
        return np.where(valid[:, CONTEXT:], lp.reshape(n, STRIDE), 0).sum(axis=1, dtype=np.float64)
