"""A gated recurrent word model in numpy: truncated backpropagation, class-factored softmax.

An entry is a frequent word, the end of a text, or a class of all other words. The softmax is
factored: first the class of the entry, then the entry among the ``WIDTH`` of its class. Entries are
numbered by falling frequency. Classes beyond the first ``HEADS`` are reached in one step more: ``SPAN`` of them
form a block, and the first softmax is over classes and blocks, so it grows by one place for ``SPAN * WIDTH`` entries.
Classes of other words have one entry; the word within such a class is the caller's matter.
A window touches few of the rare entries, and only what it touched is updated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN = 16
WIDTH = 32  # entries of a class with several
HEADS = 32  # classes that the first softmax holds themselves
SPAN = 64  # classes of a block
LANES = 1024  # texts or stretches that run side by side in training
CHUNK = 4096  # rows of a softmax at a time, so that they stay in a core's cache
WINDOW = 16  # steps of truncated backpropagation
STRETCH = 32  # steps scored at a time
RATE, SPARSE_RATE = 0.02, 0.1  # of the dense parameters, of the rows of the others
_GATHERED = 4096  # classes whose weights are gathered at a time
CLIP = 1.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _exp(x: np.ndarray) -> np.ndarray:
    """exp of ``x``, in place; each row may have a factor of its own, which keeps it within single precision."""
    if x.size and x.max() > 60.0:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def softmax(x: np.ndarray) -> np.ndarray:
    x = _exp(x - x.max(axis=1, keepdims=True))
    x /= x.sum(axis=1, keepdims=True)
    return x


def errors(x: np.ndarray, at: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What the logits ``x`` (overwritten) of each row miss: its softmax less one at the place ``at``, times ``share``."""
    _exp(x)
    total = x.sum(axis=1)
    if not total.all():  # every exp of a row has become 0
        raise FloatingPointError("the model's logits have left single precision")
    x *= (share / total)[:, None]
    x[np.arange(len(x)), at] -= share
    return x


def log_picked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row of ``x`` (overwritten) at one place."""
    if x.size and (x.max() > 60.0 or x.max(axis=1).min() < -60.0):
        x -= x.max(axis=1, keepdims=True)
    picked = x[np.arange(len(x)), at]
    return picked - np.log(np.exp(x, out=x).sum(axis=1))


class Gradients(dict):
    """A gradient for each parameter; ``rows`` names the rows that can differ from zero, for the large ones."""

    def __init__(self):
        super().__init__()
        self.rows: dict[str, np.ndarray] = {}


class Gru:
    """``entries`` entries lie in classes of ``WIDTH``; ``others`` further classes have one entry each.

    Entry ids: 0 to entries - 1, then the classes of other words. Places of the first softmax: the
    first classes, the classes of other words, the blocks.
    """

    SPARSE = ("inputs", "words", "word_bias")

    def __init__(self, entries: int, others: int, seed: int = 7):
        self.entries, self.others = entries, others
        self.groups = -(-entries // WIDTH)
        self.heads = min(self.groups, HEADS)
        self.blocks = -(-(self.groups - self.heads) // SPAN)
        count, h = self.heads + others + self.blocks, HIDDEN
        rng = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        self.p = {
            "inputs": small(entries + others + 1, 3 * h),  # the last row begins a text
            "gates": small(h, 2 * h),
            "candidate": small(h, h),
            "classes": small(h, count),
            "class_bias": np.zeros(count, np.float32),
            "words": small(self.groups, h, WIDTH),
            "word_bias": np.zeros((self.groups, WIDTH), np.float32),
        }
        if self.blocks:
            self.p["blocks"] = small(self.blocks, h, SPAN)
            self.p["block_bias"] = np.zeros((self.blocks, SPAN), np.float32)
            self.p["block_bias"].reshape(-1)[self.groups - self.heads :] = -30.0
        self.SHAPES = tuple(self.p)
        pad = self.groups * WIDTH - entries
        if pad:
            self.p["word_bias"][-1, WIDTH - pad :] = -30.0
        self.begin = entries + others
        self._g = Gradients()

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        """The place of an entry in the first softmax."""
        group = ids // WIDTH
        inside = np.where(group < self.heads, group, (group - self.heads) // SPAN + self.heads + self.others)
        return np.where(ids < self.entries, inside, ids - self.entries + self.heads)

    def start_at(self, counts: np.ndarray) -> None:
        """Biases that give each entry its share of ``counts``: the model begins as a unigram model."""
        counts = counts.astype(np.float64) + 0.5
        sums = np.bincount(self.class_of(np.arange(len(counts))), counts)
        self.p["class_bias"][:] = np.log(sums / sums.sum())
        inside = np.full(self.groups * WIDTH, np.exp(-30.0))
        inside[: self.entries] = counts[: self.entries]
        inside = inside.reshape(self.groups, WIDTH)
        totals = inside.sum(axis=1)
        self.p["word_bias"][:] = np.log(inside / totals[:, None])
        if self.blocks:
            shares = np.full(self.blocks * SPAN, np.exp(-30.0))
            shares[: self.groups - self.heads] = totals[self.heads :]
            shares = shares.reshape(self.blocks, SPAN)
            self.p["block_bias"][:] = np.log(shares / shares.sum(axis=1)[:, None])

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in self.SHAPES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.SHAPES:
            size = self.p[name].size
            self.p[name] = flat[at : at + size].reshape(self.p[name].shape).astype(np.float32)
            at += size

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        x = self.p["inputs"][ids]
        zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ self.p["gates"])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        rh = r * h
        c = np.tanh(x[:, 2 * HIDDEN :] + rh @ self.p["candidate"])
        return h + z * (c - h), (ids, h, z, r, rh, c)

    def log_prob(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log of each entry's probability after the states ``h``."""
        kind = self.class_of(ids)
        out = np.empty(len(h), h.dtype)
        for low in range(0, len(h), CHUNK):
            part = slice(low, low + CHUNK)
            x = h[part] @ self.p["classes"]
            x += self.p["class_bias"]
            out[part] = log_picked(x, kind[part])
        group, heads, blocks, tail = self._parts(ids)
        for at, rows in heads:
            inside = h[rows] @ self.p["words"][at] + self.p["word_bias"][at]
            out[rows] += log_picked(inside, ids[rows] % WIDTH)
        for at, rows in blocks:
            inside = h[rows] @ self.p["blocks"][at] + self.p["block_bias"][at]
            out[rows] += log_picked(inside, (group[rows] - self.heads) % SPAN)
        for mine, rows, real in self._alike(group, tail):
            inside = h[rows] @ self.p["words"][mine] + self.p["word_bias"][mine][:, None]
            rows = rows[real]
            out[rows] += log_picked(inside[real], ids[rows] % WIDTH)
        return out

    def _parts(self, ids: np.ndarray) -> tuple[np.ndarray, list, list, np.ndarray]:
        """(class of each entry, first classes met and their rows, blocks met and theirs, rows of all blocks
        in the order of their classes)."""
        group = np.where(ids < self.entries, ids // WIDTH, self.groups)
        order = np.argsort(group, kind="stable")
        ends = np.append(np.arange(self.heads), np.minimum(self.heads + SPAN * np.arange(self.blocks + 1), self.groups))
        cuts = np.searchsorted(group[order], ends)
        parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        heads = [(at, rows) for at, rows in enumerate(parts[: self.heads]) if len(rows)]
        blocks = [(at, rows) for at, rows in enumerate(parts[self.heads :]) if len(rows)]
        return group, heads, blocks, order[cuts[self.heads] : cuts[-1]]

    def _alike(self, group: np.ndarray, tail: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(classes, their rows, which are real): classes of about as many rows, filled up to one number.

        Numbers of rows go up by powers of two, so at most half of the places are filled up.
        """
        found = group[tail]
        first = np.flatnonzero(np.append(len(tail) > 0, np.diff(found) != 0)[: len(tail)])
        many = np.diff(np.append(first, len(tail)))
        size = np.ceil(np.log2(many)).astype(int)
        for power in np.unique(size):
            alike = np.flatnonzero(size == power)
            for low in range(0, len(alike), _GATHERED):
                some = alike[low : low + _GATHERED]
                place = np.arange(1 << power)
                real = place < many[some][:, None]
                yield found[first[some]], tail[first[some][:, None] + np.where(real, place, 0)], real

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of whole texts of entry ids; the state runs from first to last."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        total = np.zeros(len(texts))
        self._held = None  # another list can have the place of one that is gone
        for low in range(0, len(texts), 1024):
            rows, sizes = order[low : low + 1024], lengths[low : low + 1024]
            h = np.zeros((len(rows), HIDDEN), np.float32)
            last = np.full(len(rows), self.begin)
            for at in range(0, int(sizes.max(initial=0)), STRETCH):
                states, wanted, owner = [], [], []
                for step in range(at, min(at + STRETCH, int(sizes[0]))):
                    live = int(np.searchsorted(-sizes, -step, side="left"))  # sizes fall
                    h = self.step(last[:live], h[:live])[0]
                    last = self._column(texts, rows, step, live, at)
                    states.append(h)
                    wanted.append(last)
                    owner.append(rows[:live])
                found = self.log_prob(np.concatenate(states), np.concatenate(wanted))
                total += np.bincount(np.concatenate(owner), found, len(texts))
        return total

    _held: tuple | None = None

    def _column(self, texts: list[np.ndarray], rows: np.ndarray, step: int, live: int, at: int) -> np.ndarray:
        """The ids at ``step`` of the first ``live`` rows, from a window cut once."""
        if self._held is None or self._held[0] != (id(texts), int(rows[0]), at):
            cut = np.zeros((live, STRETCH), np.int64)
            for k in range(live):
                part = texts[rows[k]][at : at + STRETCH]
                cut[k, : len(part)] = part
            self._held = ((id(texts), int(rows[0]), at), cut)
        return self._held[1][:live, step - at]

    def train(self, stream: np.ndarray, starts: np.ndarray, optimiser: Adam) -> None:
        """One pass over ``stream``: texts end to end, ``starts`` marking first entries.

        The stream is cut into lanes that run side by side; the state is carried from window to
        window and set to zero where a text starts.
        """
        lanes = max(1, min(LANES, len(stream) // (64 * WINDOW)))  # at least 64 windows
        length = -(-len(stream) // lanes)
        pad = lanes * length - len(stream)
        ids = np.append(stream, np.zeros(pad, stream.dtype)).reshape(lanes, length)
        first = np.append(starts, np.ones(pad, bool)).reshape(lanes, length)
        counted = np.append(np.ones(len(stream), bool), np.zeros(pad, bool)).reshape(lanes, length)
        before = np.concatenate([np.full((lanes, 1), self.begin, ids.dtype), ids[:, :-1]], axis=1)
        before[first] = self.begin
        h = np.zeros((lanes, HIDDEN), np.float32)
        for at in range(0, length, WINDOW):
            part = slice(at, min(at + WINDOW, length))
            h = self._window(before[:, part], ids[:, part], first[:, part], counted[:, part], h, optimiser)

    def _window(self, before, ids, first, counted, h, optimiser) -> np.ndarray:
        p, steps, lanes = self.p, ids.shape[1], len(ids)
        kept, states = [], []
        for t in range(steps):
            h = h * ~first[:, t, None]
            h, saved = self.step(before[:, t], h)
            kept.append(saved)
            states.append(h)
        weight = counted.T.reshape(-1)
        n = max(1, int(weight.sum()))
        flat, wanted = np.concatenate(states), ids.T.reshape(-1)
        g = self._g
        for name, v in p.items():
            if name in g and name in self.SPARSE:
                g[name][g.rows[name]] = 0.0
            else:
                g[name] = np.zeros_like(v)
        kind = self.class_of(wanted)
        share = (weight / n).astype(np.float32)
        dh_out = np.empty_like(flat)
        for low in range(0, len(flat), CHUNK):
            part = slice(low, low + CHUNK)
            d = flat[part] @ p["classes"]
            d += p["class_bias"]
            errors(d, kind[part], share[part])
            g["classes"] += flat[part].T @ d
            g["class_bias"] += d.sum(axis=0)
            np.matmul(d, p["classes"].T, out=dh_out[part])
        group, heads, blocks, tail = self._parts(wanted)

        def inside(rows: np.ndarray, at: int, weights: str, bias: str, place: np.ndarray) -> None:
            x = flat[rows]
            d = x @ p[weights][at]
            d += p[bias][at]
            errors(d, place, share[rows])
            g[weights][at], g[bias][at] = x.T @ d, d.sum(axis=0)
            dh_out[rows] += d @ p[weights][at].T

        for at, rows in heads:
            inside(rows, at, "words", "word_bias", wanted[rows] % WIDTH)
        for at, rows in blocks:
            inside(rows, at, "blocks", "block_bias", (group[rows] - self.heads) % SPAN)
        for mine, rows, real in self._alike(group, tail):
            x, matrix = flat[rows], p["words"][mine]
            d = x @ matrix
            d += p["word_bias"][mine][:, None]
            errors(d.reshape(-1, WIDTH), wanted[rows.reshape(-1)] % WIDTH, (share[rows] * real).reshape(-1))
            g["words"][mine], g["word_bias"][mine] = x.transpose(0, 2, 1) @ d, d.sum(axis=1)
            dh_out[rows[real]] += (d @ matrix.transpose(0, 2, 1))[real]
        met = np.zeros(self.groups + 1, bool)
        met[group] = True
        g.rows["words"] = g.rows["word_bias"] = np.flatnonzero(met[:-1])
        dh_out = dh_out.reshape(steps, lanes, HIDDEN)
        dh, dx = np.zeros((lanes, HIDDEN), np.float32), np.zeros((steps, lanes, 3 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            _, prior, z, r, _, c = kept[t]
            dh += dh_out[t]
            dz, dr, dc = dx[t, :, :HIDDEN], dx[t, :, HIDDEN : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :]
            rest = 1 - z
            np.multiply(dh * z, 1 - c * c, out=dc)
            drh = dc @ p["candidate"].T
            np.multiply(dh * (c - prior), z * rest, out=dz)
            np.multiply(drh * prior, r * (1 - r), out=dr)
            dh = dh * rest + drh * r + dx[t, :, : 2 * HIDDEN] @ p["gates"].T
            dh *= ~first[:, t, None]
        dx = dx.reshape(-1, 3 * HIDDEN)
        g["candidate"] = np.concatenate([k[4] for k in kept]).T @ dx[:, 2 * HIDDEN :]
        g["gates"] = np.concatenate([k[1] for k in kept]).T @ dx[:, : 2 * HIDDEN]
        used = before.T.reshape(-1)
        order = np.argsort(used, kind="stable")
        marks = np.flatnonzero(np.append(True, np.diff(used[order]) != 0))
        g.rows["inputs"] = used[order][marks]
        g["inputs"][g.rows["inputs"]] = np.add.reduceat(dx[order], marks, axis=0)
        optimiser.update(p, g)
        return h


class Adam:
    """Adam for the dense parameters. A parameter with named rows is changed in those rows only, each by its
    gradient over the root of its summed mean squares (Adagrad by rows)."""

    def __init__(self, rate: float = RATE, sparse_rate: float = SPARSE_RATE):
        self.rate, self.sparse_rate, self.t, self.m, self.v = rate, sparse_rate, 0, {}, {}

    def update(self, p: dict[str, np.ndarray], g: Gradients) -> None:
        self.t += 1
        grads = {name: grad[g.rows[name]] if name in g.rows else grad for name, grad in g.items()}
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in grads.values()))
        scale = np.float32(min(1.0, CLIP / (norm + 1e-12)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for name, grad in grads.items():
            grad *= scale
            if name in g.rows:
                at, flat = g.rows[name], grad.reshape(len(grad), -1)
                v = self.v.setdefault(name, np.zeros(len(p[name]), np.float32))
                v[at] += np.einsum("ij,ij->i", flat, flat) / flat.shape[1]
                flat *= (np.float32(self.sparse_rate) / (np.sqrt(v[at]) + np.float32(1e-8)))[:, None]
                p[name][at] -= grad
                continue
            if name not in self.m:
                self.m[name], self.v[name] = np.zeros_like(grad), np.zeros_like(grad)
            m, v = self.m[name], self.v[name]
            m += np.float32(0.1) * (grad - m)
            grad *= grad
            v += np.float32(0.001) * (grad - v)
            p[name] -= rate * m / (np.sqrt(v) + np.float32(1e-8))
