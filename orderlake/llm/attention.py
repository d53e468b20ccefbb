"""Causal self-attention over subword symbols in numpy: forward, backward, Adam.

A document is laid out in blocks of SPAN positions.  The queries of a block
attend to the keys of the block and of the one before it, so the context
windows overlap by a block and each symbol is scored once, with SPAN symbols
of context at least (where the document has them).  Output is in two steps:
the class of the next symbol, then the symbol's share of its class from corpus
counts.  A class's logit is the corpus bigram's logarithm plus what the network
adds to it.  Frequent symbols are classes of their own.
"""

from __future__ import annotations

import math

import numpy as np

#: Positions of a block, width of embeddings, width of the hidden layer.
SPAN, WIDTH, HIDDEN = 32, 16, 32
#: Symbols with an embedding of their own (all others share one), classes, and how many of these are single symbols.
ROWS, CLASSES, SINGLE = 4096, 192, 160
#: Blocks of a training step and of a scoring step.
STEP, BATCH = 16, 32
#: Logits and attention scores are held below LIMIT, so their exponentials need no shift.
LIMIT = np.float32(60)
#: Occurrences that a row needs for its own bigrams to weigh as much as the corpus.
SMOOTHER = 20.0
_FAR = np.float32(-1e9)


class Blocks:
    """Documents laid out in blocks: what each position reads (``now``, ``before``), what it predicts (``kind``), and where."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, row_of: np.ndarray, class_of: np.ndarray, start: int):
        counts = -(-lengths // SPAN)
        first = np.cumsum(counts) - counts
        opening = np.cumsum(lengths) - lengths
        self.slot = np.repeat(first * SPAN - opening, lengths)
        self.slot += np.arange(len(ids))
        self.n = int(counts.sum())
        opening = opening[lengths > 0]
        last = row_of.take(ids)
        self.now = np.full(self.n * SPAN, row_of[start], np.int32)
        self.before = self.now.copy()
        for out in (self.now, self.before):  # each symbol's predecessor, then that one's
            last[1:] = last[:-1].copy()
            last[opening] = row_of[start]
            out[self.slot] = last
        self.kind = np.zeros(self.n * SPAN, np.int32)
        self.kind[self.slot] = class_of.take(ids)
        self.real = np.zeros(self.n * SPAN, np.float32)
        self.real[self.slot] = 1
        self.opens = np.zeros(self.n, bool)
        self.opens[first[counts > 0]] = True


def _distance() -> np.ndarray:
    """Distance of each query of a block to the keys of the previous and the own block; -1 for later keys."""
    d = np.arange(SPAN)[:, None] - (np.arange(2 * SPAN)[None, :] - SPAN)
    return np.where(d >= 0, d, -1)


_DIST = _distance()
_LAG = np.maximum(_DIST, 0)
_CAUSAL = np.where(_DIST >= 0, np.float32(0), _FAR).astype(np.float32)
_OPENING = _CAUSAL.copy()
_OPENING[:, :SPAN] = _FAR

SHAPES = {
    "embed": (ROWS + 1, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "near": (2 * SPAN,), "w_now": (WIDTH, HIDDEN), "w_before": (WIDTH, HIDDEN),
    "w_seen": (WIDTH, HIDDEN), "b_hidden": (HIDDEN,), "w_out": (HIDDEN, CLASSES),
}


def bigrams(follows: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Logarithm of each class's probability after each row, from the counts ``follows`` smoothed by the classes' shares."""
    return np.log((follows + SMOOTHER * share) / (follows.sum(axis=1, keepdims=True) + SMOOTHER)).astype(np.float32)


def initial(follows: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
    """First weights.  The network adds to the bigrams, at first nothing.

    Embeddings are the left side of the weighted singular value decomposition
    of the bigrams' log-ratios, so rows of like use start alike; the rest is
    seeded.
    """
    random = np.random.default_rng(11)
    out = {k: (random.standard_normal(s) / math.sqrt(s[0])).astype(np.float32) for k, s in SHAPES.items()}
    n = follows.sum(axis=1, keepdims=True)
    left = np.sqrt(n + 1.0)
    u = np.linalg.svd(left * (bigrams(follows, share) - np.log(share)) * np.sqrt(share), full_matrices=False)[0][:, :WIDTH]
    x = u / left
    scale = np.sqrt((x**2 * n).sum(axis=0) / max(n.sum(), 1.0)) + 1e-9  # entries are about 1 on running text
    out["embed"] = np.clip(x / scale, -4, 4).astype(np.float32)
    out["w_out"] *= np.float32(0.01)
    for k in ("near", "b_hidden"):
        out[k][:] = 0
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES]).astype(float)


def views(values: np.ndarray) -> dict[str, np.ndarray]:
    """The weights as parts of one flat array."""
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = values[at : at + n].reshape(s)
        at += n
    return out


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    return views(values.astype(np.float32))


class Room:
    """Arrays used again at every step; fresh ones of this size would come from the system each time."""

    def __init__(self):
        self.held: dict[tuple, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        key = (name, *shape)
        if key not in self.held:
            self.held[key] = np.empty(shape, np.float32)
        return self.held[key]


_ONES = np.ones(max(2 * SPAN, CLASSES), np.float32)


def _keys(out: np.ndarray, own: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """(blocks, 2 SPAN, WIDTH): the previous block's rows, then the own; ``last`` comes before the first block."""
    out[:, SPAN:] = own
    out[1:, :SPAN] = own[:-1]
    out[0, :SPAN] = 0 if last is None else last
    return out


#: A sum of exponentials below this has none of a logit or score beyond LIMIT.
_SAFE = np.exp(LIMIT) / 2


def forward(w: dict[str, np.ndarray], table: np.ndarray, room: Room, now: np.ndarray, before: np.ndarray, opens: np.ndarray, last: tuple | None = None, limited: bool = True):
    """Logits of the classes at each position (``table``: the bigrams' part), and what the backward pass needs.

    Without ``limited`` nothing is held below LIMIT: that is the same if the sums of the exponentials stay under _SAFE.
    """
    n = len(opens)
    m = n * SPAN
    x, p = w["embed"].take(now, axis=0, out=room("x", m, WIDTH), mode="clip"), w["embed"].take(before, axis=0, out=room("p", m, WIDTH), mode="clip")
    q, k, v = (np.matmul(x, w[c], out=room(c, m, WIDTH)).reshape(n, SPAN, WIDTH) for c in ("query", "key", "value"))
    keys, values = _keys(room("keys", n, 2 * SPAN, WIDTH), k, last and last[0]), _keys(room("values", n, 2 * SPAN, WIDTH), v, last and last[1])
    a = np.matmul(q, keys.transpose(0, 2, 1), out=room("a", n, SPAN, 2 * SPAN))
    a += w["near"][_LAG] + _CAUSAL
    a[opens, :, :SPAN] = _FAR
    if limited:
        np.minimum(a, LIMIT, out=a)
    np.exp(a, out=a)
    mass = a.reshape(m, 2 * SPAN) @ _ONES[: 2 * SPAN]
    mass += np.float32(1e-30)
    seen = np.matmul(a, values, out=room("seen", n, SPAN, WIDTH)).reshape(m, WIDTH)
    seen /= mass[:, None]
    hidden = np.matmul(x, w["w_now"], out=room("hidden", m, HIDDEN))
    hidden += np.matmul(p, w["w_before"], out=room("part", m, HIDDEN))
    hidden += np.matmul(seen, w["w_seen"], out=room("part", m, HIDDEN))
    hidden += w["b_hidden"]
    np.maximum(hidden, 0, out=hidden)
    logits = np.matmul(hidden, w["w_out"], out=room("logits", m, CLASSES))
    logits += table.take(now, axis=0, out=room("table", m, CLASSES), mode="clip")
    if limited:
        np.minimum(logits, LIMIT, out=logits)
    return logits, (x, p, q, keys, values, a, mass, seen, hidden, (k[-1].copy(), v[-1].copy()))


#: exp(x) as a float whose bits are the whole number x * 2^23 / ln 2 + 127 * 2^23: the power of two is joined by straight lines.
_BITS, _ZERO = 2.0**23 / math.log(2), 127 * 2.0**23
_TOP = _ZERO + float(LIMIT) * _BITS
_LEAST = 2.0**23  # the smallest normal float: a share of it still has a logarithm


def _power(a: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Such a power for scaled scores, from no share at all to that of LIMIT."""
    np.clip(a, np.float32(0), np.float32(_TOP), out=a)
    np.copyto(whole, a, casting="unsafe")
    return whole.view(np.float32)


class Scorer:
    """Forward pass for scoring, with ``_power`` in the place of exp in both softmaxes.

    Numerator and normaliser use the same power, so the classes' shares add up
    to one exactly as with exp; it takes an eighth of the time.
    """

    def __init__(self, w: dict[str, np.ndarray], table: np.ndarray, opening: np.ndarray):
        """``opening``: 1 for the classes whose symbols open a word (or end the text), else 0."""
        self.room = Room()
        self.opening = np.stack([np.ones(CLASSES), opening], axis=1).astype(np.float32)
        # What depends on a symbol alone is looked up: its query, key, value, and its parts of the hidden layer.
        self.query = (w["embed"] @ w["query"] * _BITS).astype(np.float32)
        self.key, self.value = w["embed"] @ w["key"], w["embed"] @ w["value"]
        self.now, self.before = w["embed"] @ w["w_now"] + w["b_hidden"], w["embed"] @ w["w_before"]
        self.near = (w["near"][_LAG] * _BITS + _ZERO).astype(np.float32)
        self.near[_DIST < 0] = _FAR * np.float32(_BITS)  # power zero: a later key has no share
        self.w_seen, self.out = w["w_seen"], (w["w_out"] * _BITS).astype(np.float32)
        self.table = (np.maximum(table, -45) * _BITS + _ZERO).astype(np.float32)

    def shares(self, now: np.ndarray, before: np.ndarray, opens: np.ndarray, last: tuple | None) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Unnormalised shares of all classes at each position, their sum and that of the opening ones, and the last block's key and value rows."""
        room, n = self.room, len(opens)
        m = n * SPAN
        q, k, v = (
            t.take(now, axis=0, out=room(name, m, WIDTH), mode="clip").reshape(n, SPAN, WIDTH)
            for name, t in (("query", self.query), ("key", self.key), ("value", self.value))
        )
        keys, values = _keys(room("keys", n, 2 * SPAN, WIDTH), k, last and last[0]), _keys(room("values", n, 2 * SPAN, WIDTH), v, last and last[1])
        a = np.matmul(q, keys.transpose(0, 2, 1), out=room("a", n, SPAN, 2 * SPAN))
        a += self.near
        a[opens, :, :SPAN] = 0
        a = _power(a, room("whole a", n, SPAN, 2 * SPAN).view(np.int32))
        mass = a.reshape(m, 2 * SPAN) @ _ONES[: 2 * SPAN]
        mass += np.float32(1e-30)
        seen = np.matmul(a, values, out=room("seen", n, SPAN, WIDTH)).reshape(m, WIDTH)
        seen /= mass[:, None]
        hidden = self.now.take(now, axis=0, out=room("hidden", m, HIDDEN), mode="clip")
        hidden += self.before.take(before, axis=0, out=room("part", m, HIDDEN), mode="clip")
        hidden += np.matmul(seen, self.w_seen, out=room("part", m, HIDDEN))
        np.maximum(hidden, np.float32(0), out=hidden)
        logits = np.matmul(hidden, self.out, out=room("logits", m, CLASSES))
        logits += self.table.take(now, axis=0, out=room("table", m, CLASSES), mode="clip")
        np.clip(logits, np.float32(_LEAST), np.float32(_TOP), out=logits)  # the logits, not the hidden layer: a well-trained one is large
        whole = room("whole", m, CLASSES).view(np.int32)
        np.copyto(whole, logits, casting="unsafe")
        shares = whole.view(np.float32)
        return shares, shares @ self.opening, (k[-1].copy(), v[-1].copy())

    def log_probs(self, b: Blocks) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms at each position of all blocks: of the predicted class's probability, and of a word's opening there."""
        out, opening, last = np.empty(b.n * SPAN, np.float32), np.empty(b.n * SPAN, np.float32), None
        for at in range(0, b.n, BATCH):
            end = min(at + BATCH, b.n)
            cut = slice(at * SPAN, end * SPAN)
            shares, total, last = self.shares(b.now[cut], b.before[cut], b.opens[at:end], last)
            out[cut] = np.log(shares[np.arange(len(total)), b.kind[cut]] / total[:, 0])
            opening[cut] = np.log(total[:, 1] / total[:, 0])
        return out, opening


def gradient(w: dict[str, np.ndarray], table: np.ndarray, room: Room, now: np.ndarray, before: np.ndarray, kind: np.ndarray, real: np.ndarray, opens: np.ndarray):
    """Sum of losses, number of positions, and the gradient of their mean."""
    loss, total, g, rows = _gradient(w, table, room, now, before, kind, real, opens)
    out = np.zeros(SHAPES["embed"], np.float32)
    out[rows] = g["embed"]
    return loss, total, g | {"embed": out}


def _gradient(w: dict[str, np.ndarray], table: np.ndarray, room: Room, now: np.ndarray, before: np.ndarray, kind: np.ndarray, real: np.ndarray, opens: np.ndarray):
    """As ``gradient``, with the embedding's part for the rows that are read only, and these rows."""
    n, total = len(opens), max(float(real.sum()), 1.0)
    rows = np.arange(n * SPAN)
    for limited in (False, True):  # again with the limit if it may be reached
        with np.errstate(over="ignore", invalid="ignore"):
            logits, (x, p, q, keys, values, a, mass, seen, hidden, _) = forward(w, table, room, now, before, opens, limited=limited)
            chosen = logits[rows, kind]
            np.exp(logits, out=logits)
            z = logits @ _ONES[:CLASSES]
            if z.max() <= _SAFE and mass.max() <= _SAFE:
                break
    loss = float(((np.log(z) - chosen) * real).sum())
    logits *= (real / z / np.float32(total))[:, None]
    logits[rows, kind] -= real / np.float32(total)
    g = {"w_out": hidden.T @ logits}
    dh = np.matmul(logits, w["w_out"].T, out=room("part", len(rows), HIDDEN))
    dh *= hidden > 0
    g |= {"w_now": x.T @ dh, "w_before": p.T @ dh, "w_seen": seen.T @ dh, "b_hidden": dh.sum(axis=0)}
    d = room("d", 2, len(rows), WIDTH)  # of what is read now, and before
    dx = np.matmul(dh, w["w_now"].T, out=d[0])
    np.matmul(dh, w["w_before"].T, out=d[1])
    ds = (dh @ w["w_seen"].T).reshape(n, SPAN, WIDTH)
    a /= mass.reshape(n, SPAN, 1)
    da = np.matmul(ds, values.transpose(0, 2, 1), out=room("da", *a.shape))
    dv = np.matmul(a.transpose(0, 2, 1), ds)
    # The mean of da under the attention is what the position's own output gives.
    da -= (ds.reshape(-1, WIDTH) * seen).sum(axis=1).reshape(n, SPAN, 1)
    da *= a
    g["near"] = np.bincount(_LAG.ravel(), da.sum(axis=0).ravel(), 2 * SPAN).astype(np.float32)
    g["query"] = x.T @ (dq := np.matmul(da, keys).reshape(-1, WIDTH))
    dx += dq @ w["query"].T
    for name, o in (("key", np.matmul(da.transpose(0, 2, 1), q)), ("value", dv)):  # a key belongs to its own block and to the next one's window
        own = o[:, SPAN:].copy()
        own[:-1] += o[1:, :SPAN]
        own = own.reshape(-1, WIDTH)
        g[name] = x.T @ own
        dx += own @ w[name].T
    read, g["embed"] = _by_row(np.concatenate([now, before]), d.reshape(-1, WIDTH))
    return loss, total, g, read


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the embedding table that occur, and the sums of their values."""
    order = np.argsort(rows.astype(np.min_scalar_type(ROWS)), kind="stable")  # numbers of two bytes are sorted by digits
    ranked = rows.take(order)
    starts = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
    starts = np.concatenate([np.zeros(1, starts.dtype), starts])
    return ranked.take(starts), np.add.reduceat(values.take(order, axis=0), starts, axis=0)


class Adam:
    """Weights and their two moments, each one flat array; ``w`` has views of the weights."""

    #: Moments below TINY change nothing; every FLUSH steps they are set to zero, as sums with denormal floats are slow.
    TINY, FLUSH = np.float32(1e-30), 64

    def __init__(self, w: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.x = np.concatenate([w[k].ravel() for k in SHAPES])
        self.m, self.v, self.top, self.low = (np.zeros_like(self.x) for _ in range(4))
        self.w, (self.m_embed, self.v_embed) = views(self.x), (views(x)["embed"] for x in (self.m, self.v))
        self.rest = math.prod(SHAPES["embed"])  # the other weights, which come after the embeddings

    def step(self, g: dict[str, np.ndarray], rows: np.ndarray) -> None:
        """``g["embed"]`` has the gradient of these rows of the embedding table; that of all others is zero."""
        self.t += 1
        scale = np.float32(self.rate * math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
        rest = np.concatenate([g[k].ravel() for k in SHAPES if k != "embed"])
        self.m *= np.float32(0.9)
        self.v *= np.float32(0.99)
        for m, v, at, d in ((self.m_embed, self.v_embed, rows, g["embed"]), (self.m, self.v, slice(self.rest, None), rest)):
            m[at] += np.float32(0.1) * d
            v[at] += np.float32(0.01) * d * d
        np.sqrt(self.v, out=self.low)
        self.low += np.float32(1e-8)
        np.multiply(self.m, scale, out=self.top)
        self.top /= self.low
        self.x -= self.top
        if self.t % self.FLUSH == 0:
            for moment in (self.m, self.v):
                moment[np.abs(moment) < self.TINY] = 0


def learn(adam: Adam, table: np.ndarray, b: Blocks, room: Room | None = None) -> tuple[float, float]:
    """One pass over the blocks in steps of STEP blocks: (sum of losses, positions)."""
    room, loss, seen = room or Room(), 0.0, 0.0
    for at in range(0, b.n, STEP):
        end = min(at + STEP, b.n)
        cut = slice(at * SPAN, end * SPAN)
        opens = b.opens[at:end].copy()
        opens[0] = True  # the block before the step isn't in it
        some, n, g, rows = _gradient(adam.w, table, room, b.now[cut], b.before[cut], b.kind[cut], b.real[cut], opens)
        adam.step(g, rows)
        loss, seen = loss + some, seen + n
    return loss, seen
