"""A causal self-attention language model over subword ids in numpy: forward pass, gradients, Adam steps and scoring.

Places see the embeddings of their subword and of the one before it. One attention layer with a learned bias per
distance mixes the places of a window; a tanh layer leads to the output. The output is a softmax in two levels: the most
frequent subwords and one entry per group of others share the first one, the subwords of a group the second. Subwords
behind the ``ROWS`` most frequent ones have one input row in common, and their shares within the last group follow their
counts. So every subword has a probability, and the probabilities of all subwords sum to one.
"""

from __future__ import annotations

import ctypes

import numpy as np

#: Places of a window; places that a scoring window adds (the rest is context); widths of the embeddings and of the keys.
WINDOW, STRIDE, WIDTH, KEYS = 64, 32, 32, 16
#: Subwords with rows and outputs of their own, and what reaching a group costs next to one output.
ROWS, GROUP_COST = 4096, 60
#: Exponents that are safe in 32-bit floats, sums over a row included.
_SAFE = 80.0
_SCALE = np.float32(1 / np.sqrt(KEYS))
_DISTANCE = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_PAST = (_DISTANCE >= 0).astype(np.float32)
_DISTANCE = np.maximum(_DISTANCE, 0)
#: Places whose shares are computed at once: a block sees the places up to its end and none behind it.
BLOCK = 32
#: Logits of the output layer held at once, so that they stay in the processor's cache.
_LOGITS = 1 << 18
#: Rows that a product takes at once, rows from which on it does so, and weights that an Adam step takes at once.
_ROWS_AT_ONCE, _MANY_ROWS, _WEIGHTS_AT_ONCE = 128, 512, 1 << 14
_EMBEDDINGS = ("now", "before")
#: Settings of glibc's allocator (trim threshold, top padding, threshold of mappings) and their values.
_HEAP = ((-1, 64 << 20), (-2, 16 << 20), (-3, 8 << 20))


def keep_pages() -> None:
    """Let this process keep up to 64 MB of freed memory.

    Every step takes and frees arrays of about a megabyte. By default their pages go back to the system each time, and
    getting them again, zeroed, takes as long as a third of the arithmetic. Without glibc nothing happens.
    """
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)
    for name, value in _HEAP if set_option else ():
        set_option(name, value)


def group_edges(share: np.ndarray, rows: int) -> list[int]:
    """Edges of the output groups over ranks below ``rows``, with the least expected work per token.

    The first edge ends the first softmax. ``share``: shares by rank.
    """
    at = sorted({min(rows, round(2 ** (k / 2))) for k in range(8, 64)} | {rows})
    below = np.concatenate([[0.0], np.cumsum(share)])
    best = {rows: (0.0, [rows])}  # edge: cost of all groups from here on, edges
    for i in range(len(at) - 2, -1, -1):
        a = at[i]
        best[a] = min((6 + (below[b] - below[a]) * (b - a + GROUP_COST) + best[b][0], [a, *best[b][1]]) for b in at[i + 1 :])
    return min((a + best[a][0], best[a][1]) for a in at)[1]


class Vocabulary:
    """Subwords ranked by count, the edges of their output groups, and the log shares that training starts from."""

    def __init__(self, counts: np.ndarray, smooth: float = 0.1):
        n = len(counts)
        self.order = np.argsort(-counts, kind="stable")
        self.rank = np.empty(n, np.int32)
        self.rank[self.order] = np.arange(n, dtype=np.int32)
        share = (counts + smooth)[self.order]
        share = share / share.sum()
        self.rows = min(ROWS, n)
        self.row = np.minimum(self.rank, self.rows).astype(np.uint16)  # the row behind the last is everyone else's
        edges = group_edges(share, self.rows)
        self.head, self.groups = edges[0], list(zip(edges[:-1], edges[1:], strict=True))
        #: Groups with outputs of their own; a last one beyond ROWS follows counts.
        self.learned = list(self.groups)
        if n > self.rows:
            self.groups.append((self.rows, n))
        mass = np.array([share[a:b].sum() for a, b in self.groups])
        within = [np.log(share[a:b] / share[a:b].sum()) for a, b in self.learned]
        self.bias = np.concatenate([np.log(np.concatenate([share[: self.head], mass])), *within]).astype(np.float32)
        self.rest = np.log(share[self.rows :] / share[self.rows :].sum()) if n > self.rows else None

    @property
    def first(self) -> int:
        """Width of the first softmax."""
        return self.head + len(self.groups)

    def shapes(self) -> dict[str, tuple[int, ...]]:
        r, d = self.rows + 1, WIDTH
        return {"now": (r, d), "before": (r, d), "qkv": (d, 2 * KEYS + d), "near": (WINDOW,), "mix": (d, d), "join": (d, d), "out": ((d + 1) * len(self.bias),)}

    def columns(self) -> list[tuple[int, int]]:
        """Where the outputs of the first softmax and of each learned group stand."""
        at, out = self.first, [(0, self.first)]
        for a, b in self.learned:
            out.append((at, at + b - a))
            at += b - a
        return out


def unflatten(flat: np.ndarray, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def start_weights(vocabulary: Vocabulary, seed: int = 0) -> np.ndarray:
    """Random weights in one vector; the last row of the output starts at the log shares, near places are favoured a little."""
    rng, shapes = np.random.default_rng(seed), vocabulary.shapes()
    flat = np.zeros(sum(int(np.prod(s)) for s in shapes.values()), np.float32)
    w = unflatten(flat, shapes)
    for name, scale in (("now", 0.2), ("before", 0.2), ("qkv", 0.3), ("mix", 0.18), ("join", 0.18)):
        w[name][:] = rng.normal(0, scale, shapes[name])
    w["near"][:] = -0.05 * np.arange(WINDOW)
    out = rng.normal(0, 0.05, (WIDTH + 1, len(vocabulary.bias)))
    out[-1] = vocabulary.bias
    for layer, (a, b) in zip(_layers(w, vocabulary), vocabulary.columns(), strict=True):
        layer[:] = out[:, a:b]
    return flat


def bounded(w: dict, vocabulary: Vocabulary) -> bool:
    """Whether no exponential of these weights can overflow, whatever the text."""
    outputs = max(np.abs(layer).sum(axis=0).max() for layer in _layers(w, vocabulary))
    reach = [sum(float(np.sqrt(((w[e] @ w["qkv"][:, part]) ** 2).sum(axis=1).max())) for e in _EMBEDDINGS) for part in (slice(0, KEYS), slice(KEYS, 2 * KEYS))]
    return bool(outputs < _SAFE and reach[0] * reach[1] * _SCALE + np.abs(w["near"]).max() < _SAFE)


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    ranked = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[first], np.add.reduceat(values.take(order, axis=0), first, axis=0)


def _attended(w: dict, now: np.ndarray, before: np.ndarray, skip: int = 0, safe: bool = True) -> tuple:
    """States of all places from ``skip`` on, with all that the gradients need. ``now``, ``before``: windows x WINDOW rows.

    Shares come by blocks of places: first and last place, unscaled shares, their sums.
    """
    n = len(now)
    x = w["now"].take(now.reshape(-1), axis=0)
    x += w["before"].take(before.reshape(-1), axis=0)
    x = x.reshape(n, WINDOW, WIDTH)
    qkv = np.matmul(x, w["qkv"])
    q = qkv[:, skip:, :KEYS] * _SCALE
    k, v = qkv[:, :, KEYS : 2 * KEYS], qkv[:, :, 2 * KEYS :]
    across = np.ascontiguousarray(k.transpose(0, 2, 1))
    near = (np.exp(w["near"]) if safe else w["near"])[_DISTANCE]
    o = np.empty((n, WINDOW - skip, WIDTH), x.dtype)
    shares = []
    for lo in range(skip, WINDOW, BLOCK):
        hi = min(lo + BLOCK, WINDOW)
        a = np.matmul(q[:, lo - skip : hi - skip], across[:, :, :hi])
        if not safe:
            a += near[lo:hi, :hi]
            a[:, _PAST[lo:hi, :hi] == 0] = -np.inf
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        if safe:
            a *= near[lo:hi, :hi] * _PAST[lo:hi, :hi]
        total = np.matmul(a, np.ones(hi, a.dtype))[:, :, None]
        part = np.matmul(a, v[:, :hi])
        np.divide(part, total, out=o[:, lo - skip : hi - skip])
        shares.append((lo, hi, a, total))
    y = np.matmul(x[:, skip:], w["mix"])
    y += np.matmul(o, w["join"])
    return x, q, k, v, shares, o, _states(y)


def _states(y: np.ndarray) -> np.ndarray:
    """States of places, and a column of ones for the bias."""
    y = y.reshape(-1, WIDTH)
    one = np.ones((len(y), WIDTH + 1), y.dtype)
    np.tanh(y, out=one[:, :WIDTH])
    return one


def _pieces(vocabulary: Vocabulary, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[slice, np.ndarray]]]:
    """For ranks: their order by rank and, in that order, the entry of the first softmax, and where the tokens of each group stand with their place in it."""
    order = np.argsort(target.astype(np.uint16 if len(vocabulary.rank) <= 1 << 16 else np.int64), kind="stable")
    ranked = target.take(order).astype(np.int64)
    entry = ranked.copy()
    inner = []
    for g, (a, b) in enumerate(vocabulary.groups):
        at = slice(*np.searchsorted(ranked, (a, b)).tolist())
        entry[at] = vocabulary.head + g
        inner.append((at, ranked[at] - a))
    return order, entry, inner


def _step(weights: np.ndarray) -> int:
    return max(64, min(2048, _LOGITS // weights.shape[1]))


def _layers(w: dict, vocabulary: Vocabulary) -> list[np.ndarray]:
    """The weights of the first softmax and of each learned group: views, a bias in the last row."""
    return [w["out"][(WIDTH + 1) * a : (WIDTH + 1) * b].reshape(WIDTH + 1, -1) for a, b in vocabulary.columns()]


def _by_parts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b``, some rows of ``a`` at a time: the library is faster at many small products than at a long narrow one."""
    if len(a) < _MANY_ROWS:
        return a @ b
    n = len(a) - len(a) % _ROWS_AT_ONCE
    b = np.ascontiguousarray(b)  # small products with a transposed matrix are slow
    out = np.empty((len(a), b.shape[1]), a.dtype)
    np.matmul(a[:n].reshape(-1, _ROWS_AT_ONCE, a.shape[1]), b, out=out[:n].reshape(-1, _ROWS_AT_ONCE, b.shape[1]))
    if n < len(a):
        np.matmul(a[n:], b, out=out[n:])
    return out


def _summed_by_parts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b``, some rows of both at a time."""
    if len(a) < _MANY_ROWS:
        return a.T @ b
    n = len(a) - len(a) % _ROWS_AT_ONCE
    out = np.matmul(a[:n].reshape(-1, _ROWS_AT_ONCE, a.shape[1]).transpose(0, 2, 1), b[:n].reshape(-1, _ROWS_AT_ONCE, b.shape[1])).sum(axis=0)
    if n < len(a):
        out += a[n:].T @ b[n:]
    return out


def log_probability(layers: list[np.ndarray], vocabulary: Vocabulary, y: np.ndarray, target: np.ndarray, safe: bool = True) -> np.ndarray:
    """Natural log probability of each target rank. ``y``: states, a row per target."""
    order, entry, inner = _pieces(vocabulary, target)
    y = y.take(order, axis=0)
    ranked = np.zeros(len(y), np.float32)
    for weights, (at, place) in zip(layers, [(slice(0, len(y)), entry), *inner], strict=False):
        ones, step = np.ones(weights.shape[1], np.float32), _step(weights)
        for lo in range(at.start, at.stop, step):
            some = slice(lo, min(lo + step, at.stop))
            s = _by_parts(y[some], weights)
            if not safe:
                s -= s.max(axis=1, keepdims=True)
            picked = s[np.arange(len(s)), place[some.start - at.start : some.stop - at.start]]
            ranked[some] += picked - np.log(np.exp(s, out=s) @ ones)
    if vocabulary.rest is not None:
        at, place = inner[-1]
        ranked[at] += vocabulary.rest[place]
    out = np.empty_like(ranked)
    out[order] = ranked
    return out


def _softmax_gradient(y: np.ndarray, weights: np.ndarray, entry: np.ndarray, share: np.ndarray, into: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the loss with respect to the states in ``y``; that of the weights is added to ``into``. ``share``: weight of each token."""
    s = _by_parts(y, weights)
    each = np.arange(len(s))
    picked = s[each, entry]
    np.exp(s, out=s)
    total = s @ np.ones(s.shape[1], s.dtype)
    loss = float(((np.log(total) - picked) * share).sum())
    s *= (share / total)[:, None]
    s[each, entry] -= share
    into += _summed_by_parts(y, s)
    return _by_parts(s, weights[:WIDTH].T), loss


def gradients(w: dict, vocabulary: Vocabulary, now: np.ndarray, before: np.ndarray, target: np.ndarray, live: np.ndarray, g: dict) -> tuple[float, dict]:
    """Gradients of the mean negative log likelihood of the live places.

    Those of the embeddings are returned as rows and sums, all others are written to ``g``. The mean, without the fixed
    shares of the last group, comes first.
    """
    x, q, k, v, shares, o, y = _attended(w, now, before)
    order, entry, inner = _pieces(vocabulary, target.reshape(-1))
    share = (live / max(1, int(live.sum()))).astype(y.dtype).reshape(-1).take(order)
    ranked = y.take(order, axis=0)
    loss, more = 0.0, np.zeros((len(y), WIDTH), y.dtype)
    g["out"][:] = 0
    for weights, into, (at, place) in zip(_layers(w, vocabulary), _layers(g, vocabulary), [(slice(0, len(y)), entry), *inner], strict=False):
        step = _step(weights)
        for lo in range(at.start, at.stop, step):
            some = slice(lo, min(lo + step, at.stop))
            of_y, part = _softmax_gradient(ranked[some], weights, place[some.start - at.start : some.stop - at.start], share[some], into)
            more[some] += of_y
            loss += part
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    dy = more.take(back, axis=0)
    y = y[:, :WIDTH]
    slope = y * y
    dy *= np.subtract(1, slope, out=slope)
    rows = lambda t: t.reshape(-1, t.shape[-1])
    do = _by_parts(dy, w["join"].T).reshape(o.shape)
    inward = np.einsum("bij,bij->bi", do, o)[:, :, None]  # the inner product of the attention's softmax, from the narrower side
    both = np.empty((*x.shape[:2], 2 * KEYS + 2 * WIDTH), y.dtype)  # of queries, keys and values, and of the states
    dq, dk, dv = both[:, :, :KEYS], both[:, :, KEYS : 2 * KEYS], both[:, :, 2 * KEYS : 2 * KEYS + WIDTH]
    both[:, :, 2 * KEYS + WIDTH :] = dy.reshape(o.shape)
    across = np.ascontiguousarray(v.transpose(0, 2, 1))
    near = np.zeros(WINDOW)
    for lo, hi, a, total in reversed(shares):  # the last block sees all places: it writes what the others add to
        d = do[:, lo:hi]
        d /= total  # so that the exponentials need not be divided
        da = np.matmul(d, across[:, :, :hi])
        da -= inward[:, lo:hi] / total
        da *= a
        near += np.bincount(_DISTANCE[lo:hi, :hi].ravel(), weights=(np.ones(len(da), y.dtype) @ da.reshape(len(da), -1)) * _PAST[lo:hi, :hi].ravel(), minlength=WINDOW)
        np.matmul(da, k[:, :hi], out=dq[:, lo:hi])
        if hi == WINDOW:
            np.matmul(da.transpose(0, 2, 1), q[:, lo:hi], out=dk)
            np.matmul(a.transpose(0, 2, 1), d, out=dv)
        else:
            dk[:, :hi] += np.matmul(da.transpose(0, 2, 1), q[:, lo:hi])
            dv[:, :hi] += np.matmul(a.transpose(0, 2, 1), d)
    dq *= _SCALE
    g["near"][:] = near
    of_x = _summed_by_parts(rows(x), rows(both))
    g["qkv"][:], g["mix"][:], g["join"][:] = of_x[:, : 2 * KEYS + WIDTH], of_x[:, 2 * KEYS + WIDTH :], _summed_by_parts(rows(o), dy)
    dx = _by_parts(rows(both), np.concatenate([w["qkv"], w["mix"]], axis=1).T)
    return loss, {"now": _by_row(now.reshape(-1), dx), "before": _by_row(before.reshape(-1), dx)}


def _adam(weights, mean, square, grad, rate: float, step: int):
    """One Adam step in place; returns its three states."""
    change = grad - mean
    change *= np.float32(0.1)
    mean += change
    grad *= grad
    grad -= square
    grad *= np.float32(0.02)
    square += grad
    np.sqrt(square, out=grad)
    grad += np.float32(1e-6)
    np.divide(mean, grad, out=grad)
    grad *= np.float32(rate * np.sqrt(1 - 0.98**step) / (1 - 0.9**step))
    weights -= grad
    return weights, mean, square


def train_locally(flat: np.ndarray, vocabulary: Vocabulary, windows: np.ndarray, rate: float, batch: int) -> np.ndarray:
    """One pass of Adam over the windows in their order; embeddings only step where they occur.

    ``windows``: rows of WINDOW + 2 ids, -1 behind a text's end. Steps that overflow are undone as a whole.
    """
    start, flat, shapes = flat, flat.copy(), vocabulary.shapes()
    grad, mean, square = (np.zeros_like(flat) for _ in range(3))
    w, g, m, v = (unflatten(x, shapes) for x in (flat, grad, mean, square))
    dense = range(sum(int(np.prod(shapes[e])) for e in _EMBEDDINGS), len(flat), _WEIGHTS_AT_ONCE)
    for step, lo in enumerate(range(0, len(windows), batch), 1):
        some = windows[lo : lo + batch]
        live = some >= 0
        ids = np.where(live, some, 0)
        # Places without a target weigh nothing, so they go where a step is cheapest.
        row, rank = vocabulary.row.take(ids), np.where(live[:, 2:], vocabulary.rank.take(ids[:, 2:]), 0)
        with np.errstate(over="ignore", invalid="ignore"):
            _, sparse = gradients(w, vocabulary, row[:, 1:-1], row[:, :-2], rank, live[:, 2:], g)
            for at in dense:  # a part stays in the processor's cache
                part = slice(at, at + _WEIGHTS_AT_ONCE)
                _adam(flat[part], mean[part], square[part], grad[part], rate, step)
            for e, (at, sums) in sparse.items():
                w[e][at], m[e][at], v[e][at] = _adam(w[e][at], m[e][at], v[e][at], sums, rate, step)
    return flat if np.isfinite(flat).all() else start


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the scoring windows of texts with so many places each, laid out behind one another, and the text of each."""
    n = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), n)
    first = np.cumsum(sizes) - sizes
    return np.repeat(first, n) + STRIDE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)), text


class Scorer:
    """The forward pass with fixed weights, over blocks of STRIDE places that see their own and the block before.

    These are the windows of ``windows_of``, two blocks each, but keys and values of a block are computed once for both
    windows it is in, from tables of what each subword contributes to them as the one at a place and as the one before.
    """

    def __init__(self, flat: np.ndarray, vocabulary: Vocabulary):
        self.vocabulary, self.w = vocabulary, unflatten(flat, vocabulary.shapes())
        self.layers, self.safe = _layers(self.w, vocabulary), bounded(self.w, vocabulary)
        parts = np.concatenate([self.w["qkv"][:, :KEYS] * _SCALE, self.w["qkv"][:, KEYS:], self.w["mix"]], axis=1)
        self.tables = [self.w[e] @ parts for e in _EMBEDDINGS]

    def _states(self, now: np.ndarray, before: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """States of all places but those of the first block, which is only seen. ``opens``: whether a block sees none before it."""
        w = self.w
        z = self.tables[0].take(now, axis=0)
        z += self.tables[1].take(before, axis=0)
        z = z.reshape(-1, STRIDE, 2 * KEYS + 2 * WIDTH)
        q = z[1:, :, :KEYS]
        across = np.ascontiguousarray(z[:, :, KEYS : 2 * KEYS].transpose(0, 2, 1))
        a = np.empty((len(opens), STRIDE, WINDOW), z.dtype)
        np.matmul(q, across[:-1], out=a[:, :, :STRIDE])
        np.matmul(q, across[1:], out=a[:, :, STRIDE:])
        near, past = w["near"][_DISTANCE[STRIDE:]], _PAST[STRIDE:]
        if not self.safe:
            a += near
            a[:, past == 0] = -np.inf
            a[opens, :, :STRIDE] = -np.inf
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        if self.safe:
            a *= np.exp(near) * past
            a[opens, :, :STRIDE] = 0
        total = np.matmul(a, np.ones(WINDOW, a.dtype))[:, :, None]
        seen = np.lib.stride_tricks.as_strided(z[:, :, 2 * KEYS :], (len(opens), WINDOW, WIDTH), z.strides, writeable=False)
        o = np.matmul(a, seen)
        o /= total
        y = np.matmul(o, w["join"])
        y += z[1:, :, 2 * KEYS + WIDTH :]
        return _states(y)

    def log10(self, ids: np.ndarray, sizes: np.ndarray, end: int, batch: int = 128) -> np.ndarray:
        """log10 probability of every subword and of the end behind each text, each scored once, with the places of its block and of the one before it that precede it."""
        v = self.vocabulary
        ends, places = np.cumsum(sizes), sizes + 1
        blocks = -(-places // STRIDE)
        first = 1 + np.cumsum(blocks) - blocks  # an empty block stands before all texts
        at = np.arange(int(places.sum())) + np.repeat(first * STRIDE - (np.cumsum(places) - places), places)
        n = 1 + int(blocks.sum())
        opens = np.zeros(n, bool)
        opens[first] = True
        rank, now, before = np.zeros(n * STRIDE, v.rank.dtype), np.zeros(n * STRIDE, v.row.dtype), np.zeros(n * STRIDE, v.row.dtype)
        rank[at] = v.rank[np.insert(ids, ends, end)]
        now[at] = v.row[np.insert(ids, ends - sizes, end)]  # the end also stands before each text
        before[1:] = now[:-1]
        before[first * STRIDE] = v.row[end]
        out = np.empty(n * STRIDE, np.float64)
        for lo in range(1, n, batch):
            hi = min(lo + batch, n)
            seen, some = slice((lo - 1) * STRIDE, hi * STRIDE), slice(lo * STRIDE, hi * STRIDE)
            out[some] = log_probability(self.layers, v, self._states(now[seen], before[seen], opens[lo:hi]), rank[some], self.safe)
        return out[at] / np.log(10)
