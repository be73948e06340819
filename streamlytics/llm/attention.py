"""The small causal self-attention model of operator 5, in numpy: forward, backward, Adam.

Ids are 0..size - 1 for subwords, ``size`` for the end, which also stands before the text.
A position's input is the sum of three embeddings, of its id and the two before it. One
masked attention layer with a learnt bias by distance looks back over the window; a hidden
layer follows; the next id is predicted by a tree softmax of three levels, each with
``width`` branches (``width`` ** 3 leaves hold all ids), so that a token costs 3 * width
outputs instead of a vocabulary.
"""

from __future__ import annotations

import numpy as np

WINDOW, STEP = 32, 26
DIM, HEAD, HIDDEN = 16, 16, 16


def init(size: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    width = branches(size)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"e0": normal(size + 1, DIM, scale=.3), "e1": normal(size + 1, DIM, scale=.2), "e2": normal(size + 1, DIM, scale=.1),
            "wq": normal(DIM, HEAD, scale=.25), "wk": normal(DIM, HEAD, scale=.25), "wv": normal(DIM, HEAD, scale=.25),
            "wo": normal(HEAD, DIM, scale=.25), "far": np.zeros(WINDOW, np.float32),
            "w1": normal(DIM, HIDDEN, scale=.25), "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, DIM, scale=.18),
            "t1": normal(1, DIM, width, scale=.1), "t2": normal(width, DIM, width, scale=.1),
            "t3": normal(width * width, DIM, width, scale=.1),
            "c1": np.zeros((1, width), np.float32), "c2": np.zeros((width, width), np.float32),
            "c3": np.zeros((width * width, width), np.float32)}


def branches(size: int) -> int:
    return int(np.ceil((size + 1) ** (1 / 3) - 1e-9))


# logits are held within this, which stands for subtracting the largest
_MOST = 40.0
_BLOCK = 4096            # rows of the tree handled at once, so that they stay in a core's cache
_SCALE = HEAD ** -0.5
# distance of each scored position (the window's last STEP) to each position of the window
_BACK = np.arange(WINDOW - STEP, WINDOW)[:, None] - np.arange(WINDOW)[None, :]


def _look(p: dict, ids: np.ndarray):
    """The attention layer: inputs, queries, weights, their totals, inputs averaged by them.

    Queries meet the inputs through wq wk' and the averages pass through wv wo (in ``_think``),
    the products of the layer's matrices, so that no keys and values are made."""
    x = p["e0"].take(ids[:, 2:], axis=0)
    x += p["e1"].take(ids[:, 1:-1], axis=0)
    x += p["e2"].take(ids[:, :-2], axis=0)
    q = (x.reshape(-1, DIM) @ _query(p)).reshape(x.shape)[:, WINDOW - STEP:]
    a = q @ x.transpose(0, 2, 1)
    np.clip(a, -_MOST, _MOST, out=a)
    a += np.where(_BACK >= 0, p["far"][np.maximum(_BACK, 0)], np.float32(-1e9))
    np.exp(a, out=a)
    total = (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(*a.shape[:2], 1)
    c = a @ x
    c /= total
    return x, q, a, total, c


def _query(p: dict) -> np.ndarray:
    return p["wq"] @ p["wk"].T * p["wq"].dtype.type(_SCALE)


def _think(p: dict, x: np.ndarray, c: np.ndarray):
    """The hidden layer: features of each scored position."""
    h = c.reshape(-1, DIM) @ (p["wv"] @ p["wo"])
    h += x[:, WINDOW - STEP:].reshape(-1, DIM)
    u = h @ p["w1"]
    u += p["b1"]
    np.maximum(u, 0, out=u)
    g = u @ p["w2"]
    g += h
    return h, u, g


def _paths(p: dict) -> np.ndarray:
    """For each node of the third level the weights of its path's three levels side by side,
    the biases below them."""
    width = p["c1"].shape[1]
    w = np.empty((width, width, DIM + 1, 3 * width), p["t1"].dtype)
    w[:, :, :DIM, :width], w[:, :, DIM, :width] = p["t1"][0], p["c1"][0]
    w[:, :, :DIM, width:2 * width], w[:, :, DIM, width:2 * width] = p["t2"][:, None], p["c2"][:, None]
    w[:, :, :DIM, 2 * width:], w[:, :, DIM, 2 * width:] = p["t3"].reshape(width, width, DIM, width), p["c3"].reshape(width, width, width)
    return w.reshape(width * width, DIM + 1, 3 * width)


def _tree(p: dict, g: np.ndarray, code: np.ndarray, back: bool):
    """Log-probabilities of the leaves ``code`` over the three levels, and with ``back`` the
    gradients by g and by ``_paths``. g is (rows, DIM + 1), its last column ones; its rows and
    code are sorted by the third level's node."""
    width = p["c1"].shape[1]
    n, two = len(code), code // width
    w = _paths(p)
    branch = np.stack([two // width, width + two % width, 2 * width + code % width], axis=1)
    logp = np.empty(n, g.dtype)
    dg = np.empty((n, DIM), g.dtype) if back else None
    dw = np.zeros_like(w) if back else None
    ones, three = np.ones(width, g.dtype), np.ones(3, g.dtype)
    ahead, behind = list(w), list(w[:, :DIM].transpose(0, 2, 1))
    last = -1
    for lo in range(0, n, _BLOCK):
        gs, node = g[lo:lo + _BLOCK], two[lo:lo + _BLOCK]
        cuts = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist(), len(node)]
        parts = list(zip(node[cuts[:-1]].tolist(), cuts, cuts[1:]))
        z = np.empty((len(gs), 3 * width), g.dtype)
        for k, a, b in parts:
            np.dot(gs[a:b], ahead[k], out=z[a:b])
        np.clip(z, -_MOST, _MOST, out=z)
        flat, own = z.reshape(-1), branch[lo:lo + _BLOCK] + np.arange(len(gs))[:, None] * (3 * width)
        mine = flat[own]
        np.exp(z, out=z)
        each = z.reshape(-1, width)
        total = each @ ones
        mine -= np.log(total).reshape(-1, 3)
        logp[lo:lo + _BLOCK] = mine @ three
        if back:
            each *= (-1 / total)[:, None]
            flat[own] += 1                               # gradient of the log-probability
            ds = dg[lo:lo + _BLOCK]
            for k, a, b in parts:
                own = z[a:b]
                np.dot(own, behind[k], out=ds[a:b])
                if k == last:                            # begun in the block before
                    dw[k] += np.dot(gs[a:b].T, own)
                else:
                    np.dot(gs[a:b].T, own, out=dw[k])
            last = k
    return logp, dg, dw


def _by_node(p: dict, code: np.ndarray) -> np.ndarray:
    return np.argsort((code // p["c1"].shape[1]).astype(np.uint16), kind="stable")


def _with_ones(g: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), DIM + 1), g.dtype)
    out[:, :DIM] = g.take(rows, axis=0)
    out[:, DIM] = 1
    return out


def score(p: dict, ids: np.ndarray, target: np.ndarray, scored: np.ndarray, part: int = 64) -> np.ndarray:
    """Natural log-probabilities of the scored targets, in order; see ``windows``."""
    code = target[scored]
    g = np.empty((len(code), DIM), p["e0"].dtype)
    at = 0
    for i in range(0, len(ids), part):
        x, _, _, _, c = _look(p, ids[i:i + part])
        own = scored[i:i + part]
        out = _think(p, x, c)[2]
        out = out if own.all() else out[own.ravel()]
        g[at:at + len(out)] = out
        at += len(out)
    order = _by_node(p, code)
    logp = np.empty(len(code), g.dtype)
    logp[order] = _tree(p, _with_ones(g, order), code[order], False)[0]
    return logp


def windows(p: dict, ids: np.ndarray, target: np.ndarray, scored: np.ndarray):
    """Log-probabilities of the scored targets (in no order) and the gradient of their sum.

    ids: (windows, 2 + WINDOW), the ids the positions know last and two before them; target
    and scored (mask): (windows, STEP), the ids to predict at the last STEP positions."""
    x, q, a, total, c = _look(p, ids)
    h, u, g = _think(p, x, c)
    rows = np.flatnonzero(scored)
    code = target.ravel()[rows]
    order = _by_node(p, code)
    rows, code = rows[order], code[order]
    logp, dgs, dw = _tree(p, _with_ones(g, rows), code, True)
    width = p["c1"].shape[1]
    dw = dw.reshape(width, width, DIM + 1, 3, width)
    d = {}
    for name, by_path in (("1", dw[:, :, :, 0].sum(axis=(0, 1))[None]), ("2", dw[:, :, :, 1].sum(axis=1)),
                          ("3", dw[:, :, :, 2].reshape(-1, DIM + 1, width))):
        d["t" + name], d["c" + name] = by_path[:, :DIM], by_path[:, DIM]
    dg = np.zeros_like(g)
    dg[rows] = dgs
    d["w2"] = u.T @ dg
    du = dg @ p["w2"].T
    du *= u > 0
    d["w1"], d["b1"] = h.T @ du, np.ones(len(du), du.dtype) @ du
    dh = du @ p["w1"].T
    dh += dg
    mean = c.reshape(-1, DIM)
    dn = mean.T @ dh
    d["wv"], d["wo"] = dn @ p["wo"].T, p["wv"].T @ dn
    dc = dh @ (p["wv"] @ p["wo"]).T
    dc /= total.reshape(-1, 1)                           # the weights ``a`` are not divided by their totals
    along = np.einsum("ij,ij->i", dc, mean).reshape(total.shape)
    dc = dc.reshape(c.shape)
    ds = dc @ x.transpose(0, 2, 1)
    ds -= along
    ds *= a
    d["far"] = np.bincount(np.maximum(_BACK, 0).ravel(), np.where(_BACK >= 0, ds.sum(axis=0), 0).ravel(), WINDOW).astype(x.dtype)
    # inputs' gradients, two rows of zeros around each window's
    room = np.zeros((len(x), WINDOW + 4, DIM), x.dtype)
    dx = np.matmul(a.transpose(0, 2, 1), dc, out=room[:, 2:-2])
    dx += ds.transpose(0, 2, 1) @ q
    dq = (ds @ x).reshape(-1, DIM)
    dm = x[:, WINDOW - STEP:].reshape(-1, DIM).T @ dq * x.dtype.type(_SCALE)
    d["wq"], d["wk"] = dm @ p["wk"], dm.T @ p["wq"]
    dh += dq @ _query(p).T
    dx[:, WINDOW - STEP:] += dh.reshape(c.shape)
    # by id: three neighbouring rows are an id's gradients in the three embeddings
    at = ids.ravel().astype(np.uint16) if len(p["e0"]) < 1 << 16 else ids.ravel()
    by = np.argsort(at, kind="stable")
    ranked = at[by]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    by += by // (WINDOW + 2) * 2
    side = np.lib.stride_tricks.sliding_window_view(room.reshape(-1), 3 * DIM)[::DIM]
    sums = np.add.reduceat(side[by], heads)
    for k, name in enumerate(("e0", "e1", "e2")):
        d[name] = np.zeros_like(p[name])
        d[name][ranked[heads]] = sums[:, k * DIM:(k + 1) * DIM]
    return logp, d


class Adam:
    def __init__(self, p: dict, rate: float):
        self.rate, self.n = rate, 0
        self.m, self.v = ({k: np.zeros(x.size, x.dtype) for k, x in p.items()} for _ in range(2))

    def step(self, p: dict, grad: dict, tokens: int) -> None:
        self.n += 1
        rate = np.float32(self.rate * np.sqrt(1 - .98 ** self.n) / (1 - .9 ** self.n))
        part, share = 1 << 14, np.float32(.1 / max(tokens, 1))
        for k, g in grad.items():
            all_p, all_g = p[k].reshape(-1), g.reshape(-1)
            for i in range(0, len(all_p), part):         # a few thousand at once stay in a core's cache
                m, v = self.m[k][i:i + part], self.v[k][i:i + part]
                t = all_g[i:i + part] * share
                m *= np.float32(.9)
                m += t
                t *= t
                t *= np.float32(.02 / .01)
                v *= np.float32(.98)
                v += t
                np.sqrt(v, out=t)
                t += np.float32(1e-9)
                np.divide(m, t, out=t)
                t *= rate
                all_p[i:i + part] += t


def cut(ids: np.ndarray, bounds: np.ndarray, size: int):
    """Windows over the texts ids[bounds[i]:bounds[i + 1]], each to be followed by the end.

    Returns ids, target, scored (see ``windows``). Window k of a text scores its places
    k * STEP to k * STEP + STEP - 1, the end's included, and sees the WINDOW - STEP before:
    each is scored exactly once, in text order. The end stands wherever there is no id."""
    n = np.diff(bounds) + 1                                  # with the end
    count = -(-n // STEP)
    text = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    # one line of ids: WINDOW + 2 ends before each text, and ends up to its last window's end
    room = WINDOW + 2 + count * STEP
    base = np.cumsum(room) - room + WINDOW + 2
    line = np.full(int(room.sum()), size, np.int32)
    line[np.repeat(base - bounds[:-1], n - 1) + np.arange(bounds[0], bounds[-1])] = ids[bounds[0]:bounds[-1]]
    first = base[text] + start
    view = np.lib.stride_tricks.sliding_window_view(line, WINDOW + 3)[first - (WINDOW - STEP) - 3]
    scored = (start[:, None] + np.arange(STEP)[None, :]) < n[text][:, None]
    return view[:, :-1], view[:, 3 + WINDOW - STEP:], scored
