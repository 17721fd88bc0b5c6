"""A character-level bidirectional LSTM with CRF transitions in numpy: forward, training, decoding.

Sequences are rows of character classes of one length. Both directions run as
one batch (the backward one on reversed rows). The CRF has learned transitions;
training maximises the log-likelihood of the tag paths with Adam.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 24
#: Classes: 0 padding, ASCII with letters in lower case and one digit, 128 other letters, 129 the rest.
CLASSES = 130


def char_classes(codes: np.ndarray) -> np.ndarray:
    """Classes of code points."""
    out = np.where(codes < 128, codes, np.where(codes < 0x2000, 128, 129))
    out = np.where((out >= 65) & (out <= 90), out + 32, out)
    out = np.where((out >= 48) & (out <= 57), 48, out)
    return np.where(out == 0, 129, out).astype(np.int16)


def start_weights(n_tags: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h = HIDDEN

    def mat(*shape):
        return (rng.standard_normal(shape) * 0.15).astype(np.float32)

    w = {"x": mat(2, CLASSES, 4 * h), "u": mat(2, h, 4 * h), "o": mat(2 * h, n_tags), "b": mat(n_tags), "t": mat(n_tags, n_tags)}
    w["x"][:, :, h : 2 * h] += 1.0  # forget gates open
    return w


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(w, ids, keep):
    """Hidden states (2, T, B, H) of both directions, and what the backward pass needs."""
    n, length = ids.shape
    h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    both = np.stack([ids, ids[:, ::-1]])
    out = np.empty((2, length, n, HIDDEN), np.float32)
    saved = []
    k = HIDDEN
    for t in range(length):
        z = np.stack([w["x"][0][both[0, :, t]], w["x"][1][both[1, :, t]]]) + h @ w["u"]
        gate = _sigmoid(z[:, :, : 3 * k])
        g = np.tanh(z[:, :, 3 * k :])
        i, f, o = gate[:, :, :k], gate[:, :, k : 2 * k], gate[:, :, 2 * k :]
        c_old, h_old = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep:
            saved.append((gate, g, c_old, tc, h_old))
    return out, both, saved


def emissions(w, ids) -> np.ndarray:
    """Tag scores (T, B, K)."""
    out, _, _ = _lstm(w, ids, False)
    return out[0] @ w["o"][:HIDDEN] + out[1, ::-1] @ w["o"][HIDDEN:] + w["b"]


def decode(w, ids) -> np.ndarray:
    """Best tag path of each row (Viterbi)."""
    e = emissions(w, ids)
    return viterbi(e, w["t"], np.full(e.shape[1], len(e)))


def viterbi(e: np.ndarray, trans: np.ndarray, lengths: np.ndarray, first=0.0, last=0.0) -> np.ndarray:
    """Best tag paths (B, T) for tag scores (T, B, K) of rows of these lengths; ``first``, ``last``: added at the ends (B, K)."""
    length, n, k = e.shape
    back = np.empty((length, n, k), np.int8)
    score, same = e[0] + first, np.arange(k, dtype=np.int8)
    for t in range(1, length):
        s = score[:, :, None] + trans
        best = s.argmax(axis=1)
        on = (t < lengths)[:, None]
        back[t] = np.where(on, best, same)
        score = np.where(on, np.take_along_axis(s, best[:, None, :], axis=1)[:, 0] + e[t], score)
    path = np.empty((n, length), np.int8)
    path[:, -1] = (score + last).argmax(axis=1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = back[t, rows, path[:, t]]
    return path


def loss_and_gradients(w, ids, tags):
    """Mean negative log-likelihood of the paths and its gradients."""
    out, both, saved = _lstm(w, ids, True)
    fwd, bwd = out[0], out[1, ::-1]
    e = (fwd @ w["o"][:HIDDEN] + bwd @ w["o"][HIDDEN:] + w["b"]).astype(np.float64)
    length, n, k = e.shape
    # forward and backward in probabilities, scaled to sum 1 at every place
    top, trans = e.max(axis=2), w["t"].astype(np.float64)
    shift = trans.max()
    step, at = np.exp(trans - shift), np.exp(e - top[:, :, None])
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((length, n))
    for t in range(length):
        alpha[t] = at[0] if t == 0 else alpha[t - 1] @ step * at[t]
        scale[t] = alpha[t].sum(axis=1)
        alpha[t] /= scale[t][:, None]
    for t in range(length - 2, -1, -1):
        beta[t] = (at[t + 1] * beta[t + 1] / scale[t + 1][:, None]) @ step.T
    z = np.log(scale).sum(axis=0) + top.sum(axis=0) + (length - 1) * shift
    rows, tt = np.arange(n), tags.T
    gold = e[np.arange(length)[:, None], rows[None], tt].sum(axis=0) + trans[tt[:-1], tt[1:]].sum(axis=0)
    de = alpha * beta
    de[np.arange(length)[:, None], rows[None], tt] -= 1
    de /= n
    onward = (at[1:] * beta[1:] / scale[1:][:, :, None]).reshape(-1, k)
    dt = step * (alpha[:-1].reshape(-1, k).T @ onward)
    dt -= np.bincount((tt[:-1] * k + tt[1:]).ravel(), minlength=k * k).reshape(k, k)
    de32 = de.astype(np.float32)
    flat = de32.reshape(-1, k)
    g = {"t": (dt / n).astype(np.float32), "b": flat.sum(axis=0)}
    g["o"] = np.concatenate([fwd.reshape(-1, HIDDEN).T @ flat, bwd.reshape(-1, HIDDEN).T @ flat])
    dh = np.stack([de32 @ w["o"][:HIDDEN].T, (de32 @ w["o"][HIDDEN:].T)[::-1]])
    dz = np.empty((2, length, n, 4 * HIDDEN), np.float32)
    h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    m, back = HIDDEN, w["u"].transpose(0, 2, 1).copy()
    for t in range(length - 1, -1, -1):
        gate, gg, c_old, tc, _ = saved[t]
        i, f, o = gate[:, :, :m], gate[:, :, m : 2 * m], gate[:, :, 2 * m :]
        d = dh[:, t] + h
        dc = c + d * o * (1 - tc * tc)
        now = dz[:, t]
        now[:, :, :m] = dc * gg * i * (1 - i)
        now[:, :, m : 2 * m] = dc * c_old * f * (1 - f)
        now[:, :, 2 * m : 3 * m] = d * tc * o * (1 - o)
        now[:, :, 3 * m :] = dc * i * (1 - gg * gg)
        h = now @ back
        c = dc * f
    before = np.stack([s[4] for s in saved], axis=1).reshape(2, -1, HIDDEN)
    dz = dz.reshape(2, -1, 4 * HIDDEN)
    g["u"] = before.transpose(0, 2, 1) @ dz
    g["x"] = np.zeros_like(w["x"])
    for s in (0, 1):
        seen = both[s].T.ravel()
        order = np.argsort(seen, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(seen[order]) != 0]))
        g["x"][s][seen[order][first]] = np.add.reduceat(dz[s][order], first, axis=0)
    return float((z - gold).mean()), g


def train(ids: np.ndarray, tags: np.ndarray, n_tags: int, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 7):
    """Weights after ``steps`` batches of Adam with a falling rate; the same data and seed give the same weights."""
    w = start_weights(n_tags, seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    order = np.concatenate([rng.permutation(len(ids)) for _ in range(-(-steps * batch // len(ids)))])
    for step in range(1, steps + 1):
        pick = order[(step - 1) * batch : step * batch]
        _, g = loss_and_gradients(w, ids[pick], tags[pick])
        now = rate * (1 - 0.95 * step / steps)
        for k in w:
            x = np.clip(g[k], -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * x
            second[k] = 0.999 * second[k] + 0.001 * x * x
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            w[k] -= now * fix * first[k] / (np.sqrt(second[k]) + 1e-8)
    return w
