"""Linear-chain conditional random fields over many chains at once (NumPy).

Chains lie one after another in flat arrays. The recursions go step by step over all chains that
are still running, longest chains first, so one step is one vectorized operation.
"""

from __future__ import annotations

import numpy as np


def _step(a: np.ndarray, m: np.ndarray) -> np.ndarray:
    """a @ m, summed in a fixed order: a row's result doesn't depend on how many rows there are."""
    out = a[:, :1] * m[0]
    for i in range(1, len(m)):
        out += a[:, i : i + 1] * m[i]
    return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False, weight: np.ndarray | None = None):
    """Marginals [n, S] for emission log-scores [n, S] and transition log-scores [S, S].

    With `pairs`, also the pair marginals [S, S] summed over all neighbours, each weighted by `weight`
    (one per position; here that of the second of the two).
    Chains of length 0 take no part.
    """
    n, s = scores.shape
    lengths = lengths[lengths > 0]
    if not n:
        return (np.zeros((0, s)), np.zeros((s, s))) if pairs else np.zeros((0, s))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    sizes, starts = lengths[order], starts[order]
    top = scores.max(axis=1, keepdims=True)
    e = np.exp(scores - top)
    m = np.exp(trans - trans.max())
    steps = int(sizes[0])
    running = np.searchsorted(-sizes, -np.arange(steps), side="left")  # chains longer than t
    alpha, scale = np.empty_like(e), np.empty(n)
    at = starts[: running[0]]
    a = e[at]
    for t in range(steps):
        if t:
            at = starts[: running[t]] + t
            a = _step(a[: running[t]], m) * e[at]
        c = a.sum(axis=1)
        a = a / c[:, None]
        alpha[at], scale[at] = a, c
    beta = np.ones((n, s))
    joint = np.zeros((s, s))
    for t in range(steps - 1, 0, -1):
        at = starts[: running[t]] + t
        back = e[at] * beta[at] / scale[at][:, None]
        if pairs:
            joint += (alpha[at - 1].T @ (back if weight is None else back * weight[at][:, None])) * m
        beta[at - 1] = _step(back, m.T)
    p = alpha * beta
    p /= p.sum(axis=1, keepdims=True)
    if pairs:
        return p, joint
    return p


class Adam:
    """Adam for a list of arrays."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.x, self.rate, self.t = arrays, rate, 0
        self.m, self.v = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for x, g, m, v in zip(self.x, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
