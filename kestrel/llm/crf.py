"""A two-state linear-chain conditional random field over token features, in numpy.

States are 0 (clean) and 1 (toxic).  A token's features are few indices into a
weight vector; the chain adds start and transition weights.  Most tokens of a
text carry no feature at all, so inference works on the tokens that do and
crosses the gaps between them with powers of the background transfer matrix.
"""

from __future__ import annotations

import numpy as np


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class ChainCRF:
    """``weights``: toxic-minus-clean score per feature; ``bias``: of every token; ``start``: of a first toxic
    token; ``trans[i, j]``: from state i to state j."""

    def __init__(self, n_features: int):
        self.weights = np.zeros(n_features)
        self.bias = 0.0
        self.start = 0.0
        self.trans = np.zeros((2, 2))

    # ------------------------------------------------------------ training
    def _marginals(self, unary: np.ndarray):
        """Token marginals, summed pair marginals and log-partition of equally long chains (rows of ``unary``)."""
        n, t = unary.shape
        alpha = np.zeros((t, n, 2))
        beta = np.zeros((t, n, 2))
        alpha[0, :, 1] = unary[:, 0] + self.start
        for k in range(1, t):
            alpha[k] = _lse(alpha[k - 1][:, :, None] + self.trans[None], 1)
            alpha[k, :, 1] += unary[:, k]
        for k in range(t - 2, -1, -1):
            nxt = beta[k + 1].copy()
            nxt[:, 1] += unary[:, k + 1]
            beta[k] = _lse(self.trans[None] + nxt[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z).T
        pair = np.zeros((2, 2))
        for k in range(1, t):
            nxt = beta[k].copy()
            nxt[:, 1] += unary[:, k]
            pair += np.exp(alpha[k - 1][:, :, None] + self.trans[None] + nxt[:, None, :] - z[:, None, None]).sum(0)
        return p, pair, z

    def fit(self, features: np.ndarray, tags: np.ndarray, rounds: int = 150, rate: float = 0.15, l2: float = 0.5) -> None:
        """Maximise the penalised likelihood by Adam.

        ``features``: (chains, tokens, slots) feature indices, -1 for none;
        ``tags``: (chains, tokens) of 0/1.
        """
        n, t, _ = features.shape
        used = features >= 0
        index = np.where(used, features, 0)
        pair_seen = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                pair_seen[i, j] = ((tags[:, :-1] == i) & (tags[:, 1:] == j)).sum()
        size = len(self.weights)
        theta = np.concatenate((self.weights, [self.bias, self.start], self.trans.ravel()))
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            unary = self.bias + (self.weights[index] * used).sum(2)
            p, pair, _ = self._marginals(unary)
            diff = tags - p
            grad_w = np.bincount(index[used], weights=np.broadcast_to(diff[:, :, None], used.shape)[used], minlength=size)
            grad = np.concatenate((grad_w, [diff.sum(), diff[:, 0].sum()], (pair_seen - pair).ravel())) - l2 * theta
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            self.weights, (self.bias, self.start) = theta[:size], theta[size:size + 2]
            self.trans = theta[size + 2:].reshape(2, 2)

    # ------------------------------------------------------------ inference
    def _power(self, gap: int) -> np.ndarray:
        """Transfer matrix over ``gap`` featureless tokens, scaled to keep within range; gap 0 is the identity."""
        step = np.exp(self.trans)
        step[:, 1] *= np.exp(self.bias)
        step /= step.max()
        out = np.eye(2)
        while gap:
            if gap & 1:
                out = out @ step
                out /= out.max()
            step = step @ step
            step /= step.max()
            gap >>= 1
        return out

    def posterior(self, at: np.ndarray, scores: np.ndarray, length: int) -> np.ndarray:
        """Toxic marginal of the tokens at positions ``at`` (ascending) with summed feature weights ``scores``
        in a chain of ``length`` tokens whose other tokens have no feature."""
        k = len(at)
        if not k:
            return np.zeros(0)
        hop = np.exp(self.trans - self.trans.max())
        emit = np.ones((k, 2))
        raw = self.bias + scores
        emit[:, 1] = np.exp(np.minimum(raw, 0))
        emit[:, 0] = np.exp(-np.maximum(raw, 0))
        first = np.array([1.0, np.exp(self.start)])
        forward = np.zeros((k, 2))
        if at[0]:                                                  # featureless tokens ahead of the first
            lead = first * np.array([1.0, np.exp(self.bias)])
            lead = lead / lead.max() @ self._power(int(at[0]) - 1) @ hop
        else:
            lead = first
        forward[0] = lead * emit[0]
        forward[0] /= forward[0].sum()
        for i in range(1, k):
            f = forward[i - 1] @ self._power(int(at[i] - at[i - 1]) - 1) @ hop * emit[i]
            forward[i] = f / f.sum()
        backward = np.ones((k, 2))
        backward[-1] = self._power(int(length - 1 - at[-1])) @ np.ones(2)
        for i in range(k - 2, -1, -1):
            b = self._power(int(at[i + 1] - at[i]) - 1) @ hop @ (emit[i + 1] * backward[i + 1])
            backward[i] = b / b.max()
        p = forward * backward
        return p[:, 1] / p.sum(1)
