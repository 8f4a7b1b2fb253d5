"""Linear-chain conditional random field with two states, on concatenated sequences.

Emission is a log-odds of state 1 per position; transitions and the start are shared. Forward and
backward passes are products of 2 by 2 matrices. They are associative, so positions are cut into blocks of
equal length: products of all blocks are taken side by side, the few block products are chained, and the
passes inside the blocks run side by side again. The result is exact, long sequences cost no more than
many short ones, and no loop runs over single positions of a corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Log potentials: ``start`` is the log-odds of state 1, ``moves[i, j]`` the score of going from i to j."""

    start: float
    moves: np.ndarray

    @property
    def parameters(self) -> np.ndarray:
        return np.concatenate(([self.start], np.ravel(self.moves)))

    @classmethod
    def of(cls, parameters: np.ndarray) -> Chain:
        return cls(float(parameters[0]), np.asarray(parameters[1:5], float).reshape(2, 2))


def _block_length(n: int) -> int:
    return max(8, int(np.sqrt(n) / 3))


class Passes:
    """Forward and backward messages for ``odds`` (log-odds per position); ``first`` marks where sequences begin."""

    def __init__(self, odds: np.ndarray, first: np.ndarray, chain: Chain):
        n = len(odds)
        length = _block_length(n)
        blocks = -(-n // length)
        padded = np.zeros(blocks * length)
        padded[:n] = np.clip(odds, -40, 40)
        starts = np.ones(blocks * length, bool)
        starts[:n] = first
        begin = np.array([1.0, np.exp(np.clip(chain.start, -40, 40))])
        moves = np.exp(np.clip(chain.moves, -40, 40))
        on = 1 / (1 + np.exp(-padded))
        emit = np.stack([1 - on, on])
        # step[i, j]: from state i before a position to state j there
        step = np.where(starts, begin[None, :, None], moves[:, :, None]) * emit[None]
        self.n, self.shape = n, (length, blocks)
        self.step = np.ascontiguousarray(step.reshape(2, 2, blocks, length).transpose(0, 1, 3, 2))
        self.moves, self.first = moves, first
        self._run()

    def _run(self) -> None:
        (length, blocks), s = self.shape, self.step
        p00, p01, p10, p11 = (np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks))
        for t in range(length):
            a, b, c, d = s[0, 0, t], s[0, 1, t], s[1, 0, t], s[1, 1, t]
            p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
            scale = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
        ahead, behind = np.empty((2, blocks)), np.empty((2, blocks))
        x, y = 0.5, 0.5
        for k, (a, b, c, d) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist())):
            ahead[0, k], ahead[1, k] = x, y
            x, y = x * a + y * c, x * b + y * d
            x, y = x / (x + y), y / (x + y)
        x, y = 0.5, 0.5
        for k in range(blocks - 1, -1, -1):
            behind[0, k], behind[1, k] = x, y
            x, y = p00[k] * x + p01[k] * y, p10[k] * x + p11[k] * y
            x, y = x / (x + y), y / (x + y)
        forward, backward = np.empty((2, length, blocks)), np.empty((2, length, blocks))
        self.scales = np.empty((length, blocks))
        x, y = ahead
        for t in range(length):
            u, v = x * s[0, 0, t] + y * s[1, 0, t], x * s[0, 1, t] + y * s[1, 1, t]
            total = u + v
            x, y = u / total, v / total
            forward[0, t], forward[1, t], self.scales[t] = x, y, total
        x, y = behind
        for t in range(length - 1, -1, -1):
            backward[0, t], backward[1, t] = x, y
            u, v = s[0, 0, t] * x + s[0, 1, t] * y, s[1, 0, t] * x + s[1, 1, t] * y
            x, y = u / (u + v), v / (u + v)
        flat = lambda a: a.transpose(0, 2, 1).reshape(2, -1)[:, : self.n]
        self.forward, self.backward = flat(forward), flat(backward)

    def marginals(self) -> np.ndarray:
        """Probability of state 1 at each position."""
        both = self.forward * self.backward
        return both[1] / (both[0] + both[1])

    def moves_expected(self) -> np.ndarray:
        """Expected number of moves from i to j inside sequences."""
        if self.n < 2:
            return np.zeros((2, 2))
        inside = ~self.first[1:]
        step = self.step.transpose(0, 1, 3, 2).reshape(2, 2, -1)[:, :, 1 : self.n]
        pair = self.forward[:, None, :-1] * step * self.backward[None, :, 1:]
        pair = pair / pair.sum((0, 1))
        return (pair * inside).sum(2)


def marginals(odds: np.ndarray, first: np.ndarray, chain: Chain) -> np.ndarray:
    return Passes(odds, first, chain).marginals() if len(odds) else np.zeros(0)


def fit(
    positions: np.ndarray,
    features: np.ndarray,
    values: np.ndarray,
    n_features: int,
    labels: np.ndarray,
    first: np.ndarray,
    penalty: float = 1.0,
    rounds: int = 150,
    rate: float = 0.3,
) -> tuple[np.ndarray, Chain]:
    """Weights and chain that raise the likelihood of ``labels`` (0 or 1 per position).

    ``positions``, ``features`` and ``values`` list the features that are on. The gradient of the likelihood
    is the difference between observed and expected counts; steps are scaled per parameter (Adam).
    """
    n = len(labels)
    parameters = np.zeros(n_features + 5)
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    inside = ~first[1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][inside], labels[1:][inside]), 1)
    for turn in range(1, rounds + 1):
        weights, chain = parameters[:n_features], Chain.of(parameters[n_features:])
        odds = np.bincount(positions, weights[features] * values, n)
        passes = Passes(odds, first, chain)
        p = passes.marginals()
        missing = labels - p
        gradient = np.concatenate(
            (
                np.bincount(features, missing[positions] * values, n_features),
                [missing[first].sum()],
                (seen - passes.moves_expected()).ravel(),
            )
        )
        gradient = (gradient - penalty * parameters) / n
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        step = (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        parameters = parameters + rate * (0.5 ** (3 * turn / rounds)) * step
    return parameters[:n_features], Chain.of(parameters[n_features:])


def fit_logistic(inputs: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression, the intercept last, by Newton steps; slopes are kept from falling below 0."""
    x = np.column_stack([inputs, np.ones(len(inputs))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge
        g = x.T @ (labels - p) / len(x) - ridge @ w
        step = np.linalg.solve(h, g)
        w = w + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    w[:-1] = np.maximum(w[:-1], 0)
    return w


def logistic(inputs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(inputs @ weights[:-1] + weights[-1], -30, 30)))
