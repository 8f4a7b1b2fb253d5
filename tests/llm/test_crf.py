"""The field against enumeration of all label sequences, and its fit against counts."""

import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import crf


def enumerated(lengths, odds, chain):
    marginals, moves, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        total, on, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            score = chain.start * y[0] + sum(odds[at + t] * y[t] for t in range(n)) + sum(chain.moves[y[t], y[t + 1]] for t in range(n - 1))
            w = np.exp(score)
            total, on = total + w, on + w * np.array(y)
            for t in range(n - 1):
                pair[y[t], y[t + 1]] += w
        marginals += list(on / total)
        moves += pair / total
        at += n
    return np.array(marginals), moves


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 7), min_size=1, max_size=8), st.integers(0, 10**6))
def test_marginals(lengths, seed):
    random = np.random.default_rng(seed)
    chain = crf.Chain(random.normal(), random.normal(size=(2, 2)) * 2)
    odds = random.normal(size=sum(lengths)) * 3
    first = np.zeros(len(odds), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    passes = crf.Passes(odds, first, chain)
    marginals, moves = enumerated(lengths, odds, chain)
    assert np.allclose(passes.marginals(), marginals)
    assert np.allclose(passes.moves_expected(), moves)


def test_long_and_extreme():
    odds = np.tile([60.0, -60.0, 0.0], 50_000)
    p = crf.marginals(odds, np.arange(len(odds)) % 70_000 == 0, crf.Chain(0.0, np.zeros((2, 2))))
    assert np.isfinite(p).all() and np.allclose(p[:3], [1, 0, 0.5])
    assert len(crf.marginals(np.zeros(0), np.zeros(0, bool), crf.Chain(0.0, np.zeros((2, 2))))) == 0


def test_fit_learns_emissions_and_moves():
    random = np.random.default_rng(3)
    labels, state = [], 0
    for _ in range(20_000):
        state = state if random.random() < 0.9 else 1 - state
        labels.append(state)
    labels = np.array(labels)
    seen = np.where(random.random(len(labels)) < 0.7, labels, 1 - labels)
    first = np.arange(len(labels)) % 50 == 0
    at = np.arange(len(labels))
    weights, chain = crf.fit(np.tile(at, 2), np.repeat([0, 1], len(at)), np.concatenate((np.ones(len(at)), seen)), 2, labels, first)
    p = crf.marginals(weights[0] + weights[1] * seen, first, chain)
    assert weights[1] > 1 and chain.moves[0, 0] + chain.moves[1, 1] > chain.moves[0, 1] + chain.moves[1, 0] + 2
    assert ((p > 0.5) == labels).mean() > 0.75 > (seen == labels).mean()


def test_logistic():
    random = np.random.default_rng(4)
    x = random.normal(size=4000)
    y = (random.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    w = crf.fit_logistic(x[:, None], y)
    assert abs(w[0] - 2) < 0.3 and abs(w[1] + 1) < 0.3
