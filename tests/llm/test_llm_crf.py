"""The CRF against enumeration of all label sequences, and against a step-by-step pass over long chains."""

import itertools

import numpy as np

from clickflow.llm import crf


def _model(rng, size):
    return crf.Model(np.zeros((1, size)), rng.normal(size=(size, size)), rng.normal(size=size))


def _enumerated(model, emit):
    size = model.labels
    scores = {}
    for y in itertools.product(range(size), repeat=len(emit)):
        s = model.start[y[0]] + sum(emit[t, k] for t, k in enumerate(y)) + sum(model.trans[a, b] for a, b in zip(y, y[1:], strict=False))
        scores[y] = s
    z = np.logaddexp.reduce(list(scores.values()))
    p = np.zeros((len(emit), size))
    for y, s in scores.items():
        for t, k in enumerate(y):
            p[t, k] += np.exp(s - z)
    return max(scores, key=scores.get), p


def test_short_sequences_equal_enumeration():
    rng = np.random.default_rng(1)
    for size in (2, 3):
        model = _model(rng, size)
        lengths = [1, 5, 2, 7, 3]
        emit = rng.normal(size=(sum(lengths), size)) * 2
        first = np.zeros(len(emit), dtype=bool)
        first[np.cumsum([0, *lengths[:-1]])] = True
        p, best = crf.marginals(model, emit, first), crf.viterbi(model, emit, first)
        at = 0
        for n in lengths:
            y, q = _enumerated(model, emit[at:at + n])
            assert tuple(best[at:at + n]) == y
            np.testing.assert_allclose(p[at:at + n], q, atol=1e-10)
            at += n


def test_long_chains_equal_a_sequential_pass():
    rng = np.random.default_rng(2)
    model, n = _model(rng, 3), 3 * crf.STEP + 17
    emit = rng.normal(size=(n, 3)) * 3
    first = np.zeros(n, dtype=bool)
    first[[0, crf.STEP - 1, 2 * crf.STEP + 5]] = True
    best, p = crf.viterbi(model, emit, first), crf.marginals(model, emit, first)
    bounds = [*np.flatnonzero(first), n]
    for a, b in itertools.pairwise(bounds):
        d, back = model.start + emit[a], []
        alpha = [model.start + emit[a]]
        for t in range(a + 1, b):
            way = d[:, None] + model.trans
            back.append(way.argmax(axis=0))
            d = way.max(axis=0) + emit[t]
            alpha.append(np.logaddexp.reduce(alpha[-1][:, None] + model.trans, axis=0) + emit[t])
        y = [int(d.argmax())]
        for k in reversed(back):
            y.append(int(k[y[-1]]))
        assert best[a:b].tolist() == y[::-1]
        beta = [np.zeros(3)]
        for t in range(b - 1, a, -1):
            beta.append(np.logaddexp.reduce(model.trans + emit[t] + beta[-1], axis=1))
        q = np.array(alpha) + np.array(beta[::-1])
        q = np.exp(q - np.logaddexp.reduce(q, axis=1)[:, None])
        np.testing.assert_allclose(p[a:b], q, atol=1e-8)


def test_training_learns_transitions_and_empty_input():
    rng = np.random.default_rng(3)
    y = np.tile([0, 1, 2, 0, 0], 200)
    x = np.where(rng.random(1000) < 0.9, y, rng.integers(0, 3, 1000))[:, None]
    first = np.zeros(1000, dtype=bool)
    first[::5] = True
    model = crf.train(x, y, first, 3, 4)
    got = crf.viterbi(model, model.weights[x].sum(axis=1), first)
    assert (got == y).mean() > 0.97
    assert model.trans[1, 2] > model.trans[1, 1]
    none = np.zeros(0, dtype=bool)
    assert len(crf.viterbi(model, np.zeros((0, 3)), none)) == 0 and crf.marginals(model, np.zeros((0, 3)), none).shape == (0, 3)
    assert not crf.train(np.zeros((0, 1), dtype=int), np.zeros(0, dtype=int), none, 3, 4).weights.any()
