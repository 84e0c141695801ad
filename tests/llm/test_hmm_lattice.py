"""The Baum-Welch step of op1_hmm: right counts, and no backward array of the lattice's size."""

import tracemalloc

import numpy as np

from millrace.llm.hmm import CLASSES, END, STATES, Lattice, Model


def _model(rng):
    start = rng.random(STATES) + 0.1
    move = rng.random((STATES, STATES)) + 0.1
    emit = rng.random((CLASSES + 1, STATES)) + 0.1
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _plain(texts, model):
    """Forward-backward text by text in float64, without scaling tricks shared with the code under test."""
    start, move, emit = (x.astype(np.float64) for x in (model.start, model.move, model.emit))
    s, m, e = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))
    for text in texts:
        alpha = [start * emit[text[0]]]
        for c in text[1:]:
            alpha.append((alpha[-1] @ move) * emit[c])
        beta = [np.ones(STATES)]
        for c in text[:0:-1]:
            beta.insert(0, move @ (emit[c] * beta[0]))
        p = alpha[-1].sum()
        s += alpha[0] * beta[0] / p
        for t in range(1, len(text)):
            m += np.outer(alpha[t - 1], emit[text[t]] * beta[t]) * move / p
        for t, c in enumerate(text):
            e[c] += alpha[t] * beta[t] / p
    return s, m, e


def test_expected_counts_match_plain_forward_backward():
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, CLASSES, n), END).astype(np.int32) for n in (0, 1, 5, 12, 3, 12, 7)]
    model = _model(rng)
    got = Lattice(texts).expected(model)
    for mine, plain in zip(got, _plain(texts, model)):
        np.testing.assert_allclose(mine, plain, rtol=2e-4, atol=1e-6)


def test_expected_holds_no_backward_array():
    rng = np.random.default_rng(4)
    texts = [np.append(rng.integers(0, CLASSES, n), END).astype(np.int32) for n in rng.integers(50, 550, 2000)]
    lattice, model = Lattice(texts), _model(rng)
    tokens = sum(len(t) for t in texts)
    tracemalloc.start()
    lattice.expected(model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    one = tokens * STATES * 4  # float32 per token and state
    # Emissions, forward probabilities and their gathered copy for the transitions, plus small per-token vectors;
    # not a fourth such array for the backward probabilities.
    assert peak < 3.6 * one, (peak, one)
