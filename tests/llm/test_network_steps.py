"""Steps of the language model's network: few calls where few lanes run, right gradients."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from movecheck.llm import gru_lm


def some_weights(seed):
    return (np.random.default_rng(seed).standard_normal(gru_lm.SIZE) * 0.3).astype(np.float32)


def test_few_lanes_are_scored_in_few_windows(monkeypatch):
    """Before, every 16 steps went through all classes, however few lanes were left."""
    calls, output = [], gru_lm.output
    monkeypatch.setattr(gru_lm, "output", lambda net, states, *rest: calls.append(len(states)) or output(net, states, *rest))
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, gru_lm.SYMBOLS, n) for n in [20_000] + [30] * 200]
    together = gru_lm.log_likelihoods(some_weights(1), texts)
    assert sum(calls) == sum(map(len, texts))
    assert max(calls) <= gru_lm.WINDOW * gru_lm.LANES and len(calls) < 10
    short = gru_lm.log_likelihoods(some_weights(1), texts[1:])
    assert np.abs(together[1:] - short).max() < 0.05


def test_windows_cover_all_steps():
    for width in ([1], [5, 5, 3, 1, 1], [9] * 40 + [1] * 70):
        for steps, rows in ((1, 1), (16, 9), (3, 1000), (1000, 20)):
            found = list(gru_lm.windows(np.array(width), steps, rows))
            assert [t for a, b in found for t in range(a, b)] == list(range(len(width)))
            assert all(b - a <= steps and (sum(width[a:b]) <= rows or b == a + 1) for a, b in found)


def plain_loss(weights, lanes, read, stop):
    """Mean negative log likelihood of the first steps, a number at a time, in doubles."""
    net, k, total, tokens = gru_lm.Network(weights), gru_lm.HIDDEN, 0.0, 0
    for lane in range(lanes.symbols.shape[1]):
        h = np.zeros(k)
        for t in range(stop):
            if lane >= lanes.width[t]:
                break
            h = np.zeros(k) if lanes.fresh[t, lane] else h
            x, hu = net.into[read[t, lane]], h @ net.back
            z, r = (1 / (1 + np.exp(-(x + hu)[at : at + k])) for at in (0, k))
            h = (1 - z) * np.tanh(x[2 * k :] + r * hu[2 * k :]) + z * h
            c, w = divmod(int(lanes.symbols[t, lane]), gru_lm.PER_CLASS)
            for logits, at in ((h @ net.class_w + net.class_b, c), (h @ net.word_w[c] + net.word_b[c], w)):
                total -= logits[at] - np.log(np.exp(logits).sum())
            tokens += 1
    return total / tokens


@pytest.mark.parametrize("part", gru_lm.PARTS)
def test_gradient_is_that_of_plain_steps(part):
    rng = np.random.default_rng(4)
    # Two lanes; documents end, begin and run out within the window.
    texts = [rng.integers(0, gru_lm.SYMBOLS, n) for n in (1, 2, 5, 3, 12, 9)]
    weights, lanes = some_weights(2), gru_lm.lay_out(texts, lanes=3)
    stop = min(gru_lm.WINDOW, len(lanes.symbols))
    assert lanes.width[stop - 1] < lanes.width[0] and lanes.fresh[1:stop].any()
    runner = gru_lm.Runner(gru_lm.Network(weights), lanes)
    gradient, tokens = gru_lm.window_gradient(runner, 0, stop)
    assert tokens == lanes.width[:stop].sum()
    direction = np.zeros(gru_lm.SIZE)
    getattr(gru_lm.Network(direction), part)[...] = rng.standard_normal(gru_lm.PARTS[part])
    up, down = (plain_loss(weights + step * direction, lanes, runner.read, stop) for step in (1e-4, -1e-4))
    assert gradient @ direction == pytest.approx((up - down) / 2e-4, rel=2e-3, abs=2e-4)


def test_places_of_words():
    vocabulary = gru_lm.Vocabulary(["b", "a", "ß"], np.array([3, 2, 1]), 1, 7, 4)
    words = pa.array(["a", "ß", "x", "b", "a"], pa.large_string())
    assert vocabulary.codes(words).tolist() == [1, 2, -1, 0, 1]
    assert vocabulary.codes(words, 1).tolist() == [-1, -1, -1, 0, -1]
    assert vocabulary.codes(words[:0]).tolist() == []
