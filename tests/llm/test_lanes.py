"""Lanes of the language model: memory follows the tokens."""

from __future__ import annotations

import numpy as np

from movecheck.llm import gru_lm


def test_one_long_text_beside_short_ones():
    texts = [np.zeros(n, np.int64) for n in [50_000] + [5] * 383]
    lanes = gru_lm.lay_out(texts)
    assert lanes.symbols.size <= 3 * sum(map(len, texts)) + 50_000
    assert len(lanes.symbols) == 50_000
    assert lanes.width.sum() == sum(map(len, texts))


def test_texts_in_few_lanes_score_as_alone():
    rng = np.random.default_rng(1)
    weights = (rng.standard_normal(gru_lm.SIZE) * 0.3).astype(np.float32)
    texts = [rng.integers(0, gru_lm.SYMBOLS, n) for n in [900] + [1, 7, 33] * 40 + [450]]
    together = gru_lm.log_likelihoods(weights, texts)
    alone = np.concatenate([gru_lm.log_likelihoods(weights, [t]) for t in texts])
    assert np.abs(together - alone).max() < 0.05
