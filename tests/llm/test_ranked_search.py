"""Ranked search against scores of all documents in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from movecheck.llm import ranked_search as search
from tests.llm.conftest import HARD, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))


def plain(docs, items, top=20):
    """(item_id, rank, doc_id, score) of the best documents, by scoring all."""
    held = [(i, c) for i, c in ((i, terms(t)) for i, t in docs) if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item_id, text in items:
        asked, scored = terms(text), []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(n * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, n in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item_id, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def corpora():
    rng = random.Random(4)
    words = sentence(rng, 60).split() + ["the", "of", "É", "ß"]
    draw = lambda n: " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=n)).title()
    docs = [(rng.choice([None, i, i, i, i % 40]), draw(rng.randint(1, 60))) for i in range(500)]
    docs += [r[:2] for r in HARD] + [(2000 + i, "alone and equal") for i in range(60)] + [(1990, "Alone. And; EQUAL")]
    items = [(i, draw(rng.randint(1, 30))) for i in range(25)]
    items += [(3, "the the THE of"), (None, "equal"), (77, None), (78, ""), (79, "nowhere"), (80, "lorem x 12³ it's"), (3, "alone")]
    return docs, items


@pytest.mark.parametrize("shard, block, leaf", [(4096, 100_000, 1024), (32, 20, 4), (200, 60, 0)])
def test_equals_scoring_all(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(search, "LEAF", leaf)
    docs, items = corpora()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("row", "id", "n", "term", "tf", "shard")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "times", "df", "row")})
    got = search.ranked_search(frame, asked, shard=shard, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items)


def test_empty_tables(spark, no_docs):
    docs, items = corpora()
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert search.ranked_search(no_docs, asked).count() == 0
    assert search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), asked.limit(0)).count() == 0


def test_range_maxima_are_leftmost():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 200)
    table = search.range_maxima(values, 200)
    for _ in range(500):
        low, high = sorted(rng.choice(201, 2, replace=False))
        j = int(np.log2(high - low))
        a, b = table[j, low], table[j, high - (1 << j)]
        assert (a if values[a] >= values[b] else b) == low + values[low:high].argmax()


def test_bounds_cut_most_documents(monkeypatch):
    """With one clear winner, the search scores a few documents only."""
    n = 4000
    row = {
        "ids": list(range(n)), "lengths": np.full(n, 10), "terms": ["a", "b"], "sizes": np.array([n, n]),
        "places": np.tile(np.arange(n), 2), "counts": np.concatenate([np.where(np.arange(n) == 1234, 9, 1)] * 2),
    }
    monkeypatch.setattr(search, "LEAF", 8)
    shard = search.Shard(row, {"a": 500, "b": 700}, n, 10 * n)
    bounds = []
    bound = search.Shard.bound
    monkeypatch.setattr(search.Shard, "bound", lambda self, *a: bounds.append(1) or bound(self, *a))
    found = shard.search(search.Item(0, {"a": 1, "b": 2}), 1)
    assert [place for _, place in found] == [1234] and len(bounds) <= 3
    # Equal scores: the smallest ids, and nothing beyond them is visited.
    del bounds[:]
    row["counts"] = np.ones(2 * n, np.int64)
    found = search.Shard(row, {"a": 500, "b": 700}, n, 10 * n).search(search.Item(0, {"a": 1}), 20)
    assert sorted(place for _, place in found) == list(range(20)) and len(bounds) <= 45
