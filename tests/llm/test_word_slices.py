"""Words of batches that are read in several slices."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pyarrow as pa

from movecheck.llm import gru_lm
from movecheck.llm.text import slices


def plain_words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_words_of_every_slice():
    rng = random.Random(1)
    for letters in ("abAB  \n", "aÜé \x85K　"):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) for _ in range(300)]
        for some in (texts, [None if i % 11 == 0 else t for i, t in enumerate(texts)]):
            batch, at = pa.RecordBatch.from_arrays([pa.array(some)], ["text"]), 0
            for part in slices(batch, "text", 200):
                words, offsets = gru_lm.split_words(part.column(0))
                found = words.to_pylist()
                for a, b in zip(offsets[:-1], offsets[1:]):
                    assert found[a:b] == plain_words(some[at])
                    at += 1
            assert at == len(some)


def test_language_model_on_batches_of_many_slices(spark):
    # 24 MB in one task, in few words, so that the network has little to do.
    long = [chr(ord("A") + k) * 10_000 for k in range(8)]
    rows = [(i, f"Word{i} " + " ".join(long[(i + k) % 8] for k in range(1 + i % 8)) + f" Same{i % 7}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sum(len(text) for _, text in rows) > 2 * gru_lm.SLICE
    got = {r["doc_id"]: r for r in gru_lm.score_documents(docs, sample=20).collect()}
    counts = Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update([*plain_words(text), None])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        tokens, row = [*plain_words(text), None], got[doc_id]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 7 == 2) and row["train_tokens"] == n
        assert row["n_tokens"] == len(tokens) and row["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
