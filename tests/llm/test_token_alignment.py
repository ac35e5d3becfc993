"""Alignment of tokenizers against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from movecheck.llm import token_alignment as alignment
from tests.llm.conftest import HARD, corpus

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "▁", " ", "  ", "\n", "\n\n", "\t", "é", "漢字", "🙂", "<0x41>", "<s>", "<|endoftext|>", "it's I'LL", "12³", "x" * 30,
    "\x00", "\x1c\x85", "of the", "\r\n", " \n ", "a", "ﬁ", "　", " .", "...",
]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(text, libraries):
    """[(id, bytes)] of both tokenizers by the libraries alone; none if the bytes differ."""
    first, second = libraries
    if not text:
        return [], []
    letters = alignment.byte_letters()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [
        (i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
        for i in second.encode(text)
    ]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else ([], [])


def plain_groups(a, b):
    """[(ids of A, ids of B)], by walking both sides."""
    groups, i, j = [], 0, 0
    while i < len(a):
        one, two = [a[i][0]], [b[j][0]]
        at, to = len(a[i][1]), len(b[j][1])
        i, j = i + 1, j + 1
        while at != to:
            if at < to:
                one.append(a[i][0])
                at, i = at + len(a[i][1]), i + 1
            else:
                two.append(b[j][0])
                to, j = to + len(b[j][1]), j + 1
        groups.append((one, two))
    return groups


def plain(texts, libraries):
    """The result's columns but doc_id for every text."""
    cut = []
    for text in texts:
        a, b = plain_tokens(text, libraries)
        cut.append((len(a), len(b), plain_groups(a, b)))
    links = [Counter((x, y) for one, two in groups for x in one for y in two) for *_, groups in cut]
    held = Counter(pair for own in links for pair in own)
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (n_a, n_b, groups), own in zip(cut, links):
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        out.append((
            n_a, n_b, len(groups), sum(own.values()), sum(n for p, n in own.items() if held[p] == most[p[0]]),
            sum(n * held[p] for p, n in own.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def hostile(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("block", [4 << 20, 500])
def test_equals_plain_python(spark, monkeypatch, libraries, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 6)
    texts = [r[1] for r in corpus(30) + [h for h in HARD if len(h[1] or "") < 100_000]] + hostile(400)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, texts[2])] * 2
    want = sorted(((i is not None, i or 0), *r) for (i, _), r in zip(rows, plain([t for _, t in rows], libraries)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("block", "pairs", "at", "n")})
    got = alignment.aligned_tokens(frame, A, B)
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(((r[0] is not None, r[0] or 0), *tuple(r)[1:]) for r in got.collect()) == want


def test_groups_column(spark, libraries):
    texts = hostile(200, 5) + [None, ""]
    got = alignment.aligned_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), A, B)
    for r in got.collect():
        a, b = plain_tokens(texts[r["doc_id"]], libraries)
        assert [(g["a"], g["b"]) for g in r["groups"]] == plain_groups(a, b)
        sizes = dict(a)
        ends = np.cumsum([sum(len(sizes[i]) for i in g["a"]) for g in r["groups"]]).tolist()
        assert [g["end"] for g in r["groups"]] == ends


def test_cuts_of_any_sides():
    rng = np.random.default_rng(0)
    for _ in range(300):
        total = int(rng.integers(1, 400))
        sides = [np.unique(np.append(rng.integers(1, total + 1, int(rng.integers(0, 1 + total // d))), total)) for d in rng.integers(1, 40, 2)]
        groups = alignment.groups_of(*sides, *[np.array([0, len(s)]) for s in sides])
        common = np.intersect1d(*sides)
        assert sides[0][groups[:, 1] - 1].tolist() == common.tolist()
        assert sides[1][groups[:, 3] - 1].tolist() == common.tolist()
        assert groups[0, 0] == 0 and (groups[1:, 0] == groups[:-1, 1]).all() and (groups[1:, 2] == groups[:-1, 3]).all()


def test_large_groups_and_long_texts(libraries):
    """A group's pairs are counted by distinct ids; caches forget."""
    found = alignment.Aligned(
        np.tile([5, 6, 5], 200), np.array([0, 600]), np.tile([1, 2], 150), np.array([0, 300]), np.array([[0, 600, 0, 300]]), np.zeros(0)
    )
    keys, times = alignment.pairs_of(found)
    assert dict(zip([(int(k) >> 20 & 0xFFFFF, int(k) & 0xFFFFF) for k in keys], times.tolist())) == {(5, 1): 60000, (5, 2): 60000, (6, 1): 30000, (6, 2): 30000}
    long = "lorem ipsum " * 20_000 + "y" * 50_000
    found = alignment.align([long, long[:7]], A, B)
    want = [i for i, _ in plain_tokens(long[:40_000], libraries)[0]]
    assert found.ids_a[:5000].tolist() == want[:5000]


def test_empty_table(spark, docs, no_docs):
    assert alignment.aligned_tokens(no_docs, A, B).count() == 0


def test_rows_of_a_block_are_small(spark, monkeypatch, libraries):
    """A block's links are dealt over several rows, and the sums stay those of the whole block."""
    for name, value in {"BLOCK": 20_000, "SLICE": 700, "CHUNK": 60}.items():
        monkeypatch.setattr(alignment, name, value)
    texts = [r[1] for r in corpus(20)] + hostile(200, 9) + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sizes = alignment.aligned_blocks(frame, A, B).selectExpr("block", "size(doc_ids) as n", "size(at) as places", "size(pairs) as pairs").collect()
    assert sum(r["n"] for r in sizes) == len(texts) and len({r["block"] for r in sizes}) < len(sizes)
    assert all(r["places"] <= 60 or r["n"] == 1 for r in sizes)
    got = sorted(tuple(r) for r in alignment.aligned_tokens(frame, A, B).collect())
    assert got == [(i, *r) for i, r in enumerate(plain(texts, libraries))]


def test_a_block_is_cut_in_small_slices():
    """Arrays of a slice, not of a block, are held at a time: 65 MB, and 145 for the block at once."""
    words = [f"word{i % 9973} and" for i in range(250_000)]
    texts = pa.record_batch([pa.array(range(250)), pa.array([" ".join(words[1000 * i : 1000 * (i + 1)]) for i in range(250)])], ["doc_id", "text"])
    assert 3 << 20 < texts.nbytes < alignment.BLOCK
    alignment.align(["word"], A, B)
    tracemalloc.start()
    columns, keys, times = alignment.block_links(texts, A, B, alignment.SLICE)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    whole, all_keys, all_times = alignment.block_links(texts, A, B, alignment.BLOCK)
    assert (keys == all_keys).all() and (times == all_times).all() and all((columns[c] == whole[c]).all() for c in columns)


def test_remembered_runs_take_bounded_bytes(monkeypatch):
    """Both tokenizers forget by bytes; the first one counted slices, whatever their length, and kept long ones."""
    monkeypatch.setattr(alignment, "REMEMBERED", 20_000)
    first, second = alignment.ByteLevel.load.__wrapped__(alignment.ByteLevel, A), alignment.Pieces(B)
    rng = random.Random(1)
    for _ in range(20):
        texts = [" " + "".join(rng.choice("abcdefgh") for _ in range(rng.choice([9, 20, 5000]))) for _ in range(40)]
        ids, ends = first.encode(texts)
        assert second.encode(texts)[1][-1] > 0
        again, stops = alignment.ByteLevel.load(A).encode(texts)
        assert (ids == again).all() and (ends == stops).all()
        for held in (first.merger.remembered.cache, second.remembered.cache):
            assert sum(len(run) + len(ids) for run, ids in held.items()) < 20_000 and max(map(len, held), default=0) <= alignment.LONG_RUN
        assert not first.merger.cache
