"""Exact duplicates against plain Python, colliding digests and hard rows included."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from movecheck.llm.exact_dedup import exact_duplicates, id_of, rank_of
from tests.conftest import plan_of
from tests.llm.conftest import HARD, SCHEMA, corpus

BARE = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def plain(rows):
    """(doc_id, keep_id, group_size, sha256) of every row, and how many of each group stay."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(BARE), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        content = (text or "").translate(BARE)
        best = min(groups[content])
        out.append((doc_id, None if best[1] else best[2], len(groups[content]), hashlib.sha256(content.encode()).hexdigest()))
    return out, len(groups)


def varied():
    rng = random.Random(5)
    rows = [r[:2] for r in corpus(60) + HARD]
    for i in range(300):
        text = rows[rng.randrange(12)][1]
        rows.append((rng.choice([None, 7000 + i % 90, -i]), (text or "").replace(" ", rng.choice([" ", "\t ", "\n", ""]))))
    return rows + [(9, "a\x0b\x0cb"), (9, "ab "), (9, " ab"), (9, "ab "), (None, "\x1cab"), (3, "a b"), (2, "a b")]


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.char_length(c) % 5, lambda c: F.lit(1)])
def test_equals_plain_python(spark, digest):
    rows = varied()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_duplicates(frame, digest, salts=3).collect()
    want, n_groups = plain(rows)
    key = lambda r: tuple((x is not None, x or 0) for x in r[:3]) + (r[3],)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=key) == sorted(want, key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == n_groups
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_clashing_columns_and_no_rows(spark, docs, no_docs):
    assert exact_duplicates(docs).count() == docs.count()
    extra = docs.withColumns({c: F.lit(1) for c in ("digest", "content", "rank", "row", "salt", "best", "kept", "clash")})
    assert exact_duplicates(extra).count() == docs.count()
    none = exact_duplicates(no_docs)
    assert none.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and none.count() == 0


def test_hot_groups_need_no_skew_handling(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  text")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_duplicates(rows)
    assert got.filter("kept").count() == 4001
    assert got.filter("keep_id = 0 and group_size = 2000").count() == 2000


def test_ranks(spark):
    rows = [(5, 3), (5, -3), (5, None), (5, (1 << 63) - 1), (5, -(1 << 63)), (4, -9), ((1 << 31) - 1, 0)]
    frame = spark.createDataFrame(rows, "n int, doc_id long").withColumn("rank", rank_of(F.col("n"), F.col("doc_id")))
    ordered = frame.withColumn("again", id_of(F.col("rank"))).orderBy(F.desc("rank")).collect()
    assert [(r["n"], r["again"]) for r in ordered] == [(r["n"], r["doc_id"]) for r in ordered]
    assert [r["doc_id"] for r in ordered] == [0, -(1 << 63), -3, 3, (1 << 63) - 1, None, -9]


def test_no_python_in_the_plan(spark, docs):
    assert "Python" not in plan_of(exact_duplicates(docs)) and "Arrow" not in plan_of(exact_duplicates(docs))
