"""The pipeline's stages on near copies, on null and repeated ids, on columns of any name."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from movecheck.llm import simhash
from movecheck.llm.rows import numbered
from tests.llm.conftest import HARD, SCHEMA, corpus, sentence


def plain_groups(rows):
    """Groups of rows by pairs of fingerprints within two bits."""
    prints = [simhash.fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return list(groups.values())


def near_copies():
    """Texts of 150 words and copies with one to six words replaced."""
    rng = random.Random(8)
    rows = []
    for base in range(12):
        words = sentence(rng, 150).split()
        for i in range(8):
            copy = list(words)
            for at in rng.sample(range(150), i):
                copy[at] = f"changed{base}{i}{at}"
            rows.append((10_000 + 100 * base + i, " ".join(copy), "en", "s0", 1, 0, "w", 0, 0, 0))
    return rows


def test_near_copies_go(spark, tmp_path):
    rows = near_copies() + corpus(40) + [r for r in HARD if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    groups = plain_groups(rows)
    assert len(groups) < len(rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(rows[i][0] for i in group) for group in groups)


CLASHING = ("_row", "_row_path", "_row_at", "_row_file", "_file", "_at", "_file_no", "domain", "fp", "component_id", "n_tokens", "mark")


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES], ids=lambda f: f.__name__)
def test_clashing_columns(spark, tmp_path, stage):
    plain = spark.createDataFrame(corpus(120), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(str(tmp_path / "plain"))
    plain.withColumns({c: F.lit(1) for c in CLASHING}).write.parquet(str(tmp_path / "more"))
    spark.createDataFrame([(r[0], 1, 0) for r in corpus(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    few, more = (stage(spark, spark.read.parquet(str(tmp_path / name)), str(tmp_path)) for name in ("plain", "more"))
    assert sorted(r["doc_id"] for r in few.collect()) == sorted(r["doc_id"] for r in more.collect())
    if stage is not corpus_pipeline.encode:
        assert more.columns == [*plain.columns, *CLASHING]


def test_numbers_are_stable_and_unique(spark, tmp_path):
    spark.range(1000).repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows, name = numbered(docs)
    first = {r["id"]: r[name] for r in rows.collect()}
    again, name = numbered(docs.filter("id % 2 = 0"))
    assert len(set(first.values())) == 1000
    assert all(first[r["id"]] == r[name] for r in again.collect())


def test_pipeline_without_rows(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_each_row_has_its_own_verdict(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    good = corpus(100)
    extra = lambda doc_id, text: (doc_id, text, *good[0][2:])
    twin, nameless = extra(7, sentence(rng, 80)), extra(None, sentence(rng, 90))
    bad = [extra(8, "too short"), extra(None, "short too")]
    copies = [extra(9, good[5][1]), extra(None, good[6][1])]
    spark.createDataFrame(good + [twin, nameless, *bad, *copies], SCHEMA).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    texts = lambda df: sorted((r["doc_id"] or -1, r["text"]) for r in df.collect())
    want = lambda rows: sorted((r[0] or -1, r[1]) for r in rows)
    assert texts(corpus_pipeline.filter_by_rules(spark, docs, "")) == want(good + [twin, nameless, *copies])
    assert texts(corpus_pipeline.drop_near_duplicates(spark, docs, "")) == want(good + [twin, nameless, *bad])
    assert texts(simhash.one_of_each(docs.filter("doc_id = 7"))) == want([good[7], twin])
    monkeypatch.setattr(corpus_pipeline, "MIXED", 1.0)
    assert texts(corpus_pipeline.mix(spark, docs, "")) == want(good + [twin, nameless, *bad, *copies])
