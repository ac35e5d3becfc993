"""Vectors, conversations, and the pipeline."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from movecheck.llm import adaptive_scan, chat_template

KINDS = "conv_id long, turn long, role string, text string, part int, loss int"


def brute(ids, vectors, query, vector):
    far = np.sqrt(np.square(vectors - vector).sum(1))
    best = {}
    for i, d in zip(ids, far):
        if i != query:
            best[i] = min(d, best.get(i, d))
    return sorted((d, i) for i, d in best.items())[:10]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((8, 32))
    x = (centres[rng.integers(0, 8, 3000)] + 0.6 * rng.standard_normal((3000, 32))).astype(np.float32)
    x[500:900] = x[500]
    rows = [(i, [float(v) for v in row], 0, 0) for i, row in enumerate(x)]
    hard = [
        (9000, None, 0, 0), (9100, [0.0] * 32, 0, 0), (9200, [float("nan")] * 32, 0, 0), (9300, [1.0, 2.0], 0, 0),
        (9400, [None] * 32, 0, 0), (None, [1.0] * 32, 0, 0), rows[7], (9500, [float("inf")] * 32, 0, 0),
    ]
    frame = spark.createDataFrame(rows + hard, "vec_id long, embedding array<float>, list int, block int")
    got = {}
    for r in adaptive_scan.nearest_neighbours(frame).collect():
        got.setdefault(r["query_id"], []).append(r)
    assert sorted(got) == list(range(0, 3000, 100))
    ids, hits = np.arange(3000), 0
    for query, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        want = brute(ids, x.astype(float), query, x[query].astype(float))
        hits += len({r["vec_id"] for r in found} & {i for _, i in want})
        for r in found:
            exact = np.sqrt(np.square(x[r["vec_id"]].astype(float) - x[query].astype(float)).sum())
            assert abs(r["score"] - exact) < 1e-12
        assert [(r["score"], r["vec_id"]) for r in found] == sorted((r["score"], r["vec_id"]) for r in found)
    assert hits >= 0.9 * 10 * len(got)


def test_repeated_rows_leave_room_for_others(spark):
    """Twelve rows of every vector: the ten nearest ids, not ten rows of the nearest."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] * 12
    got = {}
    for r in adaptive_scan.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(got) == list(range(0, 1500, 100)) and all(len(found) == 10 for found in got.values())
    hits = sum(len(got[q] & {i for _, i in brute(np.arange(1500), x.astype(float), q, x[q].astype(float))}) for q in got)
    assert hits >= 0.9 * 10 * len(got)


@pytest.mark.parametrize("n", [1500, 6000])
def test_results_come_from_the_scan(spark, n):
    """Recall of the scan on tables far above the sample, which gives bounds only."""
    rng = np.random.default_rng(n)
    x = (rng.standard_normal((12, 24))[rng.integers(0, 12, n)] + 0.7 * rng.standard_normal((n, 24))).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in adaptive_scan.nearest_neighbours(frame, sample=400).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(got) == list(range(0, n, 100)) and all(len(found) == 10 for found in got.values())
    hits = sum(len(got[q] & {i for _, i in brute(np.arange(n), x.astype(float), q, x[q].astype(float))}) for q in got)
    assert hits >= 0.9 * 10 * len(got)


def test_a_bound_needs_ten_of_the_sample():
    """A query probes on until its lists hold ten of the sample, or all of them."""
    sample = np.arange(24, dtype=float)[:, None]
    index = adaptive_scan.Index(np.eye(1), np.array([[0.0], [8.0], [23.0]]), np.arange(24), sample, np.zeros(0), 1)
    index.sample_lists = index.own_lists(sample)
    order = index.order_of(sample[:1])[0]
    lists, bound = index.probes(0, sample[0], order, 10)
    assert lists.tolist() == [0, 1] and bound == 10.0
    lists, bound = index.probes(0, sample[0], order, 24)
    assert lists.tolist() == [0, 1, 2] and bound == float("inf")


def test_few_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (100, [1.0, 0.0])], kind)
    got = adaptive_scan.nearest_neighbours(few).collect()
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in got} == {
        (0, 1): 100, (0, 2): 2, (0, 3): 1, (100, 1): 0, (100, 2): 2, (100, 3): 1,
    }
    assert adaptive_scan.nearest_neighbours(few.limit(0)).count() == 0


def digests(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
        len(loss), hashlib.sha256(loss.encode()).hexdigest(),
    )


def test_conversations(spark):
    rng = random.Random(1)
    bits = ["\\", "<turn>", "</turn>", "\\n", "\n", "é", "x", "</turn>\n<turn>assistant\n", ""]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", "\\n"]), text(), 0, 0) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "user", "a", 0, 0), (None, None, None, None, None, None), (70, 1, "assistant", "b" * 200_000, 0, 0), (70, 1, "assistant", "b", 0, 0), (70, 1, "assistant", "b", 0, 0)]
    got = {r["conv_id"]: r for r in chat_template.chat_digests(spark.createDataFrame(rows, KINDS)).collect()}
    turns = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    low = lambda v: (v is not None, v if v is not None else 0)
    word = lambda v: (v is not None, (v or "").encode())
    for c, t, r, x, *_ in sorted(rows, key=lambda q: (low(q[1]), word(q[2]), word(q[3]))):
        turns.setdefault(c, []).append((r, x))
    assert set(got) == set(turns)
    for c, own in turns.items():
        assert tuple(got[c])[1:5] == digests(own)
    assert chat_template.chat_digests(spark.createDataFrame([], KINDS)).count() == 1


def rendered(source, **values):
    return "".join(t for t, _ in chat_template.compile_template(source)(values))


def test_template_language():
    assert rendered("{{ 'a' + 'b' | upper }}{% if not false and 1 < 2 %}x{% else %}y{% endif %}") == "aBx"
    assert rendered("{% for m in ms %}{{ m.k }}{% if loop.last %}.{% elif loop.first %}!{% else %},{% endif %}{% endfor %}", ms=[{"k": c} for c in "abc"]) == "a!b,c."
    tree = chat_template.fold_block(chat_template.parse("a{{ 'b' }}{% if 1 == 2 %}c{% else %}d{% endif %}e"))
    assert tree == (chat_template.Text("abde"),)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ missing }}", "{{ open('f') }}", "{{ x | system }}", "{% while 1 %}", "{% if 1 %}"])
def test_sandbox(source):
    with pytest.raises(chat_template.TemplateError):
        rendered(source, x="text")


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline
    from tests.llm.conftest import corpus

    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in corpus()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, folder)
        assert after.columns == docs.columns
        after.write.parquet(f"{folder}/{len(name)}-{name}")
        frame = spark.read.parquet(f"{folder}/{len(name)}-{name}")
    final = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in final.collect()} == {r["doc_id"] for r in frame.collect()}
    assert final.count() > 150
