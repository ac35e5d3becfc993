"""Operators on documents against brute force, on plain and hard rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from movecheck.llm import byte_bpe, gam, gru_lm, license_scan, mixing, orc_tokens, quality_rules, simhash
from tests.llm.conftest import HARD, corpus, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = corpus() + HARD


def keyed(df):
    """Rows by (doc_id, place among equal ids); equal rows have equal results."""
    out = {}
    for row in df.collect():
        out.setdefault(row["doc_id"], []).append(row)
    return out


# --- quality rules ----------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts(docs):
    got = keyed(quality_rules.base_counts(docs))
    for doc_id, text, *_ in ROWS:
        want = plain_counts(text)
        rows = [tuple(r[c] for c in quality_rules.BASE) for r in got[doc_id]]
        assert want in rows
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert any(r["base_failed"] == failed for r in got[doc_id])


def test_counts_of_lines_and_repeats():
    from movecheck.llm.text import text_counts

    text = "a b c d\n\na b c d\nx # y|\n a b c\n"
    found = text_counts(text)
    assert tuple(found[c] for c in quality_rules.BASE) == plain_counts(text)


def test_outliers_go_and_plain_texts_stay(spark):
    rows = corpus(400)
    junk = [(5000 + i, " ".join(w.upper() + "###" for w in r[1].split()), *r[2:]) for i, r in enumerate(rows[:40])]
    from tests.llm.conftest import SCHEMA

    got = keyed(quality_rules.quality_rules(spark.createDataFrame(rows + junk, SCHEMA)))
    assert all(got[r[0]][0]["kept"] for r in rows)
    assert not any(got[r[0]][0]["kept"] for r in junk)


def floored(cov):
    """Raised to one floor in every direction, and how much of it was estimated."""
    size = np.diag(1 / np.array(quality_rules.FLOORS))
    values, axes = np.linalg.eigh(size @ cov @ size)
    raised = axes @ np.diag(np.maximum(values, 1)) @ axes.T
    back = np.diag(quality_rules.FLOORS)
    return back @ raised @ back, np.clip(values, 0, 1).sum()


def plain_distances(x, steps):
    """Scaled squared distances by concentration steps over sorted rows."""
    found = []
    spread = (np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349
    for mean, cov in ((np.median(x, 0), np.diag(spread**2)), (x.mean(0), np.cov(x.T, bias=True))):
        for step in range(steps + 1):
            fixed, free = floored(cov)
            far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(fixed), x - mean)
            if step < steps:
                inner = x[np.argsort(far, kind="stable")[: int(quality_rules.SHARE * len(x))]]
                mean, cov = inner.mean(0), np.cov(inner.T, bias=True)
        found.append((np.linalg.slogdet(fixed)[1], far, max(free, 1.0)))
    _, far, free = min(found, key=lambda f: f[0])
    return far / np.median(far) * quality_rules.chi_square(0.5, free)


def test_verdicts_equal_plain_steps(spark):
    from movecheck.llm.text import text_counts
    from tests.llm.conftest import SCHEMA

    rng = np.random.default_rng(4)
    rows = []
    for i, row in enumerate(corpus(500)):
        words = row[1].split()
        for j in rng.integers(0, len(words), int(rng.integers(0, 9)) * (i % 3 == 0)):
            words[j] = words[j].upper() + "#" * int(rng.integers(0, 6))
        rows.append((i, " ".join(words), "en", "one", *row[4:]))
    counts = [text_counts(r[1]) for r in rows]
    failed = [c["n_words"] < 50 or 2 * c["n_repeat_words"] > c["n_words"] for c in counts]
    passing = [i for i, bad in enumerate(failed) if not bad]
    x = np.array([quality_rules.transformed(counts[i]) for i in passing])
    far = dict(zip(passing, plain_distances(x, quality_rules.STEPS)))
    limit = quality_rules.chi_square(quality_rules.TAIL, x.shape[1])
    got = keyed(quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)))
    verdicts = {True: 0, False: 0}
    for i in range(len(rows)):
        if failed[i]:
            assert not got[i][0]["kept"]
        # Bins are a sixteenth of an octave wide, so distances agree to a few per cent.
        elif not 0.85 < far[i] / limit < 1.18:
            assert got[i][0]["kept"] == (far[i] <= limit), (i, far[i], got[i][0]["distance"])
            verdicts[got[i][0]["kept"]] += 1
    assert verdicts[True] > 100 and verdicts[False] > 10


def test_concentration_lowers_the_determinant(spark):
    rng = np.random.default_rng(0)
    d = len(quality_rules.FEATURES)
    clean, dirty = rng.standard_normal((400, d)) * 0.3, rng.standard_normal((100, d)) * 0.3 + 4
    x = np.concatenate([clean, dirty])
    vectors = spark.createDataFrame(
        [("en", "s", *map(float, row)) for row in x],
        "lang string, source string, " + ", ".join(f"{c} double" for c in quality_rules.FEATURES),
    )
    found = {r["grp"]: r for r in quality_rules.minimum_determinants(vectors).collect()}
    center = np.array(found["all"]["center"])
    # Brute force: concentration steps in numpy from the median.
    inner = x
    h = int(0.75 * len(x))
    mean, cov = np.median(x, 0), np.eye(d)
    for _ in range(30):
        far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        inner = x[np.argsort(far)[:h]]
        mean, cov = inner.mean(0), floored(np.cov(inner.T, bias=True))[0]
    assert np.abs(center - mean).max() < 0.05
    assert np.abs(center).max() < 0.2


def test_rules_on_hard_rows(docs, no_docs):
    got = quality_rules.quality_rules(docs)
    assert got.count() == len(ROWS)
    assert not any(r["kept"] for r in keyed(got)[1002])
    assert quality_rules.quality_rules(no_docs).count() == 0


# --- SimHash ----------------------------------------------------------------


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {fp: fp for fp in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = list(prints)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    groups = {}
    for fp, ids in prints.items():
        groups.setdefault(root(fp), []).extend(ids)
    return {i: min(g) for g in groups.values() for i in g}


def test_near_duplicates(spark):
    from tests.llm.conftest import SCHEMA
    import random

    rng = random.Random(5)
    rows = [r for r in ROWS if r[0] is not None and len(r[1] or "") < 10_000]
    base = sentence(rng, 400).split()
    for i in range(60):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(400)] = "changed"
        rows.append((3000 + i, " ".join(copy), *rows[0][2:]))
    prints = {}
    for r in rows:
        prints.setdefault(plain_fingerprint(r[1]), []).append(r[0])
    want = brute_components(prints)
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["doc_id"] in prints[int(r["fingerprint"], 16)]


def test_links_in_crowded_keys(spark):
    """Many fingerprints under one key: midpoints give the same components as pairs."""
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 62, 4)
    values = sorted({int(s) ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)) for s in seeds for k in (0, 1, 2, 3) for _ in range(40)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    for paired in (2, 1000):
        found = simhash.components(simhash.links(frame, paired=paired)).collect()
        got = {r["node"]: r["root"] for r in found}
        want = brute_components({v: [v] for v in values})
        assert all(got.get(v, v) == want[v] for v in values)


def test_one_of_each(docs, no_docs):
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert 1001 in kept and 1002 not in kept and kept.count(1004) == 1 and kept.count(None) == 1
    assert simhash.one_of_each(no_docs).count() == 0


# --- encoders ---------------------------------------------------------------


def test_byte_bpe(docs, no_docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = keyed(byte_bpe.round_trip(docs, path))
    for doc_id, text, *_ in ROWS:
        ids = library.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert want in [tuple(r)[1:] for r in got[doc_id]]
    assert byte_bpe.round_trip(no_docs, path).count() == 0


def test_pre_tokens_keep_offsets(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for row in byte_bpe.encoded(docs.filter("doc_id < 40"), path).collect():
        text = next(r[1] for r in ROWS if r[0] == row["doc_id"]).encode()
        cuts = [*row["offsets"], len(text)]
        assert cuts[0] == 0 and b"".join(text[a:b] for a, b in zip(cuts, cuts[1:])) == text


def test_automaton_composes():
    of_symbol, composition, image, moves, _ = byte_bpe.automaton()
    rng = np.random.default_rng(1)
    for _ in range(50):
        symbols = rng.integers(0, len(of_symbol), 12)
        f, state = 0, byte_bpe.T_START
        for s in symbols:
            f, state = composition[f, of_symbol[s]], moves[state, s]
        assert image[f] == state


def test_special_strings_as_the_library_has_them(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(4)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", "a", " ", "It's", "\n", "12", "é"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    for special_as_text in (False, True):
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = special_as_text
        ids, offsets = orc_tokens.WordEncoder(path, special_as_text).encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents_are_read_by_their_stripes(spark, tmp_path):
    path, target = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "t")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    orc_tokens.write_token_files(docs, target, path)
    found = orc_tokens.read_documents(spark, target, [77, 12_345, 30_000])
    library = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["ids"] for r in found.collect()}
    assert got == {i: [*library.encode(f"text {i}", add_special_tokens=False).ids, 1] for i in (77, 12_345)}
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() <= 3 * orc_tokens.ROW_INDEX


def test_orc_tokens(docs, no_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    target = str(tmp_path / "tokens")
    got = sorted(orc_tokens.token_files(docs, path, target).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([r[0] for r in ROWS], key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        wants = []
        for doc_id, text, *_ in ROWS:
            if doc_id == r["doc_id"]:
                ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
                wants.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        assert (r["n_tokens"], r["ids_crc32"]) in wants
    assert orc_tokens.token_files(no_docs, path).count() == 0
    one = docs.sparkSession.read.orc(target).filter("doc_id = 7")
    assert one.count() == 1


# --- classifier, language model ---------------------------------------------


def test_classifier(spark, no_docs):
    from tests.llm.conftest import SCHEMA

    good = corpus(300)
    bad = [(6000 + i, " ".join(w + "$$$" for w in r[1].split()), *r[2:]) for i, r in enumerate(good[:150])]
    docs = spark.createDataFrame(good + bad + HARD, SCHEMA)
    labels = spark.createDataFrame(
        [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad] + [(None, 1, None), (7, None, None), (9, 5, 5)],
        "doc_id long, quality int, toxic int",
    )
    got = gam.classify_quality(docs, labels).collect()
    assert len(got) == len(good + bad + HARD)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] not in range(1000, 1010):
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
            assert r["predicted"] == int(r["doc_id"] < 1000)
    unlabelled = gam.classify_quality(docs, labels.limit(0))
    assert {r["score"] for r in unlabelled.collect()} == {0.5}
    assert gam.classify_quality(no_docs, labels).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(4)
    x = np.zeros((4000, len(gam.FEATURES)))
    x[:, 0], x[:, 1] = rng.random(4000), rng.random(4000)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_language_model(docs, no_docs):
    got = keyed(gru_lm.score_documents(docs, sample=40))
    training, counts = set(), Counter()
    for doc_id, text, *_ in ROWS:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            counts[None] += 1
            training.add(doc_id)
    n, v = sum(counts.values()), len(counts)
    for doc_id, text, *_ in ROWS:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        row = min(got[doc_id], key=lambda r: (abs(r["base_score"] - base), r["n_tokens"]))
        assert abs(row["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert row["n_tokens"] == len(tokens) and row["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert row["train_tokens"] == n and row["held_out"] == (doc_id not in training)
        assert row["score"] <= 0
    assert gru_lm.score_documents(no_docs).count() == 0


def test_network_beats_the_base_on_held_out_documents(spark):
    """Words that follow each other in rings: counts cannot tell, the network can."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        ring, at = rng.randrange(3), rng.randrange(8)
        rows.append((i, " ".join(f"w{ring}{(at + k) % 8}" for k in range(rng.randint(30, 60)))))
    scored = gru_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), sample=100).collect()
    held_out = [r for r in scored if r["held_out"]]
    assert held_out and all(r["n_known"] == r["n_tokens"] for r in held_out)
    assert sum(r["score"] for r in held_out) > 0.7 * sum(r["base_score"] for r in held_out)


def test_state_is_carried_across_windows():
    rng = np.random.default_rng(0)
    weights = (rng.standard_normal(gru_lm.SIZE) * 0.3).astype(np.float32)
    texts = [rng.integers(0, gru_lm.SYMBOLS, n) for n in (1, 70, 33, 5, 16)]
    together = gru_lm.log_likelihoods(weights, texts)
    net = gru_lm.Network(weights.astype(float))
    for text, found in zip(texts, together):
        h, before, total = np.zeros(gru_lm.HIDDEN), gru_lm.END, 0.0
        for s in text:
            x, hu, k = net.into[before], h @ net.back, gru_lm.HIDDEN
            z, r = 1 / (1 + np.exp(-(x[:k] + hu[:k]))), 1 / (1 + np.exp(-(x[k : 2 * k] + hu[k : 2 * k])))
            m = np.tanh(x[2 * k :] + r * hu[2 * k :])
            h, before = (1 - z) * m + z * h, s
            c, w = divmod(int(s), gru_lm.PER_CLASS)
            lc, lw = h @ net.class_w + net.class_b, h @ net.word_w[c] + net.word_b[c]
            total += lc[c] - np.log(np.exp(lc).sum()) + lw[w] - np.log(np.exp(lw).sum())
        assert abs(total - found) < 1e-3 * len(text)


# --- licenses, mixing -------------------------------------------------------


def test_licenses(spark, docs, no_docs):
    assert license_scan.scan_licenses(docs).count() == 0 and license_scan.scan_licenses(no_docs).count() == 0
    rows = []
    for i, (name, text) in enumerate(license_scan.LICENSES):
        rows += [(i, f"before it {sentence(__import__('random').Random(i), 30)}\n{text} and after it", name)]
        words = text.split()
        if len(words) > 30:
            words[len(words) // 2] = "changed"
            rows.append((100 + i, "x " * 7 + " ".join(words), name))
    frame = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan_licenses(frame).collect()}
    for doc_id, _, name in rows:
        assert found[doc_id, name] == 1.0 if doc_id < 100 else 0.8 <= found[doc_id, name] < 1.0


def water_fill(budget, children):
    """Shares by repeated rounds: (weight, supply) to tokens, not rounded."""
    given = [0.0] * len(children)
    open_ones = set(range(len(children)))
    while open_ones:
        total = sum(children[i][0] for i in open_ones)
        left = budget - sum(given[i] for i in range(len(children)) if i not in open_ones)
        full = {i for i in open_ones if children[i][1] <= left * children[i][0] / total + 1e-9}
        if not full:
            for i in open_ones:
                given[i] = left * children[i][0] / total
            break
        for i in full:
            given[i] = children[i][1]
        open_ones -= full
    return given


def test_mixing(docs, no_docs):
    weights = {"domain": {"a": 3}, "lang": {"en": 2}, "source": {"s1": 5}}
    tagged = docs.withColumn("domain", F.when(F.col("doc_id") % 4 == 0, "a").otherwise("b"))
    got = mixing.mix_sources(tagged, weights, F.col("total") * 0.6, max_epochs=2, seed=3).collect()
    supply = Counter()
    for doc_id, text, lang, source, *_ in ROWS:
        n = len(WORD.findall(text or ""))
        supply[("a" if doc_id is not None and doc_id % 4 == 0 else "b", lang, source)] += n
    supply = {k: v for k, v in supply.items() if v}
    total = sum(supply.values())
    want = {(): math.floor(total * 0.6)}
    for depth, level in enumerate(("domain", "lang", "source")):
        fresh = {}
        for node, budget in want.items():
            names = sorted({k[depth] for k in supply if k[:depth] == node}, key=str)
            children = [(weights[level].get(n, 1), 2 * sum(v for k, v in supply.items() if k[: depth + 1] == (*node, n))) for n in names]
            fresh |= {(*node, n): g for n, g in zip(names, water_fill(budget, children))}
        want = fresh
    taken = Counter()
    for r in got:
        taken[r["domain"], r["lang"], r["source"]] += r["copies"] * r["n_tokens"] + r["n_partial"]
    assert sum(taken.values()) == math.floor(total * 0.6)
    for leaf, tokens in want.items():
        assert abs(taken[leaf] - tokens) <= 4
    for leaf in taken:
        partial = [r for r in got if (r["domain"], r["lang"], r["source"]) == leaf and 0 < r["n_partial"] < r["n_tokens"]]
        assert len(partial) <= 1
    assert mixing.mix_sources(no_docs.withColumn("domain", F.lit("a")), weights, F.col("total")).count() == 0
