"""SimHash near-duplicates, candidates filtered by the pigeonring principle.

Fingerprints are cut into ``SEGMENTS`` pieces laid out in a ring. If two differ
in at most t bits, some piece exists from which every chain of l consecutive
pieces differs in at most l * t / SEGMENTS bits. For t = 2 and five pieces that
means: from some start, one and two pieces are equal, three and four differ in
at most one bit. The two equal pieces (26 of 64 bits) are the key under which
Spark looks for candidates; the longer chains are tested next, and the full
Hamming distance last.

Equal fingerprints are one class from the start, so copies never meet. A key
that many different fingerprints share is not paired up: there each fingerprint
goes to its *midpoints*, itself and all values one bit away outside the key.
Two fingerprints differ in at most two bits exactly if they share a midpoint,
and all that share one may be linked to the smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movecheck.llm.components import components
from movecheck.llm.rows import numbered
from movecheck.llm.text import lower_ascii, words_of
from movecheck.sources.sinks import saved

MAX_BITS = 2
SHINGLE = 3
# Widths of the ring's segments, 64 bits in all.
WIDTHS = (13, 13, 13, 13, 12)
# A key shared by more fingerprints than this is resolved by midpoints.
PAIRED = 64


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """The 64-bit SimHash: a bit is 1 if set in over half the shingle hashes."""
    words = words_of(lower_ascii((text or "").encode("utf-8", "surrogatepass")))
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray, run: int = 1 << 16) -> int:
    """Bits set in over half of the hashes."""
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), run):
        octets = hashes[start : start + run].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * set_bits > len(hashes)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [_signed(fingerprint(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def segment(fp: Column, i: int) -> Column:
    i %= len(WIDTHS)
    shift = sum(WIDTHS[:i])
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1))


def ring_keys(fp: Column) -> Column:
    """The key of every start: its number and two pieces."""
    n = len(WIDTHS)
    return F.array(
        *[
            F.lit(i << 32)
            .bitwiseOR(F.shiftleft(segment(fp, i), WIDTHS[(i + 1) % n]))
            .bitwiseOR(segment(fp, i + 1))
            for i in range(n)
        ]
    )


def _masks(length: int) -> list[int]:
    """For each start, the bits of a chain of so many pieces."""
    n = len(WIDTHS)
    out = []
    for start in range(n):
        bits = 0
        for j in range(start, start + length):
            i = j % n
            bits |= ((1 << WIDTHS[i]) - 1) << sum(WIDTHS[:i])
        out.append(_signed(bits))
    return out


def chain_within(start: Column, differing: Column, length: int, max_bits: int) -> Column:
    """True if the chain from the start differs within its share of the budget."""
    masks = F.array(*[F.lit(m) for m in _masks(length)])
    budget = length * max_bits // len(WIDTHS)
    return F.bit_count(differing.bitwiseAND(masks[start])) <= budget


def _paired(rows: DataFrame, max_bits: int) -> DataFrame:
    left = rows.select("key", F.col("fp").alias("a"))
    right = rows.select("key", F.col("fp").alias("b"))
    start = F.shiftright("key", 32).cast("int")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    met = left.join(right, "key").filter(F.col("a") < F.col("b"))
    for length in range(len(WIDTHS) // 2 + 1, len(WIDTHS)):
        met = met.filter(chain_within(start, differing, length, max_bits))
    return met.filter(F.bit_count(differing) <= max_bits).select("a", "b")


def _by_midpoints(rows: DataFrame) -> DataFrame:
    """Links of keys with many fingerprints, without pairing them."""
    key_bits = F.array(*[F.lit(m) for m in _masks(2)])[F.shiftright("key", 32).cast("int")]
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    free = F.filter(flips, lambda bit: bit.bitwiseAND(key_bits) == 0)
    at = rows.select("key", "fp", F.explode(F.transform(free, lambda x: x.bitwiseXOR(F.col("fp")))).alias("mid"))
    smallest = at.groupBy("key", "mid").agg(F.min("fp").alias("a"), F.count("*").alias("c"))
    shared = saved(smallest.filter("c > 1").drop("c"), "midpoints")
    return at.join(shared, ["key", "mid"]).filter("fp > a").select("a", F.col("fp").alias("b"))


def links(prints: DataFrame, max_bits: int = MAX_BITS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints within ``max_bits``.

    ``prints`` holds distinct values in fp. Not every close pair is a row, but
    every close pair is connected.
    """
    if max_bits != 2:
        raise ValueError("keys of two pieces and midpoints are made for two bits")
    keyed = prints.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key"))
    sizes = saved(keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "ring")
    met = saved(keyed.join(sizes, "key"), "ring")
    few = _paired(met.filter(F.col("c") <= paired), max_bits)
    return few.unionByName(_by_midpoints(met.filter(F.col("c") > paired))).distinct()


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null and empty texts have fingerprint 0 and link like any other. Rows with
    equal doc_id each get a result; a null doc_id never names a component,
    unless all its rows have none. Only doc_id and text are read.
    """
    own = saved(fingerprints(docs), "fingerprints")
    classes = saved(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, max_bits))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = saved(named.join(smallest, "root").select("fp", "component_id"), "classes")
    return own.join(labelled, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of docs that stay when one row of each component does.

    That is the row with the smallest doc_id, and one row if several carry it;
    rows without a doc_id come last. Rows that share a doc_id but no component
    are told apart. The columns are those of docs.
    """
    rows, row = numbered(docs)
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), max_bits)
    named = found.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, "doc_id"), row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row)).alias("first")
    stay = named.groupBy("component_id").agg(first).select(F.col("first")[row].alias(row))
    return rows.join(saved(stay, "kept").hint("merge"), row, "left_semi").select(*docs.columns)
