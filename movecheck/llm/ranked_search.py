"""Ranked lexical search: best-first intervals over range-maximum tables.

The index has a row per shard of ``SHARD`` documents, ordered by id, with the
posting list of every term that some item asks for: document places and counts.
To search a shard for an item, the impacts of the lists (a term's weight times
its saturated count) are laid end to end and get a sparse table: for every start
and power of two the place of the largest impact of that run. Any part of a list
then tells its largest impact from two look-ups, and the sum of these over the
item's terms bounds the score of every document of an interval.

Intervals wait in a heap, highest bound first. The document with the largest
single impact of the best interval is scored, and splits the interval in two,
whose bounds are taken anew; an interval with few postings left is scored as a
whole. The search of a shard ends when no interval can still hold a document of
the top. Ids ascend within a shard, so of equally good
intervals the one with the smaller ids comes first, and equal scores beyond the
top are never visited.

What the top must beat is first learnt from all shards: each scores its first
few documents per item, and the worst of the best of these, over the whole
table, is a score that every shard can demand from the start. It only cuts what
cannot be in the result.

Items are searched in blocks of about ``BLOCK_TERMS`` terms, which is all that
the driver and the closures of tasks ever hold of them.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movecheck.llm.text import slices
from movecheck.sources.sinks import saved

SHARD = 4096
BLOCK_TERMS = 100_000
# Postings from which on an interval is split rather than scored as a whole.
LEAF = 1024
TOP = 20
# Letters and digits of ASCII and everything beyond it make words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
# Not a word: the posting that every document with a word has.
ANY = ""


def terms_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def counted(texts: DataFrame) -> DataFrame:
    """row, id, n, term, tf: the terms of every text with its length in words.

    ``texts`` holds row, id and text. A text without words gives nothing, any
    other also the term ``ANY``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, counts, lengths, sizes = [], [], [], []
                for text in part.column("text"):
                    words = terms_of(text.as_py())
                    found = Counter(words)
                    lengths.append(len(words))
                    if words:
                        terms.append(b"")
                        counts.append(1)
                        terms.extend(found.keys())
                        counts.extend(found.values())
                    sizes.append(len(found) + bool(words))
                index = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(index), part.column("id").take(index),
                        pa.array(lengths, pa.int64()).take(index), pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(counts, pa.int64()),
                    ],
                    ["row", "id", "n", "term", "tf"],
                )

    return texts.select("row", "id", "text").mapInArrow(run, "row long, id long, n long, term string, tf long")


INDEX = (
    "shard long, n_docs long, n_terms long, ids array<long>, lengths array<long>, "
    "terms array<string>, sizes array<long>, places array<int>, counts array<long>"
)


def _shard_row(postings: pa.Table) -> pa.Table:
    """One row of the index from the postings of a shard."""
    table = postings.combine_chunks()
    numbers = {c: table.column(c).combine_chunks().to_numpy() for c in ("row", "n", "tf")}
    coded = table.column("term").combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    term = coded.indices.to_numpy().astype(np.int64)
    # ANY gives each document once; ids ascend, rows without an id come last.
    docs = np.flatnonzero(term == names.index(ANY))
    ids = table.column("id").combine_chunks()
    blank = ids.is_null().to_numpy(zero_copy_only=False)
    plain = ids.fill_null(0).to_numpy()
    docs = docs[np.lexsort((numbers["row"][docs], plain[docs], blank[docs]))]
    rows = numbers["row"][docs]
    by_row = np.argsort(rows)
    place = by_row[np.searchsorted(rows[by_row], numbers["row"])]
    order = np.lexsort((place, term))
    sizes = np.bincount(term, minlength=len(names))
    row = {
        "shard": [table.column("shard")[0].as_py()], "n_docs": [len(docs)], "n_terms": [int(numbers["n"][docs].sum())],
        "ids": [ids.take(pa.array(docs)).to_pylist()], "lengths": [numbers["n"][docs]], "terms": [names], "sizes": [sizes],
        "places": [place[order].astype(np.int32)], "counts": [numbers["tf"][order]],
    }
    kinds = {"ids": pa.int64(), "lengths": pa.int64(), "terms": pa.string(), "sizes": pa.int64(), "places": pa.int32(), "counts": pa.int64()}
    return pa.table({k: pa.array(v, pa.list_(kinds[k]) if k in kinds else pa.int64()) for k, v in row.items()})


def build_index(docs: DataFrame, wanted: DataFrame, n_rows: int, shard: int = SHARD) -> DataFrame:
    """A row per shard of the texts (row, id, text), for the terms of ``wanted``.

    Whether the wanted terms are broadcast or shuffled is left to Spark's check
    of their size.
    """
    known = wanted.select("term").distinct().unionByName(docs.sparkSession.createDataFrame([(ANY,)], "term string"))
    n_shards = max(1, math.ceil(n_rows / shard))
    met = counted(docs).join(saved(known, "terms"), "term", "left_semi")
    return met.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards))).groupBy("shard").applyInArrow(_shard_row, INDEX)


@dataclass
class Item:
    """What an item asks of a shard, and the (score, id) that the result must reach."""

    number: int
    times: dict[str, int] = field(default_factory=dict)
    floor: tuple[int, float] = (1, math.inf)


class Shard:
    """Posting lists of one shard with impacts and their range maxima."""

    def __init__(self, row: dict, weights: dict[str, int], n_docs: int, n_terms: int):
        self.ids = row["ids"]
        self.order = [math.inf if i is None else i for i in self.ids]
        sizes = np.asarray(row["sizes"])
        stops = np.cumsum(sizes)
        used = [i for i, term in enumerate(row["terms"]) if term in weights]
        self.terms = {row["terms"][i]: k for k, i in enumerate(used)}
        runs = [np.arange(stops[i] - sizes[i], stops[i]) for i in used]
        picked = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(run) for run in runs], dtype=np.int64)]).astype(np.int64)
        self.places = np.asarray(row["places"])[picked].astype(np.int64)
        self.keys = np.repeat(np.arange(len(used)), np.diff(self.starts)) * len(self.ids) + self.places
        marks = np.array([75 + 25 * int(n) * n_docs // n_terms for n in row["lengths"]], np.int64)[self.places]
        counts = np.asarray(row["counts"])[picked].astype(np.int64)
        weight = np.repeat(np.array([weights[row["terms"][i]] for i in used], np.int64), np.diff(self.starts))
        self.impacts = weight * (1_000_000_000 * counts // (1000 * counts + 12 * marks))
        longest = int(np.diff(self.starts).max(initial=1))
        self.maxima = range_maxima(self.impacts, longest)
        self.levels = np.frexp(np.arange(longest + 1))[1] - 1

    def bound(self, times: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
        """(bound of every document's score, place of the largest single impact)."""
        level = self.levels[high - low]
        a, b = self.maxima[level, low], self.maxima[level, high - (1 << level)]
        left, right = self.impacts[a], self.impacts[b]
        best = times * np.maximum(left, right)
        i = int(best.argmax())
        return int(best.sum()), int(self.places[a[i] if left[i] >= right[i] else b[i]])

    def search(self, item: Item, top: int, scored: int | None = None) -> list[tuple[int, int]]:
        """(score, place) of the shard's best documents, of the first few only if asked."""
        asked = [(self.terms[t], n) for t, n in item.times.items() if t in self.terms]
        if not asked:
            return []
        term, times = (np.array(x, np.int64) for x in zip(*asked))
        width, heap, best, n_scored = len(self.ids), [], [], 0

        def offer(begin: int, term: np.ndarray, times: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            some = high > low
            if not some.all():
                term, times, low, high = term[some], times[some], low[some], high[some]
            if len(term):
                bound, place = self.bound(times, low, high)
                if bound > 0 and self._can_win(bound, begin, item.floor, best, top):
                    heapq.heappush(heap, (-bound, begin, place, term, times, low, high))

        def take(score: int, place: int) -> None:
            if len(best) < top:
                heapq.heappush(best, (score, -place))
            else:
                heapq.heappushpop(best, (score, -place))

        offer(0, term, times, self.starts[term], self.starts[term + 1])
        while heap:
            bound, begin, place, term, times, low, high = heapq.heappop(heap)
            if not self._can_win(-bound, begin, item.floor, best, top):
                continue
            sizes = high - low
            ends = np.cumsum(sizes)
            if ends[-1] <= LEAF:
                at = np.repeat(low - ends + sizes, sizes) + np.arange(ends[-1])
                scores = np.zeros(width - begin, np.int64)
                np.add.at(scores, self.places[at] - begin, np.repeat(times, sizes) * self.impacts[at])
                least = max(item.floor[0], best[0][0] if len(best) == top else 1)
                found = np.flatnonzero(scores >= least)
                for i in found.tolist():
                    take(int(scores[i]), begin + i)
                n_scored += max(len(found), 1)
            else:
                wanted = term * width + place
                at = np.searchsorted(self.keys, wanted)
                there = at < high
                there[there] = self.keys[at[there]] == wanted[there]
                take(int((times[there] * self.impacts[at[there]]).sum()), place)
                n_scored += 1
                offer(begin, term, times, low, at)
                offer(place + 1, term, times, at + there, high)
            if scored is not None and n_scored >= scored:
                break
        return [(score, -place) for score, place in best if score > 0]

    def _can_win(self, bound: int, begin: int, floor: tuple[int, float], best: list, top: int) -> bool:
        """Whether a document at ``begin`` or later could still be in the result."""
        if bound < floor[0] or (bound == floor[0] and self.order[begin] > floor[1]):
            return False
        return len(best) < top or (bound, -begin) > best[0]


def range_maxima(values: np.ndarray, longest: int) -> np.ndarray:
    """Row j, column i: where the first largest of values[i : i + 2**j] is."""
    rows = [np.arange(len(values), dtype=np.int32)]
    width = 1
    while 2 * width <= longest:
        last = rows[-1]
        row = last.copy()
        a, b = last[: len(values) - width], last[width:]
        row[: len(a)] = np.where(values[a] >= values[b], a, b)
        rows.append(row)
        width *= 2
    return np.array(rows)


HITS = "item long, id long, score long"


def _searched(index: DataFrame, items: list[Item], weights: dict[str, int], n_docs: int, n_terms: int, top: int, scored: int | None) -> DataFrame:
    """item, id, score: the best documents of every shard."""

    def run(rows: pa.Table) -> pa.Table:
        row = {c: rows.column(c)[0].values for c in ("ids", "lengths", "terms", "sizes", "places", "counts")}
        shard = Shard(
            {c: v.to_pylist() if c in ("ids", "terms") else v.to_numpy() for c, v in row.items()}, weights, n_docs, n_terms
        )
        hits = [(item.number, shard.ids[place], score) for item in items for score, place in shard.search(item, top, scored)]
        columns = list(zip(*hits)) or [(), (), ()]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("item", "id", "score"), columns)})

    # One shard at a time, whatever a file holds of them.
    return index.groupBy("shard").applyInArrow(run, HITS)


def _ranked(hits: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return hits.withColumn("rank", F.row_number().over(order))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, shard: int = SHARD, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents for the text of every item.

    ``docs`` holds doc_id and text, ``items`` item_id and text; other columns are
    not read. A term's weight falls with the documents that hold it, a document's
    score adds weight times saturated count over the item's terms, repeats
    included. Every row of docs is a document and every row of items an item,
    whatever ids they share or lack; among equal scores a null doc_id comes last.
    Null texts have no terms, and documents without a term do not count. Items
    without a term that some document holds have no rows. One item's terms are
    held by the driver and by tasks, a document's by one task.
    """
    spark = docs.sparkSession
    number = F.monotonically_increasing_id()
    asked = saved(
        counted(items.select(number.alias("row"), F.col("item_id").cast("long").alias("id"), "text"))
        .filter(F.col("term") != ANY).select(F.col("row").alias("item"), F.col("id").alias("item_id"), "term", F.col("tf").alias("times")),
        "asked",
    )
    rows = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    index = saved(build_index(rows, asked, docs.count(), shard), "postings")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    listed = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy(F.col("t.terms").alias("term"))
    met = saved(asked.join(listed.agg(F.sum("t.sizes").alias("df")), "term"), "asked")
    n_blocks = max(1, math.ceil(met.count() / block_terms))
    found = []
    for block in range(n_blocks):
        # About ``block_terms`` rows.
        mine = met.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()
        wanted: dict[int, Item] = {}
        weights = {}
        for r in mine:
            wanted.setdefault(r["item"], Item(r["item"])).times[r["term"]] = r["times"]
            weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        first = _searched(index, list(wanted.values()), weights, n_docs, n_terms, top, top)
        # One row per item of the block.
        for r in _ranked(first).filter(F.col("rank") == top).collect():
            wanted[r["item"]].floor = (r["score"], math.inf if r["id"] is None else r["id"])
        found.append(_searched(index, list(wanted.values()), weights, n_docs, n_terms, top, None))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    names = asked.select("item", "item_id").distinct()
    best = saved(_ranked(hits).filter(F.col("rank") <= top), "ranked")
    return best.join(names, "item").select("item_id", F.col("rank").cast("int"), F.col("id").alias("doc_id"), "score")
