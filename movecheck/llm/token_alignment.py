"""Alignment of two tokenizers: cuts both share, links within them, counts over the corpus.

Both tokenizers cut the same bytes. Where a token of each ends at the same byte
there is a common cut, and the tokens between neighbouring common cuts form a
group: every token of one side is linked to every token of the other.

Cuts are found by divide and conquer. In an interval the ends of the first
tokenizer are looked up among those of the second by bisection, from the middle
outwards, until one is common; it splits the interval, and both halves go on. An
interval without a common end is a leaf: one group. All intervals of a slice of
documents that are equally deep are handled at once, so a level costs a few
array operations whatever the number of its intervals.

How many documents hold a link is a count over the whole corpus. Documents stay
in blocks of about ``BLOCK`` bytes of text, which also say how often each pair
occurs in them. Only the distinct pairs of a block are shuffled, once to be
summed and once to bring the sums back to their block. A block is cut in slices
of ``SLICE`` bytes and kept in rows of about ``CHUNK`` links' places, so neither
the arrays of a task nor the rows of Spark grow with the block.

Neither tokenizer looks across certain places: the first not across the ends of
its pre-tokens, the second not between two bytes that no piece of its vocabulary
holds side by side, as nothing can be merged there. So the distinct runs of a
slice are encoded once, and short ones are remembered, by each tokenizer in so
many bytes as ``REMEMBERED`` says.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.llm.byte_bpe import Merger, encode
from movecheck.llm.text import distinct, slices, spread
from movecheck.sources.sinks import saved

BLOCK = 4 << 20
# Bytes of text that are cut at once, and places of pairs in a row of a block.
SLICE = 1 << 20
CHUNK = 1 << 15
# Rows of blocks are wide: readers hold a row group's rows at once.
ROW_GROUPS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 8}
# Ids take so many bits in the number of a pair.
ID_BITS = 20
# Runs longer than this are not remembered; so many bytes of runs and ids are, about 150 of overhead each.
LONG_RUN = 200
REMEMBERED = 48 << 20
OVERHEAD = 150
# Groups of more links are counted by distinct ids before they are paired.
LARGE_GROUP = 4096
# Fixed value: how pieces write a space.
SPACE_MARK = "▁"
BREAK = 10
BAD = np.array([-1], np.int32).tobytes()


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes are themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Remembered:
    """Ids of distinct runs, by way of a cache bounded in bytes; ``encode`` gives those it lacks."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self.encode = encode
        self.cache: dict[bytes, bytes] = {}
        self.held = 0

    def known(self, runs: Sequence[bytes]) -> list[bytes]:
        found = list(map(self.cache.get, runs))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            asked = [runs[i] for i in missing]
            new = self.encode(asked)
            for i, ids in zip(missing, new):
                found[i] = ids
            short = [(run, ids) for run, ids in zip(asked, new) if len(run) <= LONG_RUN]
            size = sum(len(run) + len(ids) + OVERHEAD for run, ids in short)
            if self.held + size > REMEMBERED:
                self.cache, self.held = {}, 0
            if size <= REMEMBERED:
                self.cache.update(short)
                self.held += size
        return found


class BoundedMerger(Merger):
    """Merges whose slices are remembered by their bytes, not by their number."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks, 0)
        self.remembered = Remembered(self._merged)

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        made = super().known(pieces)
        self.cache = {}
        return [made[piece] for piece in pieces]

    def known(self, pieces: Sequence[bytes]) -> dict[bytes, bytes]:
        return dict(zip(pieces, self.remembered.known(pieces)))


@dataclass(frozen=True)
class ByteLevel:
    """The first tokenizer: byte-level merges of a tokenizers file."""

    merger: Merger
    lengths: np.ndarray

    @classmethod
    @lru_cache(2)
    def load(cls, path: str) -> ByteLevel:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        vocabulary = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError("ids must grow with the merges' order")
        # Whole entries, like those of special tokens, are never made by merges.
        made = {i: token for token, i in vocabulary.items()}
        ranks = {made[i]: i for i in order} | {token: i for token, i in vocabulary.items() if len(token) == 1}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        lengths[list(ranks.values())] = [len(token) for token in ranks]
        return cls(BoundedMerger(ranks), lengths)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of the texts in them)."""
        ids, ends, _, _ = encode(texts, self.merger)
        return ids, ends


class Pieces:
    """The second tokenizer: a sentencepiece model, which puts a space before a text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.octets = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE_MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.lengths = np.array([len(b) for b in self.octets], np.int64)
        self.space = np.array([self.model.piece_to_id(SPACE_MARK)], np.int32).tobytes()
        # Which bytes stand side by side in a piece; all that are not ASCII may.
        self.joined = np.zeros((256, 256), bool)
        self.joined[128:] = self.joined[:, 128:] = True
        for i, octets in enumerate(self.octets):
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)):
                self.joined[list(octets[:-1]), list(octets[1:])] = True
        if self.joined[BREAK, :128].any() or self.joined[:128, BREAK].any():
            raise ValueError("a piece reaches across a line break")
        self.remembered = Remembered(self._encode)

    @classmethod
    @lru_cache(2)
    def load(cls, path: str) -> Pieces:
        return cls(path)

    def _asked(self, run: bytes) -> str:
        """The text whose ids end with those of the run; the model adds a space to it."""
        return (run[1:] if run[:1] == b" " else b"\n" + run).decode("utf-8", "surrogatepass")

    def _encode(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each run as bytes; ``BAD`` if its pieces are not its bytes."""
        lists = self.model.encode([self._asked(run) for run in runs], num_threads=1)
        # Behind an added line break, its byte and the model's space are dropped.
        lists = [ids if run[:1] == b" " else ids[2:] for run, ids in zip(runs, lists)]
        flat = np.array(list(chain.from_iterable(lists)), np.int32)
        ends = np.cumsum([len(ids) for ids in lists])
        numbers, raw = flat.tolist(), flat.tobytes()
        out = [raw[4 * i : 4 * j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]
        sizes = np.diff(np.concatenate([[0], np.cumsum(self.lengths[flat])])[np.concatenate([[0], ends])])
        same = b"".join([self.octets[i] for i in numbers]) == b"".join(runs)
        if not same or (sizes != [len(run) for run in runs]).any():
            for i, (run, ids) in enumerate(zip(runs, lists)):
                if run == b" ":
                    out[i] = self.space
                elif b"".join([self.octets[k] for k in ids]) != run:
                    out[i] = BAD
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets); the texts begin with a space. -1 stands in texts that pieces do not give back."""
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        begins = np.ones(len(data), bool)
        begins[1:] = ~self.joined[data[:-1], data[1:]]
        begins[ends[:-1]] = True
        starts = np.append(np.flatnonzero(begins), len(data))
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)])
        index, uniques = distinct(runs)
        ids, stops = spread(self.remembered.known(uniques), index)
        return ids, np.concatenate([[0], stops])[np.searchsorted(starts, np.concatenate([[0], ends]))]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for sizes[i] numbers, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def middle_cuts(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each range of places in ``ends_a``, the one nearest its middle whose end ``ends_b`` has too, or -1.

    Ever wider rings around the middle are looked up by bisection. Ranges that
    ascend keep the look-ups close to each other.
    """
    found = np.full(len(low), -1, np.int64)
    todo = np.flatnonzero(high > low)
    inner, outer = 0, 1
    while len(todo):
        begin, stop = low[todo], high[todo]
        mid = (begin + stop) // 2
        left = np.maximum(begin, mid - outer + 1)
        right = mid + max(inner, 1)
        n_left = np.maximum(mid - inner + 1 - left, 0)
        n_right = np.maximum(np.minimum(stop, mid + outer) - right, 0)
        owner = np.arange(len(todo))
        owner = np.concatenate([np.repeat(owner, n_left), np.repeat(owner, n_right)])
        place = np.concatenate([ragged(left, n_left), ragged(right, n_right)])
        wanted = ends_a[place]
        hit = ends_b[np.searchsorted(ends_b, wanted)] == wanted
        owner, place = owner[hit], place[hit]
        nearest = np.full(len(todo), np.iinfo(np.int64).max)
        np.minimum.at(nearest, owner, 2 * np.abs(place - mid[owner]) + (place > mid[owner]))
        got = nearest < np.iinfo(np.int64).max
        away = np.where(nearest & 1, nearest >> 1, -(nearest >> 1))
        found[todo[got]] = (mid + away)[got]
        todo = todo[~got & ((mid - outer >= begin) | (mid + outer < stop))]
        inner, outer = outer, 2 * outer
    return found


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray) -> np.ndarray:
    """Rows (first token, end) of A, (first token, end) of B for every group, in order.

    ``ends_*`` are the byte offsets at which tokens end, ``docs_*`` the offsets of
    documents among the tokens; the two must agree at the end of each document.
    """
    open_ = np.stack([docs_a[:-1], docs_a[1:], docs_b[:-1], docs_b[1:]], 1)
    open_ = open_[open_[:, 1] > open_[:, 0]]
    leaves = []
    while len(open_):
        a, a_end, b, b_end = open_.T
        single = (a_end - a == 1) | (b_end - b == 1)
        if single.any():
            leaves.append(open_[single])
            open_ = open_[~single]
            a, a_end, b, b_end = open_.T
        # The last end of an interval is common already.
        cut = middle_cuts(ends_a, ends_b, a, a_end - 1)
        whole = cut < 0
        leaves.append(open_[whole])
        a, a_end, b, b_end = open_[~whole].T
        cut_a = cut[~whole] + 1
        cut_b = np.searchsorted(ends_b, ends_a[cut_a - 1]) + 1
        open_ = np.stack([a, cut_a, b, cut_b, cut_a, a_end, cut_b, b_end], 1).reshape(-1, 4)
    found = np.concatenate(leaves) if leaves else np.zeros((0, 4), np.int64)
    return found[np.argsort(found[:, 0])]


@dataclass
class Aligned:
    """A slice of texts: their tokens, and the groups of all texts in order."""

    ids_a: np.ndarray
    docs_a: np.ndarray
    ids_b: np.ndarray
    docs_b: np.ndarray
    groups: np.ndarray
    ends_a: np.ndarray

    @property
    def owners(self) -> np.ndarray:
        """The document of each group."""
        return np.searchsorted(self.docs_a, self.groups[:, 0], side="right") - 1


def align(texts: list[str | None], path_a: str, path_b: str) -> Aligned:
    """The texts with a space before each, cut by both tokenizers and grouped.

    Null and empty texts, and those that a tokenizer does not give back byte by
    byte, have no tokens.
    """
    first, second = ByteLevel.load(path_a), Pieces.load(path_b)
    filled = np.array([bool(t) for t in texts], bool)
    spaced = [" " + t for t in texts if t]
    none = np.zeros(0, np.int64), np.zeros(1, np.int64)
    ids_b, docs_b = second.encode(spaced) if spaced else none
    wrong = np.unique(np.searchsorted(docs_b, np.flatnonzero(ids_b < 0), side="right") - 1)
    if len(wrong):
        keep = np.ones(len(spaced), bool)
        keep[wrong] = False
        ids_b = ids_b[np.repeat(keep, np.diff(docs_b))]
        docs_b = np.concatenate([[0], np.cumsum(np.diff(docs_b)[keep])])
        filled[np.flatnonzero(filled)[wrong]] = False
        spaced = [t for t, k in zip(spaced, keep) if k]
    ids_a, docs_a = first.encode(spaced) if spaced else none
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in spaced], np.int64)
    ends_a, ends_b = np.cumsum(first.lengths[ids_a]), np.cumsum(second.lengths[ids_b])
    if not (np.array_equal(ends_a[docs_a[1:] - 1], np.cumsum(sizes)) and np.array_equal(ends_b[docs_b[1:] - 1], np.cumsum(sizes))):
        raise ValueError("tokens do not add up to their texts")
    groups = groups_of(ends_a, ends_b, docs_a, docs_b)

    def all_docs(offsets: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        counts[filled] = np.diff(offsets)
        return np.concatenate([[0], np.cumsum(counts)])

    return Aligned(ids_a, all_docs(docs_a), ids_b, all_docs(docs_b), groups, ends_a)


def pairs_of(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """(document and pair of ids in one number, links) for every pair that a document links."""
    a, a_end, b, b_end = found.groups.T
    n_b, n_links = b_end - b, (a_end - a) * (b_end - b)
    owner = found.owners
    few = n_links <= LARGE_GROUP
    group = np.repeat(np.flatnonzero(few), n_links[few])
    within = ragged(np.zeros(int(few.sum()), np.int64), n_links[few])
    left = found.ids_a[a[group] + within // n_b[group]].astype(np.int64)
    right = found.ids_b[b[group] + within % n_b[group]].astype(np.int64)
    keys, times = np.unique(owner[group] << 2 * ID_BITS | left << ID_BITS | right, return_counts=True)
    if few.all():
        return keys, times
    keys, times = [keys], [times]
    for g in np.flatnonzero(~few).tolist():
        left, n_left = np.unique(found.ids_a[a[g] : a_end[g]].astype(np.int64), return_counts=True)
        right, n_right = np.unique(found.ids_b[b[g] : b_end[g]].astype(np.int64), return_counts=True)
        keys.append((int(owner[g]) << 2 * ID_BITS | left[:, None] << ID_BITS | right).ravel())
        times.append((n_left[:, None] * n_right).ravel())
    once, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(once), np.int64)
    np.add.at(total, at, np.concatenate(times))
    return once, total


@lru_cache(2)
def _spelt(size: int) -> pa.Array:
    """Every number below size with a comma, then with a bar, then with a semicolon behind it."""
    return pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(size)], pa.large_binary())


def group_digests(found: Aligned) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2`` for each text; the empty text without tokens."""
    a, a_end, b, b_end = found.groups.T
    size = int(max(found.ids_a.max(initial=0), found.ids_b.max(initial=0))) + 1
    size = 1 << size.bit_length()
    codes = np.empty(len(found.ids_a) + len(found.ids_b), np.int64)
    in_a, in_b = found.ids_a.astype(np.int64), found.ids_b.astype(np.int64)
    in_a[a_end - 1] += size
    in_b[b_end - 1] += 2 * size
    codes[np.arange(len(in_a)) + np.repeat(b, a_end - a)] = in_a
    codes[np.arange(len(in_b)) + np.repeat(a_end, b_end - b)] = in_b
    spelt = _spelt(size).take(pa.array(codes))
    offsets = np.frombuffer(spelt.buffers()[1], np.int64)
    data = memoryview(spelt.buffers()[2] or b"")
    at = offsets[found.docs_a + found.docs_b].tolist()
    return [hashlib.sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:])]


GROUPS = "doc_id long, groups array<struct<a: array<int>, b: array<int>, end: long>>"


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, groups: the token ids of both sides and the byte at which each group ends.

    Offsets count the space before the text. See :func:`align` for texts without
    tokens; they have no groups. Every row of docs gives one; only doc_id and
    text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = align(part.column("text").to_pylist(), path_a, path_b)
                starts = np.concatenate([[0], found.ends_a[found.docs_a[1:] - 1]]) if len(found.ends_a) else np.zeros(part.num_rows + 1, np.int64)
                starts[1:][found.docs_a[1:] == 0] = 0
                a, a_end, b, b_end = found.groups.T
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.append(low, len(ids)), pa.int32()), pa.array(ids, pa.int32()))
                    for low, ids in ((a, found.ids_a), (b, found.ids_b))
                ]
                ends = pa.array(found.ends_a[a_end - 1] - starts[found.owners], pa.int64())
                firsts = np.searchsorted(a, found.docs_a)
                groups = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.StructArray.from_arrays([*lists, ends], ["a", "b", "end"]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), groups], ["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, GROUPS)


DOCUMENT = {"doc_ids": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "digests": "string"}
LINKS = {"pairs": "long", "held": "long", "stops": "long", "at": "int", "times": "long"}
BLOCKS = ", ".join(["block long", "first long", *[f"{name} array<{kind}>" for name, kind in (DOCUMENT | LINKS).items()]])
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def block_links(part: pa.RecordBatch, path_a: str, path_b: str, size: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(counts and digests of its documents, keys and links as :func:`pairs_of` gives them) for one block.

    The block is cut in slices of ``size`` bytes of text, one after the other.
    """
    columns: dict[str, list] = {name: [] for name in DOCUMENT if name != "doc_ids"}
    keys, times, first = [], [], 0
    for piece in slices(part, "text", size):
        n = piece.num_rows
        found = align(piece.column("text").to_pylist(), path_a, path_b)
        a, a_end, b, b_end = found.groups.T
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, found.owners, (a_end - a) * (b_end - b))
        own = np.diff(found.docs_a), np.diff(found.docs_b), np.bincount(found.owners, minlength=n), n_links, group_digests(found)
        for name, values in zip(columns, own):
            columns[name].append(values)
        own_keys, own_times = pairs_of(found)
        keys.append(own_keys + (first << 2 * ID_BITS))
        times.append(own_times)
        first += n
    return {name: np.concatenate(values) for name, values in columns.items()}, np.concatenate(keys), np.concatenate(times)


def runs_of(ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs of items that end at most ``size`` behind the run's start, one item at least; ``ends`` ascend."""
    found, start = [], 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
        found.append((start, stop))
        start = stop
    return found


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A few rows per block of documents, each with a run of these.

    For its documents: ids, counts and digests; and document after document (up to
    ``stops``) the places of its pairs among the block's distinct pairs with the
    number of its links. Of these pairs each row has a share, from place ``first``
    on, and how many of the block's documents hold each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK):
                columns, keys, times = block_links(part, path_a, path_b, SLICE)
                pairs, at = np.unique(keys & ((1 << 2 * ID_BITS) - 1), return_inverse=True)
                held = np.bincount(at, minlength=len(pairs))
                stops = np.searchsorted(keys, np.arange(1, part.num_rows + 1) << 2 * ID_BITS)
                rows = runs_of(stops, CHUNK)
                for i, (start, stop) in enumerate(rows):
                    low, high = len(pairs) * i // len(rows), len(pairs) * (i + 1) // len(rows)
                    begin, end = int(stops[start - 1]) if start else 0, int(stops[stop - 1])
                    row = {
                        "doc_ids": part.column("doc_id").slice(start, stop - start), **{name: values[start:stop] for name, values in columns.items()},
                        "pairs": pairs[low:high], "held": held[low:high],
                        "stops": stops[start:stop] - begin, "at": at[begin:end], "times": times[begin:end],
                    }
                    lists = [
                        pa.ListArray.from_arrays(pa.array([0, len(row[name])], pa.int32()), row[name] if name == "doc_ids" else pa.array(row[name], KINDS[kind]))
                        for name, kind in (DOCUMENT | LINKS).items()
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([low], pa.int64()), *lists], ["block", "first", *row])
                block += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, mark: twice the documents that hold the pair, plus one if no pair of its first id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.pairs", "p.held")
    counts = saved(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")), "pairs")
    first = F.shiftright("pair", ID_BITS).alias("first")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", first).join(most, "first").select(
        "pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("mark")
    )


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _resolved(blocks: pa.Table, marks: pa.Table) -> pa.Table:
    """The documents of one block, with the sums over their links."""
    # No text is cut here: what the tokenizers hold would only stand beside the JVM's sorts.
    ByteLevel.load.cache_clear()
    Pieces.load.cache_clear()
    mark = np.zeros(marks.num_rows, np.int64)
    mark[marks.column("place").to_numpy()] = marks.column("mark").to_numpy()
    out = []
    for i in range(blocks.num_rows):
        row = {name: blocks.column(name)[i].values for name in (*DOCUMENT, "stops", "at", "times")}
        own, times = mark[row["at"].to_numpy()], row["times"].to_numpy()
        stops = np.concatenate([[0], row["stops"].to_numpy()])
        total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[stops])
        sums = {"n_best": total(times * (own & 1)), "count_sum": total(times * (own >> 1))}
        names = {"doc_id": row["doc_ids"], **{c: row[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                 **{c: pa.array(v, pa.int64()) for c, v in sums.items()}, "groups_sha256": row["digests"]}
        out.append(pa.table(names))
    return pa.concat_tables(out)


def aligned_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, for every row of docs.

    ``n_best`` counts the links whose pair of ids no other pair of that first id
    beats in documents that hold it, ``count_sum`` adds these documents up over
    the links. Null and empty texts, and those that the tokenizers do not give
    back, have no tokens: zeros and an empty digest. Rows with equal or null
    doc_id are documents like any other. An empty table gives no rows. Only
    doc_id and text are read. One text is one task's work.
    """
    blocks = saved(aligned_blocks(docs, path_a, path_b), "blocks", ROW_GROUPS)
    counts = saved(pair_counts(blocks), "counts")
    at = (F.col("first") + F.col("of_row")).alias("place")
    placed = blocks.select(F.col("block").alias("of_block"), "first", F.posexplode("pairs").alias("of_row", "pair")).select("of_block", at, "pair")
    marks = placed.join(counts, "pair").select("of_block", "place", "mark")
    sums = blocks.select("block", *DOCUMENT, "stops", "at", "times")
    return sums.groupBy("block").cogroup(marks.groupBy("of_block")).applyInArrow(_resolved, RESULT)
