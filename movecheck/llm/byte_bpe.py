"""Byte-level BPE: vectorised pre-tokenisation, cached merges, exact decoding.

The texts of a batch are laid end to end as code points, and each code point is
replaced by a symbol: its class (letter, number, space, other white space, mark)
together with what the splitting rule must know of the next one. The rule is
then a small automaton. Every symbol is a function from state to state; such
functions compose associatively, and their closure has few members, so a member
is one number and composition one table look-up. Rows of a matrix of symbols are
composed column by column for all rows at once, the row totals are scanned, and
a second sweep yields every state and with it every token boundary. No regular
expression runs over the texts.

The slices between boundaries are looked up in a bounded cache; what is missing
is merged pair by pair, lowest rank first: slices of one length side by side in
matrices, long ones with a heap. Slice
offsets are kept, so every id can be traced to its bytes.

Classes of code points are not taken from Python's tables, whose Unicode version
differs from that of the tokenizer library: the library itself is asked once
per worker which code points are letters, numbers and white space.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from movecheck.llm.text import distinct, ends_of, slices, spread

CACHE = 400_000
HEAP_FROM = 40
COLUMNS = 512
NEVER = np.int64(1 << 40)
# The contractions of the public splitting pattern.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Classes of code points.
MARK, LETTER, NUMBER, SPACE, BLANK, QUOTE, BREAK = range(7)
# Symbols: a class and, where it matters, what follows.
(
    S_MARK, S_LETTER, S_NUMBER, S_QUOTE, S_SHORT, S_LONG, S_SECOND, S_SPACE_LAST,
    S_BLANK_LAST, S_BLANK_MORE, S_BREAK,
) = range(11)
# States: what the last code point belongs to.
(T_START, T_BLANK, T_PREFIX, T_LETTER, T_NUMBER, T_MARK, T_QUOTE, T_ENDING, T_DONE) = range(9)


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a token start here)."""
    if symbol == S_BREAK:
        return T_START, False
    if symbol == S_SPACE_LAST:
        return T_PREFIX, True
    if symbol == S_BLANK_LAST:
        return T_BLANK, True
    if symbol == S_BLANK_MORE:
        return T_BLANK, state != T_BLANK
    if symbol == S_NUMBER:
        return T_NUMBER, state not in (T_NUMBER, T_PREFIX)
    if symbol == S_MARK:
        return T_MARK, state not in (T_MARK, T_QUOTE, T_PREFIX)
    if symbol == S_QUOTE:
        if state in (T_MARK, T_QUOTE, T_PREFIX):
            return T_MARK, False
        return T_QUOTE, True
    # Letters. After a quote that began a token they may end a contraction.
    if state == T_QUOTE and symbol == S_SHORT:
        return T_DONE, False
    if state == T_QUOTE and symbol == S_LONG:
        return T_ENDING, False
    if state == T_ENDING:
        return T_DONE, False
    return T_LETTER, state not in (T_LETTER, T_PREFIX)


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each symbol, composition, image of the start, moves, starts).

    The functions reachable by composition are numbered; ``composition[f, g]``
    is "first f, then g".
    """
    n_states, n_symbols = T_DONE + 1, S_BREAK + 1
    moves = np.array([[step(s, c)[0] for c in range(n_symbols)] for s in range(n_states)], np.uint8)
    starts = np.array([[step(s, c)[1] for c in range(n_symbols)] for s in range(n_states)], bool)
    known: dict[bytes, int] = {tuple(range(n_states)): 0}
    todo = [tuple(range(n_states))]
    symbols = [tuple(int(x) for x in moves[:, c]) for c in range(n_symbols)]
    while todo:
        f = todo.pop()
        for g in symbols:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = np.array(list(known), np.uint8)
    composition = np.array(
        [[known[tuple(int(x) for x in g[f])] for g in functions] for f in functions], np.uint16
    )
    of_symbol = np.array([known[g] for g in symbols], np.uint16)
    return of_symbol, composition, functions[:, T_START].copy(), moves, starts


@lru_cache(1)
def point_classes() -> np.ndarray:
    """The class of every code point, as the tokenizer library sees it."""
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    octets = {bytes([i]): i for i in range(256)}
    classes = np.full(0x110001, MARK, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        asked = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=octets, special_tokens={})
        found = bytes(asked.encode_ordinary(points)).decode()
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    classes[0x20], classes[0x27], classes[0x110000] = SPACE, QUOTE, BREAK
    return classes


def symbols_of(points: np.ndarray) -> np.ndarray:
    """Symbols of code points; 0x110000 stands between texts."""
    classes = point_classes()[points]
    blank = (classes == SPACE) | (classes == BLANK)
    # White space counts as "more" before white space and at the end of a text.
    last = np.zeros(len(points), bool)
    last[:-1] = ~blank[1:] & (classes[1:] != BREAK)
    out = np.array(
        [S_MARK, S_LETTER, S_NUMBER, S_BLANK_MORE, S_BLANK_MORE, S_QUOTE, S_BREAK], np.uint8
    )[classes]
    out[(classes == SPACE) & last] = S_SPACE_LAST
    out[(classes == BLANK) & last] = S_BLANK_LAST
    quoted = np.flatnonzero(classes == QUOTE) + 1
    quoted = quoted[quoted < len(points)]
    if len(quoted):
        after = points[quoted]
        out[quoted[np.isin(after, [ord(c) for c in SHORT_ENDINGS])]] = S_SHORT
        following = points[np.minimum(quoted + 1, len(points) - 1)]
        for a, b in LONG_ENDINGS:
            out[quoted[(after == ord(a)) & (following == ord(b))]] = S_LONG
    return out


def token_starts(points: np.ndarray) -> np.ndarray:
    """True at every code point that begins a token."""
    of_symbol, composition, image, moves, starts = automaton()
    n = len(points)
    symbols = symbols_of(points)
    rows = -(-n // COLUMNS)
    padded = np.full(rows * COLUMNS, S_BREAK, np.uint8)
    padded[:n] = symbols
    by_column = np.ascontiguousarray(padded.reshape(rows, COLUMNS).T)
    flat, width = composition.ravel(), len(composition)
    total = of_symbol[by_column[0]].astype(np.int64)
    for column in by_column[1:]:
        total = flat[total * width + of_symbol[column]].astype(np.int64)
    # Inclusive scan of the row functions by doubling.
    shift = 1
    while shift < rows:
        total[shift:] = flat[total[:-shift] * width + total[shift:]]
        shift *= 2
    state = np.empty(rows, np.uint8)
    state[0] = T_START
    state[1:] = image[total[:-1]]
    begins = np.empty_like(by_column, bool)
    for j, column in enumerate(by_column):
        begins[j] = starts[state, column]
        state = moves[state, column]
    return np.ascontiguousarray(begins.T).ravel()[:n]


def pre_tokens(texts: Sequence[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(all texts as UTF-8, byte offsets of the tokens, first token of each text).

    The offsets end with the total size; the last array ends with their count.
    """
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    stop = np.array([0x110000], np.uint32)
    points = np.concatenate([x for part in parts for x in (part, stop)]) if parts else stop[:0]
    begins = token_starts(points) if len(points) else np.zeros(0, bool)
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    sizes[points == 0x110000] = 0
    places = np.cumsum(sizes) - sizes
    data = "".join(texts).encode("utf-8", "surrogatepass")
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    counts = np.cumsum(begins)
    first = np.concatenate([[0], counts[ends - 1]]) if len(ends) else np.zeros(1, np.int64)
    return data, np.append(places[begins], len(data)), first


class Merger:
    """Ids of byte slices by merge rank, with a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE):
        self.ranks, self.limit = ranks, cache
        self.cache: dict[bytes, bytes] = {}
        self.octets = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = sorted(
            (ranks[t[:i]] << 32 | ranks[t[i:]], rank)
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        )
        self.pair_keys = np.array([key for key, _ in pairs], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs], np.int64)

    def known(self, pieces: Sequence[bytes]) -> dict[bytes, bytes]:
        """A mapping that holds at least the given pieces."""
        wanted = set(pieces)
        missing = wanted - self.cache.keys()
        if len(self.cache) + len(missing) > self.limit:
            self.cache = {}
            missing = wanted
        by_length: dict[int, list[bytes]] = {}
        for piece in missing:
            by_length.setdefault(len(piece), []).append(piece)
        for length, group in by_length.items():
            if length >= HEAP_FROM:
                self.cache.update((p, self.merge(p)) for p in group)
            else:
                self.cache.update(zip(group, self.merge_all(group, length)))
        return self.cache

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or ``NEVER``."""
        if not len(self.pair_keys):
            return np.full(left.shape, NEVER)
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge_all(self, pieces: list[bytes], length: int) -> list[bytes]:
        """Merge many pieces of one length side by side.

        Every row holds a piece's ids from the left, -1 behind them. Each pass
        joins, in every row that still has one, the leftmost pair of lowest rank.
        """
        n = len(pieces)
        ids = self.octets[np.frombuffer(b"".join(pieces), np.uint8)].reshape(n, length)
        ids = np.concatenate([ids, np.full((n, 1), -1)], axis=1)
        ranks = np.full((n, length), NEVER)
        ranks[:, : length - 1] = self.pair_rank(ids[:, : length - 1], ids[:, 1:length])
        out = ids.copy()
        place = np.arange(n)
        columns = np.arange(length)
        while True:
            at = ranks.argmin(1)
            rank = ranks[np.arange(len(at)), at]
            open_rows = rank < NEVER
            if not open_rows.all():
                out[place[~open_rows]] = ids[~open_rows]
                ids, ranks, place = ids[open_rows], ranks[open_rows], place[open_rows]
                at, rank = at[open_rows], rank[open_rows]
            if not len(at):
                break
            rows = np.arange(len(at))
            keep = columns <= at[:, None]
            ids[:, :-1] = np.where(keep, ids[:, :-1], ids[:, 1:])
            ids[:, -1] = -1
            ids[rows, at] = rank
            ranks[:, :-1] = np.where(keep[:, :-1], ranks[:, :-1], ranks[:, 1:])
            ranks[:, -1] = NEVER
            after = ids[rows, at + 1]
            ranks[rows, at] = np.where(after >= 0, self.pair_rank(rank, np.maximum(after, 0)), NEVER)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.pair_rank(ids[inner, at[inner] - 1], rank[inner])
        ends = (4 * (out >= 0).sum(1)).tolist()
        flat, width = out.astype(np.int32).tobytes(), 4 * (length + 1)
        return [flat[i * width : i * width + end] for i, end in enumerate(ends)]

    def merge(self, piece: bytes) -> bytes:
        """One long piece, in n log n: a heap of pairs over a linked list."""
        n, ranks = len(piece), self.ranks
        ends = list(range(1, n + 1))
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(piece[i : ends[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ends[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or ends[after[i]] != end:
                continue
            j = after[i]
            alive[j] = False
            ends[i], after[i] = ends[j], after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([ranks[piece[i : ends[i]]] for i in range(n) if alive[i]], np.int32).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(2)
def codec(path: str) -> tuple[Merger, list[bytes]]:
    """Merger and vocabulary of a rank file, kept by the worker."""
    ranks = read_ranks(path)
    vocabulary = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        vocabulary[rank] = piece
    return Merger(ranks), vocabulary


def encode(texts: Sequence[str], merger: Merger) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, their offsets, byte offsets of the pre-tokens, first pre-tokens)."""
    data, offsets, first = pre_tokens(texts)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    index, uniques = distinct(pieces)
    ids, ends = spread(list(map(merger.known(uniques).__getitem__, uniques)), index)
    return ids, ends_of(first, ends), offsets, first


def decode(ids: Sequence[int], vocabulary: Sequence[bytes]) -> bytes:
    return b"".join([vocabulary[i] for i in ids])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int), offsets (bytes at which pre-tokens begin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, _ = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, ends, offsets, first = encode(part.column(1).fill_null("").to_pylist(), merger)
                begins = offsets[:-1] - np.repeat(offsets[first[:-1]], np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(begins, pa.int64())),
                    ],
                    ["doc_id", "ids", "offsets"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, for every document.

    The ids are decoded again in the task that made them. Null texts are empty;
    an empty text has no ids. Equal rows each get a result. Only doc_id and text
    are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, vocabulary = codec(path)
        token = vocabulary.__getitem__
        for batch in batches:
            for part in slices(batch, "text"):
                ids, ends, _, _ = encode(part.column(1).fill_null("").to_pylist(), merger)
                raw, numbers = ids.astype("<u4").tobytes(), ids.tolist()
                marks, decoded = [], []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    marks.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                    decoded.append(hashlib.sha256(b"".join(map(token, numbers[a:b]))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(marks, pa.string()),
                     pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
