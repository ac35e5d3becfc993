"""Plain counts of one text, shared by the operators that judge texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

# The six white-space characters, and those that count as symbols.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?;:()[]{}\"/\\=+~^_@`"


def words_of(data: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text."""
    return data.split()


def lower_ascii(data: bytes) -> bytes:
    """A-Z in lower case; all other bytes as they are."""
    return data.lower()


def count_of(data: bytes, wanted: bytes) -> int:
    return len(data) - len(data.translate(None, wanted))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, n)
    if len(ids) < 1 << 21:
        keys = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    else:
        pairs = np.unique(codes[:-2] * len(ids) + codes[1:-1], return_inverse=True)[1]
        keys = pairs * len(ids) + codes[2:]
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    hit = np.isin(keys, again)
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def line_counts(text: bytes) -> tuple[int, int]:
    """(lines with a word, those of them that equal an earlier line)."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def text_counts(text: str | None) -> dict[str, int]:
    """What the quality operators count; a null text has no words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(data)
    bare = data.translate(None, SPACES)
    chars = len(bare)
    if not bare.isascii():
        chars -= int(((np.frombuffer(bare, np.uint8) & 0xC0) == 0x80).sum())
    n_lines, n_dup_lines = line_counts(data)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": count_of(bare, SYMBOLS),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": repeated_words(words),
        "n_lines": n_lines,
        "n_upper": count_of(bare, UPPER),
        "n_digits": count_of(bare, DIGITS),
        "n_marks": count_of(bare, MARKS),
        "n_distinct": len(set(words)),
    }


def distinct(values: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """(for each value the number of its distinct value, the distinct values)."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def spread(lists: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered lists of ids end to end, and where each of them ends.

    A list is held as the bytes of its 32-bit ids: a cache of many short lists
    takes a third of what tuples of numbers would.
    """
    sizes = np.fromiter(map(len, lists), np.int32, len(lists)) // 4
    flat = np.frombuffer(b"".join(lists), np.int32)
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    own = sizes[index]
    ends = np.cumsum(own, dtype=np.int64)
    at = np.repeat(starts[index] - (ends - own), own)
    at += np.arange(len(at))
    return flat[at], ends


def ends_of(groups: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets of groups of lists: ``groups`` are offsets into the lists."""
    return np.concatenate([[0], ends])[groups]


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text (one row at least)."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
