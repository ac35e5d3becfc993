"""Token ids in ORC files: run-length encoded, indexed, prunable by document.

Documents are ordered by doc_id with a range shuffle, tokenised in that order
within each task, and written as one ORC file per task. ORC keeps the ids as
run-length encoded integers in stripes that are read in parallel, with row
indexes every ``ROW_INDEX`` rows and Bloom filters on doc_id, so that a read for
a few documents skips stripes by metadata. Where each document starts in the
whole sequence follows from the files' totals and a running sum within each.

The tokenizer drops white space and never looks across it, so a word's ids do
not depend on its neighbours. Words are therefore encoded by the library once
per worker and kept in a bounded cache. Words that are missing go to it together:
letters as they are, as each word of them ends in one closing id, and all others
with a separating word between them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from movecheck.llm.text import distinct, ends_of, slices, spread
from movecheck.sources.sinks import scratch_path

CACHE = 350_000
END_ID = 1
ROW_INDEX = 1000
STRIPE_BYTES = 16 << 20
# Fixed value: what the vocabulary writes at the end of a word's last piece.
WORD_END = "</w>"
# Symbols that make a piece of their own behind letters.
CLOSING = b"!#$%&()*+,-./:;<=>?@[]^_`{|}~"
# A private-use character, as a word of its own between words.
SEPARATOR = "\ue000"


class WordEncoder:
    """Ids of texts by way of the ids of their words.

    The words' tokenizer takes strings of special tokens for text. Unless that is
    wanted, texts that may hold one go to the library whole, as it is loaded.
    """

    def __init__(self, path: str, special_as_text: bool = False, cache: int = CACHE):
        self.library = Tokenizer.from_file(path)
        special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.signs = set() if special_as_text else {content[:2] for content in special}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = cache
        self.stems: dict[bytes, bytes] = {}
        self.cache: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.separator = np.array(self._encode(SEPARATOR), np.int64)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _alone(self, word: bytes) -> bytes:
        return np.array(self._encode(word.decode("utf-8", "surrogatepass")), np.int32).tobytes()

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words, none of which holds the separator."""
        text = f" {SEPARATOR} ".join([w.decode("utf-8", "surrogatepass") for w in words])
        ids = np.array(self._encode(text), np.int64)
        k = len(self.separator)
        hits = np.ones(max(len(ids) - k + 1, 0), bool)
        for i, part in enumerate(self.separator):
            hits &= ids[i : len(ids) - k + 1 + i] == part
        cuts = np.flatnonzero(hits)
        if len(cuts) != len(words) - 1:
            return [self._alone(w) for w in words]
        flat = ids.astype(np.int32).tobytes()
        starts = [0, *(cuts + k).tolist()]
        return [flat[4 * a : 4 * b] for a, b in zip(starts, [*cuts.tolist(), len(ids)])]

    def _encode_bare(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters only: each is one piece, closed by one end id."""
        text = b" ".join(words).decode("utf-8", "surrogatepass")
        ids = np.array(self._encode(text), np.int64)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            return self._encode_words(words)
        flat = ids.astype(np.int32).tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def _known(self, cache: dict, words: list[bytes], encode: Callable, run: int = 2000) -> list[bytes]:
        """The ids of distinct words, by way of a bounded cache."""
        found = list(map(cache.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        if missing:
            if len(cache) + len(missing) > self.limit:
                cache.clear()
            new: dict[bytes, bytes] = {}
            for i in range(0, len(missing), run):
                new.update(zip(missing[i : i + run], encode(missing[i : i + run])))
            cache.update(new)
            found = [new[w] if ids is None else ids for w, ids in zip(words, found)]
        return found

    def _encode_any(self, words: list[bytes]) -> list[bytes]:
        mark = SEPARATOR.encode()
        plain = [w for w in words if mark not in w]
        found = dict(zip(plain, self._encode_words(plain))) if plain else {}
        return [found[w] if w in found else self._alone(w) for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of the texts in them)."""
        whole = np.zeros(len(texts), bool)
        for sign in self.signs:
            whole |= pa.compute.match_substring(texts, sign).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_words(texts)
        ids, offsets = self._by_words(pa.compute.if_else(pa.array(whole), "", texts))
        found = self.library.encode_batch_fast([t for t, w in zip(texts.to_pylist(), whole) if w], add_special_tokens=False)
        sizes = np.diff(offsets)
        sizes[whole] = [len(f.ids) for f in found]
        out = np.empty(sizes.sum(), ids.dtype)
        special = np.repeat(whole, sizes)
        out[~special] = ids
        out[special] = np.concatenate([np.array(f.ids, ids.dtype) for f in found])
        return out, np.concatenate([[0], np.cumsum(sizes)])

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts whose special strings are text.

        A word of letters with closing symbols is its letters, in lower case,
        followed by its symbols; any other word is looked up as it is.
        """
        lists = pa.compute.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = lists.values
        bare = pa.compute.ascii_lower(pa.compute.ascii_rtrim(words, CLOSING.decode()))
        stem_of, stems = distinct(bare.cast(pa.large_binary()))
        plain = np.array([letters_only(stem) for stem in stems], bool)[stem_of] if stems else np.zeros(0, bool)
        used = np.unique(stem_of[plain])
        number = np.zeros(len(stems), np.int64)
        number[used] = np.arange(len(used))
        table = self._known(self.stems, [stems[i] for i in used.tolist()], self._encode_bare)

        lengths = pa.compute.binary_length(bare).to_numpy().astype(np.int64)
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        begins, ends = bounds[:-1], bounds[1:]
        closed = plain & (begins + lengths < ends)
        starts, sizes = (begins + lengths)[closed], (ends - begins - lengths)[closed]
        symbol_of, symbols = distinct(cut_out(words, starts, sizes))
        other_of, others = distinct(words.filter(pa.array(~plain)).cast(pa.large_binary()))
        index = np.empty(len(words), np.int64)
        index[plain] = number[stem_of[plain]]
        index[~plain] = other_of + len(table) + len(symbols)
        # A closed word takes two places in the sequence of looked-up parts.
        place = np.arange(len(words)) + np.cumsum(closed) - closed
        parts = np.empty(len(words) + int(closed.sum()), np.int64)
        parts[place] = index
        parts[place[closed] + 1] = symbol_of + len(table)
        table = table + self._known(self.cache, symbols + others, self._encode_any)
        ids, part_ends = spread(table, parts)
        groups = np.append(place, len(parts))[lists.offsets.to_numpy()]
        return ids, ends_of(groups, part_ends)


def letters_only(stem: bytes) -> bool:
    """True for letters that stay letters in lower case (which can bring marks)."""
    return stem.isalpha() if stem.isascii() else stem.decode("utf-8", "surrogatepass").lower().isalpha()


def cut_out(words: pa.Array, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Slices of the words' bytes as an array of their own."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
    )


@lru_cache(2)
def word_encoder(path: str, special_as_text: bool) -> WordEncoder:
    return WordEncoder(path, special_as_text)


def write_token_files(
    docs: DataFrame, target: str, tokenizer: str, end_id: int = END_ID, special_as_text: bool = False
) -> None:
    """Write doc_id and ids (with the end id) as ORC, in ascending doc_id order.

    Null texts are empty and hold only the end id. Rows without a doc_id come
    first. Rows with equal doc_id all stay, ordered by their texts; the ranges
    are cut by doc_id and a hash of the text, so a doc_id with many texts is
    spread. The ids are the library's: strings of special tokens in a text become
    these, unless ``special_as_text``. Only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, special_as_text)
        for batch in batches:
            for part in slices(batch, "text", 16 << 20):
                flat, offsets = encoder.encode(part.column(1).fill_null(""))
                flat = np.insert(flat, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    mark = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", mark)
        .sortWithinPartitions("doc_id", mark, "text")
    )
    (
        ordered.mapInArrow(run, "doc_id long, ids array<int>")
        .write.format("orc")
        .option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROW_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .save(target)
    )


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        columns = [
            batch.column("doc_id"), batch.column("part"),
            pa.array([b - a for a, b in spans], pa.int64()),
            pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in spans], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "n_tokens", "ids_crc32"])


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents in token files.

    Spark numbers the files of a write by task, and so in the order of ranges;
    inside a file, rows follow each other by stripe offset and place. Each file
    is summed once; the running sum over files handles one row per file.
    """
    place = F.struct(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = (
        spark.read.schema("doc_id long, ids array<int>").orc(path)
        .withColumn("part", place)
        .mapInArrow(
            _check,
            "doc_id long, part struct<file: long, block: long, row: long>, n_tokens long, ids_crc32 long",
        )
        .select("doc_id", "part.*", "n_tokens", "ids_crc32")
    )
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    files = totals.select(
        "file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before")
    )
    order = Window.partitionBy("file").orderBy("block", "row")
    within = F.sum("n_tokens").over(order) - F.col("n_tokens")
    return (
        rows.withColumn("within", within)
        .join(files, "file")
        .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
    )


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id and ids of the given documents, from token files.

    The filter reaches the scan: files and stripes whose range or Bloom filter
    excludes the ids are skipped, and in the others all row groups but theirs.
    """
    rows = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return rows.filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def token_files(docs: DataFrame, tokenizer: str, target: str | None = None, special_as_text: bool = False) -> DataFrame:
    """Write the token files, then return their index as read from them."""
    spark = docs.sparkSession
    target = target or scratch_path(spark, "tokens")
    write_token_files(docs, target, tokenizer, special_as_text=special_as_text)
    return read_token_index(spark, target)
