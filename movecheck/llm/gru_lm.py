"""Language-model scoring with a gated recurrent network in numpy.

Counts first: every word of every training document is counted by Spark. They
give the base score (additive smoothing) and the vocabulary: the most frequent
words, the end of a document, and one symbol for all other words. The network
reads a symbol at a time; its output is a softmax over classes (32 blocks of
symbols by frequency) times a softmax within the class. What a text's rarer
words are worth beyond their common symbol follows from their counts, so the
score is a distribution over all texts, as the base is.

Training is truncated backpropagation: windows of ``WINDOW`` steps, the state
carried from one to the next. A start is fitted in one task on a bounded sample;
then every task goes on from it over all training documents of its partition,
and the weights are averaged by Spark in proportion to the tokens seen.

Documents run side by side in lanes, one after the other in each, so that a step
is one matrix product for all lanes. Scoring carries the state through the whole
document.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movecheck.llm.gam import remainder
from movecheck.llm.text import slices
from movecheck.sources.sinks import saved

HIDDEN = 16
CLASSES = 32
PER_CLASS = 32
SYMBOLS = CLASSES * PER_CLASS
END, OTHER, FIRST_WORD = 0, 1, 2
WINDOW = 16
LANES = 384
FREQUENT = 60_000
SAMPLE = 400
EPOCHS = 6
START_RATE, RATE = 0.08, 0.01
SLICE = 12 << 20

PARTS = {
    "into": (SYMBOLS, 3 * HIDDEN), "back": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,),
    "word_w": (CLASSES, HIDDEN, PER_CLASS), "word_b": (CLASSES, PER_CLASS),
}
SIZE = sum(math.prod(shape) for shape in PARTS.values())


class Network:
    """Named views into one vector of weights."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        at = 0
        for part, shape in PARTS.items():
            size = math.prod(shape)
            setattr(self, part, weights[at : at + size].reshape(shape))
            at += size


def initial(frequencies: np.ndarray, seed: int = 5) -> np.ndarray:
    """Small random weights; output biases that give the symbols' frequencies."""
    rng = np.random.default_rng(seed)
    network = Network((rng.standard_normal(SIZE) * 0.1).astype(np.float32))
    shares = (frequencies + 0.5).reshape(CLASSES, PER_CLASS)
    network.class_b[:] = np.log(shares.sum(1) / shares.sum())
    network.word_b[:] = np.log(shares / shares.sum(1, keepdims=True))
    return network.weights


@dataclass
class Lanes:
    """Documents laid end to end in lanes, the longest lane first.

    ``symbols`` and ``fresh`` (a document begins here) have a row per step;
    ``width`` says how many lanes still run at each step. ``spans`` places each
    document: lane, first step, steps.
    """

    symbols: np.ndarray
    fresh: np.ndarray
    width: np.ndarray
    spans: list[tuple[int, int, int]]


def lay_out(texts: Sequence[np.ndarray], lanes: int = LANES) -> Lanes:
    """At most so many lanes, and no more than the longest text leaves use for.

    Twice the tokens over the longest text are enough for its lane to stay the
    longest, and the rectangle is of three times the tokens or so.
    """
    longest = max(map(len, texts), default=1)
    lanes = min(lanes, max(-(-2 * sum(map(len, texts)) // longest), 1))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    total = [0] * min(lanes, max(len(texts), 1))
    owner: list[tuple[int, int]] = [(0, 0)] * len(texts)
    heap = [(0, lane) for lane in range(len(total))]
    for i in order:
        length, lane = heapq.heappop(heap)
        owner[i] = lane, length
        total[lane] = length + len(texts[i])
        heapq.heappush(heap, (total[lane], lane))
    rank = sorted(range(len(total)), key=lambda lane: -total[lane])
    place = {lane: j for j, lane in enumerate(rank)}
    steps = max(total)
    symbols = np.zeros((steps, len(total)), np.int32)
    fresh = np.zeros((steps, len(total)), bool)
    spans = []
    for i, text in enumerate(texts):
        lane, start = place[owner[i][0]], owner[i][1]
        symbols[start : start + len(text), lane] = text
        fresh[start, lane] = True
        spans.append((lane, start, len(text)))
    ends = np.array([total[lane] for lane in rank])
    width = len(ends) - np.searchsorted(ends[::-1], np.arange(steps), side="right")
    return Lanes(symbols, fresh, width, spans)


def windows(width: np.ndarray, steps: int, rows: int) -> Iterator[tuple[int, int]]:
    """Runs of at most so many steps, and of at most so many rows (one step at least)."""
    upto, start = np.cumsum(width), 0
    while start < len(width):
        before = upto[start - 1] if start else 0
        most = int(np.searchsorted(upto, before + rows, side="right"))
        stop = max(min(most, start + steps), start + 1)
        yield start, stop
        start = stop


@dataclass
class Steps:
    """Steps of a window, end to end: a row per step and lane that still runs.

    ``cuts`` has the offsets of the steps, ``fresh`` the lanes where documents
    begin. The arrays are the state before and after, the two gates, what the
    reset gate lets through and the candidate; the next window overwrites them.
    """

    cuts: list[int]
    fresh: list[np.ndarray]
    before: np.ndarray
    gates: np.ndarray
    through: np.ndarray
    candidate: np.ndarray
    after: np.ndarray


class Runner:
    """Steps a network through lanes, window by window.

    Arrays are made once, for windows of so many rows, and hold the gates one
    after the other: numpy takes whole blocks several times as fast as columns.
    """

    def __init__(self, network: Network, lanes: Lanes, rows: int = WINDOW * LANES):
        self.network, self.lanes = network, lanes
        n = lanes.symbols.shape[1]
        rows = min(max(rows, n), max(int(lanes.width.sum()), 1))
        self.state = np.zeros((n, HIDDEN), np.float32)
        # What is read at a step is the symbol before it; a document begins with END.
        self.read = np.zeros_like(lanes.symbols)
        self.read[1:] = lanes.symbols[:-1]
        self.read[lanes.fresh] = END
        begun, self.begun_lanes = np.nonzero(lanes.fresh)
        self.begun = np.searchsorted(begun, np.arange(len(lanes.symbols) + 1))
        self.before, self.through, self.candidate, self.after = np.empty((4, rows, HIDDEN), np.float32)
        self.gates = np.empty((2, rows, HIDDEN), np.float32)
        self.inputs, self.backs = np.empty((2, 3 * n * HIDDEN), np.float32)
        self.change = np.empty((n, HIDDEN), np.float32)

    def forward(self, start: int, stop: int) -> Steps:
        """States and gates of the steps; the last state is kept."""
        into = self.network.into.reshape(SYMBOLS, 3, HIDDEN).transpose(1, 0, 2).copy()
        back = self.network.back.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2).copy()
        # The sigmoids want their arguments negated.
        np.negative(into[:2], out=into[:2])
        np.negative(back[:2], out=back[:2])
        widths = self.lanes.width[start:stop].tolist()
        cuts = [0, *itertools.accumulate(widths)]
        begun = self.begun[start : stop + 1].tolist()
        fresh = [self.begun_lanes[a:b] for a, b in zip(begun, begun[1:])]
        state = self.state
        for t, w, a, b, firsts in zip(range(start, stop), widths, cuts, cuts[1:], fresh):
            h, g, n, new = self.before[a:b], self.gates[:, a:b], self.candidate[a:b], self.after[a:b]
            through, change = self.through[a:b], self.change[:w]
            x = self.inputs[: 3 * w * HIDDEN].reshape(3, w, HIDDEN)
            hu = self.backs[: 3 * w * HIDDEN].reshape(3, w, HIDDEN)
            h[:] = state[:w]
            if len(firsts):
                h[firsts] = 0
            into.take(self.read[t, :w], axis=1, out=x, mode="clip")
            np.matmul(h, back, out=hu)
            np.add(x[:2], hu[:2], out=g)
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            through[:] = hu[2]
            np.multiply(g[1], through, out=n)
            n += x[2]
            np.tanh(n, out=n)
            np.subtract(h, n, out=change)
            change *= g[0]
            np.add(n, change, out=new)
            state = new
        self.state[: len(state)] = state
        rows = cuts[-1]
        return Steps(
            cuts, fresh, self.before[:rows], self.gates[:, :rows], self.through[:rows], self.candidate[:rows],
            self.after[:rows],
        )

    def targets(self, start: int, stop: int) -> np.ndarray:
        return self._running(self.lanes.symbols, start, stop)

    def symbols_read(self, start: int, stop: int) -> np.ndarray:
        return self._running(self.read, start, stop)

    def _running(self, values: np.ndarray, start: int, stop: int) -> np.ndarray:
        """The values of the steps in the lanes that still run, end to end."""
        return np.concatenate([values[t, : self.lanes.width[t]] for t in range(start, stop)])


def output(net: Network, states: np.ndarray, targets: np.ndarray, gradient: np.ndarray | None = None):
    """Log probabilities of the targets; sets their gradient if one is given.

    With a gradient also returns that of the states.
    """
    # In the order of classes, so that each class is one run of rows.
    order = np.argsort((targets // PER_CLASS).astype(np.uint8), kind="stable")
    classes, words = np.divmod(targets[order], PER_CLASS)
    cuts = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    runs = [(c, slice(a, b)) for c, a, b in zip(range(CLASSES), cuts, cuts[1:]) if a < b]
    n = len(targets)
    # A column of ones takes the biases along.
    ordered = np.ones((n, HIDDEN + 1), np.float32)
    ordered[:, :HIDDEN] = states.take(order, axis=0)
    class_w = np.concatenate([net.class_w, net.class_b[None]])
    word_w = np.concatenate([net.word_w, net.word_b[:, None]], axis=1)
    # First the classes of all rows, then the words within them: as many in each as classes.
    logits = np.empty((2 * n, PER_CLASS), np.float32)
    np.matmul(ordered, class_w, out=logits[:n])
    within = logits[n:]
    for c, own in runs:
        np.matmul(ordered[own], word_w[c], out=within[own])
    at = np.arange(0, logits.size, PER_CLASS)
    at[:n] += classes
    at[n:] += words
    flat = logits.reshape(-1)
    chosen = flat.take(at)
    # States are within -1 and 1; logits beyond reach of floats are cut.
    if max(np.abs(class_w).sum(0).max(), np.abs(word_w).sum(1).max()) > 80:
        np.clip(logits, -80, 80, out=logits)
    np.exp(logits, out=logits)
    sums = logits @ np.ones(PER_CLASS, np.float32)
    logs = chosen - np.log(sums)
    out = np.empty(n, np.float32)
    out[order] = logs[:n] + logs[n:]
    if gradient is None:
        return out
    grad = Network(gradient)
    logits *= (1 / sums)[:, None]
    flat[at] -= 1
    d_classes = ordered.T @ logits[:n]
    grad.class_w[:], grad.class_b[:] = d_classes[:HIDDEN], d_classes[HIDDEN]
    d_states = logits[:n] @ net.class_w.T
    d_words, d_within = np.zeros_like(word_w), np.empty_like(d_states)
    for c, own in runs:
        np.matmul(ordered[own].T, within[own], out=d_words[c])
        np.matmul(within[own], net.word_w[c].T, out=d_within[own])
    grad.word_w[:], grad.word_b[:] = d_words[:, :HIDDEN], d_words[:, HIDDEN]
    d_states += d_within
    back = np.empty_like(d_states)
    back[order] = d_states
    return out, back


def window_gradient(runner: Runner, start: int, stop: int) -> tuple[np.ndarray, int]:
    """Gradient of the window's mean negative log likelihood, and its tokens."""
    net = runner.network
    steps = runner.forward(start, stop)
    gradient = np.zeros(SIZE, np.float32)
    targets = runner.targets(start, stop)
    _, d = output(net, steps.after, targets, gradient)
    grad = Network(gradient)
    z, r = steps.gates
    # What a state's gradient is times for that of the candidate, and of what is
    # added up from the state before in the two gates and the candidate.
    to_candidate = 1 - steps.candidate * steps.candidate
    to_candidate *= 1 - z
    to_back = np.empty((len(d), 3, HIDDEN), np.float32)
    np.multiply((steps.before - steps.candidate) * z, 1 - z, out=to_back[:, 0])
    np.multiply(to_candidate, r, out=to_back[:, 2])
    np.multiply(to_back[:, 2] * steps.through, 1 - r, out=to_back[:, 1])
    back = net.back.T.copy()
    flat = to_back.reshape(len(d), 3 * HIDDEN)
    carry = None
    for a, b, firsts in zip(steps.cuts[-2::-1], steps.cuts[:0:-1], reversed(steps.fresh)):
        own = d[a:b]
        if carry is not None:
            own[: len(carry)] += carry
        to_back[a:b] *= own[:, None]
        carry = flat[a:b] @ back
        carry += own * z[a:b]
        if len(firsts):
            carry[firsts] = 0
    grad.back[:] = steps.before.T @ flat
    np.multiply(d, to_candidate, out=to_back[:, 2])
    symbols = runner.symbols_read(start, stop).astype(np.int16)
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    firsts = np.flatnonzero(np.diff(symbols, prepend=-1))
    grad.into[symbols[firsts]] = np.add.reduceat(flat.take(order, axis=0), firsts, axis=0)
    gradient /= len(targets)
    return gradient, len(targets)


def train_on(weights: np.ndarray, texts: Sequence[np.ndarray], memory: np.ndarray, rate: float) -> int:
    """One pass of truncated backpropagation; changes weights and memory."""
    if not texts:
        return 0
    runner = Runner(Network(weights), lay_out(texts))
    tokens = 0
    for start, stop in windows(runner.lanes.width, WINDOW, WINDOW * LANES):
        gradient, n = window_gradient(runner, start, stop)
        memory += gradient * gradient
        gradient *= rate
        gradient /= np.sqrt(memory) + np.float32(1e-4)
        weights -= gradient
        tokens += n
    return tokens


def log_likelihoods(weights: np.ndarray, texts: Sequence[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of every text, the state carried through it."""
    if not texts:
        return np.zeros(0)
    runner = Runner(Network(weights), lay_out(texts))
    lanes = runner.lanes
    sums = np.zeros(len(texts))
    owner = np.zeros(lanes.symbols.shape[1], np.int64)
    begins = sorted(((first, lane, i) for i, (lane, first, _) in enumerate(lanes.spans)), reverse=True)
    # Where few lanes run, many steps make a window.
    for start, stop in windows(lanes.width, len(lanes.width), WINDOW * LANES):
        steps = runner.forward(start, stop)
        found = output(runner.network, steps.after, runner.targets(start, stop))
        for t, a, b in zip(range(start, stop), steps.cuts, steps.cuts[1:]):
            while begins and begins[-1][0] == t:
                _, lane, i = begins.pop()
                owner[lane] = i
            # Every lane has a document of its own.
            sums[owner[: b - a]] += found[a:b]
    return sums


def run_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the runs between offsets; each is added up on its own."""
    sums = np.add.reduceat(np.append(values, 0.0), offsets[:-1])
    sums[offsets[1:] == offsets[:-1]] = 0.0
    return sums


# --- words ------------------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts in lower case, offsets of the texts).

    Split first: pyarrow's ascii_lower misreads a slice that was cast to large strings.
    """
    lists = pa.compute.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
    words = pa.compute.ascii_lower(lists.flatten())
    filled = pa.compute.greater(pa.compute.binary_length(words), 0)
    offsets = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    return words.filter(filled), offsets[np.concatenate([[0], np.cumsum(lengths)])]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words, _ = split_words(part.column(0))
            counts = words.value_counts()
            yield pa.RecordBatch.from_arrays(
                [counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "c"]
            )


def word_counts(docs: DataFrame) -> DataFrame:
    """word and c for every word of the documents."""
    counted = docs.select("text").mapInArrow(_count, "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words with their counts, in order, and the totals of training."""

    words: list[str]
    counts: np.ndarray
    n_docs: int
    n_tokens: int
    n_distinct: int

    def symbol_counts(self) -> np.ndarray:
        top = self.counts[: SYMBOLS - FIRST_WORD]
        out = np.zeros(SYMBOLS)
        out[END], out[OTHER] = self.n_docs, self.n_tokens - self.n_docs - top.sum()
        out[FIRST_WORD : FIRST_WORD + len(top)] = top
        return out

    def codes(self, words: pa.Array, most: int = FREQUENT) -> np.ndarray:
        """Place of each word among the first of the frequent ones, -1 for others."""
        known = pa.compute.index_in(words, pa.array(self.words[:most], words.type))
        return known.fill_null(-1).to_numpy()


def symbol_texts(codes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The symbols of each text, with its end."""
    symbols = np.where((codes >= 0) & (codes < SYMBOLS - FIRST_WORD), codes + FIRST_WORD, OTHER)
    end = np.array([END])
    return [np.concatenate([symbols[a:b], end]) for a, b in zip(offsets[:-1], offsets[1:])]


def _texts(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words, offsets = split_words(part.column(0))
            yield symbol_texts(vocabulary.codes(words, SYMBOLS - FIRST_WORD), offsets)


def gather_vocabulary(training: DataFrame, counts: DataFrame) -> Vocabulary:
    """Totals, and at most ``FREQUENT`` words, to the driver.

    These are all words from the count on at which no more than so many remain.
    """
    n_docs = training.count()
    totals = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    # A row per different count, far fewer than words.
    upto = F.sum("words").over(Window.orderBy(F.desc("c")))
    least = (
        counts.groupBy("c").agg(F.count("*").alias("words")).withColumn("upto", upto)
        .filter(F.col("upto") <= FREQUENT).agg(F.min("c").alias("c")).first()["c"]
    )
    top = counts.filter(F.col("c") >= F.lit(least)).toPandas()
    top = top.sort_values(["c", "word"], ascending=[False, True])
    return Vocabulary(
        top["word"].tolist(), top["c"].to_numpy(np.int64), n_docs, totals["n"] + n_docs,
        totals["v"] + (n_docs > 0),
    )


def train(training: DataFrame, vocabulary: Vocabulary, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the network: a start from a sample, then one averaged pass."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    first = initial(vocabulary.symbol_counts())

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, memory = first.copy(), np.zeros(SIZE, np.float32)
        parts = list(_texts(batches, shared.value))
        for _ in range(EPOCHS):
            for texts in parts:
                train_on(weights, texts, memory, START_RATE)
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.list_(pa.float32()))], ["weights"])

    # About twice the sample passes the threshold, so the one task that orders it gets
    # no more than that, however many tasks read the corpus.
    mark, whole = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)), 1 << 40
    share = min(1.0, 2 * sample / max(vocabulary.n_docs, 1))
    few = training.filter(mark < int(share * whole)) if share < 1 else training
    bounded = few.orderBy(mark, "doc_id", "text").limit(sample).select("text").coalesce(1)
    rows = bounded.mapInArrow(begin, "weights array<float>").collect()
    start = np.array(rows[0]["weights"], np.float32) if rows else first
    begun = spark.sparkContext.broadcast(start)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, memory = begun.value.copy(), np.full(SIZE, 1e-4, np.float32)
        tokens = sum(train_on(weights, texts, memory, RATE) for texts in _texts(batches, shared.value))
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens], pa.int64()), pa.array([weights], pa.list_(pa.float32()))],
                ["tokens", "weights"],
            )

    each = training.select("text").mapInArrow(go_on, "tokens long, weights array<float>")
    # A row per weight and task, summed before the shuffle; SIZE rows come back.
    mean = (
        each.select("tokens", F.posexplode("weights").alias("place", "w"))
        .groupBy("place").agg((F.sum(F.col("w") * F.col("tokens")) / F.sum("tokens")).alias("w"))
        .toPandas().sort_values("place")
    )
    return mean["w"].to_numpy(np.float32) if len(mean) == SIZE else start


def score(docs: DataFrame, vocabulary: Vocabulary, counts: DataFrame, weights: np.ndarray) -> DataFrame:
    """Scores of all documents under counts and network.

    Frequent words are scored where the document is read; the others are joined
    with their counts by word, and only those move.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))
    top = vocabulary.counts[: SYMBOLS - FIRST_WORD]
    base_total = math.log10(vocabulary.n_tokens + vocabulary.n_distinct + 1)
    rest = vocabulary.n_tokens - vocabulary.n_docs - int(top.sum())
    rest_distinct = vocabulary.n_distinct - (vocabulary.n_docs > 0) - len(top)
    rest_total = math.log10(rest + rest_distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        worth = np.log10(vocabulary.counts + 1.0)
        end_worth = math.log10(vocabulary.n_docs + 1.0)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, offsets = split_words(part.column("text"))
                codes = vocabulary.codes(words)
                logs = log_likelihoods(weights, symbol_texts(codes, offsets)) / math.log(10)
                known = codes >= 0
                own = np.where(known, worth[np.maximum(codes, 0)] if len(worth) else 0.0, 0.0)
                # Words behind the common symbol: their own share of it.
                common = np.where(known & (codes < SYMBOLS - FIRST_WORD), 0.0, own - rest_total)
                base, beyond, n_known = (run_sums(x, offsets) for x in (own, common, known))
                n_tokens = np.diff(offsets) + 1
                lengths = np.diff(np.concatenate([[0], np.cumsum(~known)])[offsets])
                rare = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
                    words.filter(pa.array(~known)).cast(pa.string()),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"), pa.array(n_tokens, pa.int64()),
                        pa.array(n_known.astype(np.int64) + (vocabulary.n_docs > 0)),
                        pa.array(base + end_worth - n_tokens * base_total),
                        pa.array(logs + beyond), rare,
                    ],
                    ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"],
                )

    schema = (
        "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
        "rare array<string>"
    )
    numbered = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    scored = saved(numbered.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode("rare").alias("word"))
    added = (
        rare.join(counts, "word").groupBy("row")
        .agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("c") + 1.0)).alias("more"))
    )
    total = scored.drop("rare").join(added, "row", "left")
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return total.select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens",
        (F.col("n_known") + more_known).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def score_documents(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Base and network log10 likelihood of every document's whole text.

    Learns from documents whose remainder modulo 7 is not 2. Returns doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score. Null and empty
    texts are one token, the end. Equal rows each get a score; rows without a
    doc_id are training documents. Without training documents all counts are
    zero and the network is as it was made. Only doc_id and text are read.
    """
    training = docs.filter(remainder("doc_id", 7) != 2).select("doc_id", "text")
    counts = saved(word_counts(training), "words")
    vocabulary = gather_vocabulary(training, counts)
    return score(docs, vocabulary, counts, train(training, vocabulary, sample))
