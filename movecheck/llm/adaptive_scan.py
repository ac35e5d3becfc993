"""Nearest neighbours with probed lists and adaptive dimension scans.

Vectors are turned by a random rotation, so that any leading coordinates are a
fair sample of the whole. Lists come from k-means on a bounded sample; every
vector belongs to the list of its nearest centre, and every query probes the
lists nearest to it. A probed list is scanned in blocks of columns: after each,
the partial squared distance, scaled up, is tested against the query's current
tenth-best distance; a candidate whose distance is larger beyond the error that
t of d sampled coordinates allow is abandoned. Survivors get their exact
distance, in double precision, from the original vectors.

The bound of a query is its tenth-best distance to those members of the sample
that its probed lists hold, so the scan finds ten at least. The sample gives
bounds only: every result comes from the scan, whatever the size of the table.
Where the probed lists hold fewer than ten of the sample, a query probes further
ones until they do or all are probed. Lists are stored as rows of about
``BLOCK`` vectors, queries likewise, and Spark joins the two by list; a list
with a third of all vectors is just more rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movecheck.sources.sinks import saved

SAMPLE = 4096
BLOCK = 2048
QUERY_BLOCK = 256
COLUMNS = 16
MAX_LISTS = 256
# Lists that a query probes: this share, and at least so many.
PROBED, LEAST_PROBED = 0.7, 24
# Width of the test, in standard errors of a partial distance.
EPSILON = 2.1
NEAREST = 10


@dataclass
class Index:
    """What every task needs: rotation, centres, and the sample."""

    rotation: np.ndarray
    centres: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    sample_lists: np.ndarray
    probed: int

    def order_of(self, vectors: np.ndarray) -> np.ndarray:
        """All lists, nearest first, for every vector."""
        return (-2 * vectors @ self.centres.T + np.square(self.centres).sum(1)).argsort(axis=1, kind="stable")

    def own_lists(self, vectors: np.ndarray) -> np.ndarray:
        """The list of every vector."""
        return (-2 * vectors @ self.centres.T + np.square(self.centres).sum(1)).argmin(1)

    def probes(self, query: int, vector: np.ndarray, order: np.ndarray, nearest: int) -> tuple[np.ndarray, float]:
        """The lists that a query probes, and its tenth-best distance to the sample in them."""
        far = np.sqrt(np.square(self.sample - vector).sum(1))
        count = self.probed
        while True:
            there = np.flatnonzero(np.isin(self.sample_lists, order[:count]) & (self.sample_ids != query))
            best = there[np.argsort(far[there], kind="stable")]
            _, once = np.unique(self.sample_ids[best], return_index=True)
            if len(once) >= nearest:
                return order[:count], float(far[best[np.sort(once)[nearest - 1]]])
            if count >= len(order):
                return order, float("inf")
            count += 1


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id and v (doubles): rows whose vector takes part.

    Not null, not all zero, every component finite, and of the table's most
    common length (the longer one, if two are as common).
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    )
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def k_means(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), k, replace=False)].copy()
    for _ in range(rounds):
        own = (-2 * sample @ centres.T + np.square(centres).sum(1)).argmin(1)
        sums, counts = np.zeros_like(centres), np.bincount(own, minlength=k)
        np.add.at(sums, own, sample)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def fit_index(rows: DataFrame, n: int, sample: int = SAMPLE, probed: float = PROBED) -> Index:
    """Rotation, centres and sample from the ``sample`` rows of smallest hash."""
    # About twice the sample passes the threshold, so that no task sorts more than
    # its share; at most ``sample`` vectors come to the driver.
    share = min(1.0, 2 * sample / n)
    few = rows.filter(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 32)) < int(share * (1 << 32))) if share < 1 else rows
    chosen = few.orderBy(F.xxhash64("id"), "id", "v").limit(sample).toPandas()
    vectors = np.array(chosen["v"].tolist(), float)
    d = vectors.shape[1]
    rotation, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))
    k = max(1, min(MAX_LISTS, len(vectors), round(math.sqrt(n) / 2)))
    index = Index(rotation, k_means(vectors, k), chosen["id"].to_numpy(), vectors, np.zeros(0), min(k, max(math.ceil(k * probed), LEAST_PROBED)))
    index.sample_lists = index.own_lists(vectors)
    return index


def scan(index: Index, queries: dict, ids: np.ndarray, vectors: np.ndarray, nearest: int) -> Iterator[tuple]:
    """(query, id, distance) of the nearest of a block, for every query."""
    d = vectors.shape[1]
    turned = vectors @ index.rotation
    blocks = [np.ascontiguousarray(turned[:, a : a + COLUMNS]) for a in range(0, d, COLUMNS)]
    all_rows = np.arange(len(ids))
    for query, vector, bound in zip(queries["id"], queries["v"], queries["bound"]):
        vector = np.asarray(vector)
        own = vector @ index.rotation
        alive = all_rows[ids != query]
        partial = np.zeros(len(alive))
        for b, block in enumerate(blocks):
            part = block[alive] - own[b * COLUMNS : (b + 1) * COLUMNS]
            partial += np.einsum("ij,ij->i", part, part)
            t = min((b + 1) * COLUMNS, d)
            # The last block is the whole distance, up to rounding.
            slack = (1 + EPSILON / math.sqrt(t)) ** 2 * t / d if t < d else 1 + 1e-9
            keep = partial <= bound * bound * slack + 1e-12
            alive, partial = alive[keep], partial[keep]
        if not len(alive):
            continue
        exact = np.sqrt(np.square(vectors[alive] - vector).sum(1))
        order = np.lexsort((ids[alive], exact))
        # Of rows with one id the nearest counts, before the best are taken.
        _, once = np.unique(ids[alive[order]], return_index=True)
        for i in order[np.sort(once)[:nearest]]:
            yield query, int(ids[alive[i]]), float(exact[i])


FOUND = "query_id long, vec_id long, score double"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    types = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "vec_id", "score"]
    )


def nearest_neighbours(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    every: int = 100,
    nearest: int = NEAREST,
    sample: int = SAMPLE,
    probed: float = PROBED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    with another id. Rows with equal ids count once, at the nearest vector; ties
    go to the smaller id. What does not take part is said at :func:`usable`. An
    empty table, or one without a usable vector, gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, column)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit_index(rows, n, sample, probed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = index.own_lists(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.int32())], ["id", "v", "list"]
            )

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(1))
            found = [
                index.probes(query, vector, order, nearest)
                for query, vector, order in zip(batch.column(0).to_pylist(), own, index.order_of(own))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([bound for _, bound in found], pa.float64()),
                 pa.array([lists.tolist() for lists, _ in found], pa.list_(pa.int32()))],
                ["id", "v", "bound", "lists"],
            )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries = {k: [q[k] for q in row["queries"]] for k in ("id", "v", "bound")}
                ids = np.array([c["id"] for c in row["members"]], np.int64)
                block = np.array([c["v"] for c in row["members"]], float)
                yield _found(list(scan(index, queries, ids, block, nearest)))

    def blocks(frame: DataFrame, by: str, size: int, fields: list[str], name: str) -> DataFrame:
        """Rows of about ``size`` members of a list each."""
        sizes = saved(frame.groupBy("list").agg(F.ceil(F.count("*") / size).alias("n_blocks")), "lists")
        salt = F.pmod(F.xxhash64(by, F.monotonically_increasing_id()), F.col("n_blocks"))
        cut = frame.join(sizes, "list").withColumn("block", salt)
        return cut.groupBy("list", "block").agg(F.collect_list(F.struct(*fields)).alias(name)).drop("block")

    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    kind = "id long, v array<double>, bound double, lists array<int>"
    queries = saved(queries.mapInArrow(prepare, kind), "queries")
    probes = queries.select("id", "v", "bound", F.explode("lists").alias("list"))
    listed = saved(rows.mapInArrow(assign, "id long, v array<double>, list int"), "vectors")
    pairs = blocks(listed, "id", BLOCK, ["id", "v"], "members").join(
        blocks(probes, "id", QUERY_BLOCK, ["id", "v", "bound"], "queries"), "list"
    )
    found = pairs.select("members", "queries").mapInArrow(scanned, FOUND)
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        once.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)
