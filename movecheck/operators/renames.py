"""Renamed columns: pairs of one-sided columns that hold the same values.

A sketch of each column prunes the pairs, and exact counts decide. Values are
hashed once; per column and hash bucket Spark keeps the smallest hash (one
permutation MinHash) and the number of rows. Both collapse in the map tasks, so
a column costs a fixed number of rows whatever the size of the table. Buckets
joined on their number give the estimates of all pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.digits import own_digits, plain_text, without_end_zeros
from movecheck.functions.names import column, name_key, names_by_key
from movecheck.functions.types import FLOAT_TYPES
from movecheck.operators.drift import ONLY_LEFT, ONLY_RIGHT
from movecheck.operators.tidy import computed

# Fixed value: the outcome for a pair of columns.
RENAMED = "renamed"

BUCKETS = 1024
MIN_SIMILARITY = 0.75
# The bucket of nulls.
NULLS = -1


def _text(value: Column, dtype: T.DataType) -> Column:
    """A text that equal values have in whatever type they are stored; floats see :func:`_hashes`."""
    if isinstance(dtype, T.DecimalType):
        return without_end_zeros(value.cast("string"))
    if isinstance(dtype, T.DateType):
        return value.cast("timestamp_ntz").cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def _hashes(df: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, h) of every row and named column; h is null for a null.

    Numbers lose their trailing zeros, so they agree in any type; dates read
    like timestamps at midnight, and nested values become JSON. Floats are
    spelled out after the columns became rows, by one expression for all.
    """
    entries = []
    for name in names:
        value, dtype = column(name), df.schema[name].dataType
        number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
        if isinstance(dtype, FLOAT_TYPES):
            number = own_digits(value, dtype)
        else:
            text = _text(value, dtype)
        entries.append(F.struct(F.lit(name).alias("column_name"), number.alias("number"), text.alias("text")))
    rows = df.select(F.inline(F.array(*entries)))
    rows = computed(rows, "plain", plain_text(F.col("number"), T.DoubleType()))
    size = without_end_zeros(F.col("plain"))
    signed = F.when((F.col("number") < 0) & (size != "0"), F.concat(F.lit("-"), size)).otherwise(size)
    text = F.coalesce("text", signed, F.col("number").cast("string"))
    return rows.select("column_name", F.when(text.isNotNull(), F.xxhash64(text)).alias("h"))


def column_sketches(df: DataFrame, names: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Per column and bucket: the smallest hash and the share of the rows."""
    bucket = F.coalesce(F.pmod("h", F.lit(buckets)), F.lit(NULLS)).cast("int")
    sums = (
        _hashes(df, names).groupBy("column_name", bucket.alias("bucket"))
        .agg(F.min("h").alias("least"), F.count("*").alias("n"))
    )
    # Every row is in one bucket of each column.
    share = F.col("n") / F.sum("n").over(Window.partitionBy("column_name"))
    return sums.select("column_name", "bucket", "least", share.alias("share"))


def _estimates(left: DataFrame, right: DataFrame, lefts: list[str], rights: list[str], buckets: int) -> DataFrame:
    """For pairs that share a bucket: estimated share of common values, and of rows."""
    a, b = (
        column_sketches(df, names, buckets).toDF(side, "bucket", f"{side}_least", f"{side}_share")
        for df, names, side in ((left, lefts, "a"), (right, rights, "b"))
    )
    sizes = [
        s.filter(F.col("bucket") != NULLS).groupBy(side).agg(F.count("*").alias(f"{side}_buckets"))
        for s, side in ((a, "a"), (b, "b"))
    ]
    met = a.join(b, "bucket").groupBy("a", "b").agg(
        F.count_if(F.col("a_least") == F.col("b_least")).alias("same"),
        F.count_if(F.col("bucket") != NULLS).alias("both"),
        F.sum(F.least("a_share", "b_share")).alias("overlap"),
    )
    total = F.coalesce("a_buckets", F.lit(0)) + F.coalesce("b_buckets", F.lit(0)) - F.col("both")
    alike = F.when(total > 0, F.col("same") / total).otherwise(F.lit(1.0))
    return met.join(sizes[0], "a", "left").join(sizes[1], "b", "left").select("a", "b", alike.alias("alike"), "overlap")


def _exact(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """Similarity of the pairs from the counts of every value.

    Nulls are a value of their own among the rows, and none among the distinct
    values.
    """
    spark = left.sparkSession
    sides = []
    for df, place, side in ((left, 0, "n_a"), (right, 1, "n_b")):
        wanted = spark.createDataFrame([(p[place], i) for i, p in enumerate(pairs)], "column_name string, pair int")
        hashes = _hashes(df, sorted({p[place] for p in pairs})).groupBy("column_name", "h").count()
        other = "n_b" if side == "n_a" else "n_a"
        sides.append(
            hashes.join(F.broadcast(wanted), "column_name").select("pair", "h", F.col("count").alias(side), F.lit(0).cast("bigint").alias(other))
        )
    values = sides[0].unionByName(sides[1]).groupBy("pair", "h").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    rows = [max(df.count(), 1) for df in (left, right)]
    held = F.col("h").isNotNull()
    found = values.groupBy("pair").agg(
        F.count_if(held & (F.col("n_a") > 0) & (F.col("n_b") > 0)).alias("shared"),
        F.count_if(held).alias("all"),
        F.sum(F.least(F.col("n_a") * rows[1], F.col("n_b") * rows[0]).cast("decimal(38,0)")).alias("overlap"),
    )
    result = {}
    for row in found.collect():
        alike = row["shared"] / row["all"] if row["all"] else 1.0
        result[pairs[row["pair"]]] = min(alike, float(row["overlap"]) / (rows[0] * rows[1]))
    return result


def _assigned(found: dict[tuple[str, str], float], places: dict[tuple[str, str], int]) -> dict[str, tuple[str, float]]:
    """Best pairs first; each column is used once, ties go to near places, then names."""
    chosen, used = {}, set()
    for (a, b), similarity in sorted(found.items(), key=lambda item: (-item[1], places[item[0]], item[0])):
        if a not in chosen and b not in used:
            chosen[a] = (b, similarity)
            used.add(b)
    return chosen


def renamed_columns(
    left: DataFrame, right: DataFrame, min_similarity: float = MIN_SIMILARITY, buckets: int = BUCKETS
) -> DataFrame:
    """Columns that one side alone has by name, paired where they hold the same values.

    The similarity of two columns is the smaller of two exact shares: common
    distinct values over all of theirs, and rows that can be matched value by
    value (one less the total variation of the two distributions, nulls
    included). The first tells keys apart, the second columns of few values.
    Pairs below ``min_similarity`` stay unpaired; so do columns of nulls only.
    Types may differ. Returns left_column, left_type, right_column, right_type,
    status (``renamed``, ``only_left``, ``only_right``) and similarity (null if
    unpaired). Without rows on a side nothing is paired.

    Sketches drop pairs whose estimate is more than four standard errors below
    the limit. The driver gets one row per pair of columns, none per value.
    """
    key = name_key(left.sparkSession)
    known_left, known_right = names_by_key(left), names_by_key(right)
    lefts = [n for n in left.columns if key(n) not in known_right]
    rights = [n for n in right.columns if key(n) not in known_left]
    chosen: dict[str, tuple[str, float]] = {}
    if lefts and rights:
        slack = 4 * math.sqrt(0.25 / buckets)
        likely = _estimates(left, right, lefts, rights, buckets).filter(
            (F.col("alike") >= min_similarity - slack) & (F.col("overlap") >= min_similarity - 1e-9)
        )
        pairs = sorted((row["a"], row["b"]) for row in likely.collect())
        if pairs:
            exact = {p: s for p, s in _exact(left, right, pairs).items() if s >= min_similarity}
            places = {(a, b): abs(left.columns.index(a) - right.columns.index(b)) for a, b in exact}
            nulls = _all_null(left, [a for a, _ in exact]) if exact else set()
            chosen = _assigned({p: s for p, s in exact.items() if p[0] not in nulls}, places)

    def kind(df: DataFrame, name: str) -> str:
        return df.schema[name].dataType.simpleString()

    rows = [(a, kind(left, a), b, kind(right, b), RENAMED, s) for a, (b, s) in chosen.items()]
    rows += [(a, kind(left, a), None, None, ONLY_LEFT, None) for a in lefts if a not in chosen]
    taken = {b for b, _ in chosen.values()}
    rows += [(None, None, b, kind(right, b), ONLY_RIGHT, None) for b in rights if b not in taken]
    return left.sparkSession.createDataFrame(
        sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[2] or "")),
        "left_column string, left_type string, right_column string, right_type string, status string, similarity double",
    )


def _all_null(df: DataFrame, names: list[str]) -> set[str]:
    names = sorted(set(names))
    counts = df.agg(*[F.count(column(n)).alias(f"c{i}") for i, n in enumerate(names)]).first()
    return {n for i, n in enumerate(names) if counts[f"c{i}"] == 0}


def apply_renames(left: DataFrame, renames: DataFrame) -> DataFrame:
    """``left`` under the names that :func:`renamed_columns` found on the right."""
    new = {r["left_column"]: r["right_column"] for r in renames.filter(F.col("status") == RENAMED).collect()}
    return left.select(*[column(n).alias(new.get(n, n)) for n in left.columns])
