"""Quality rules: base counts, then robust outliers per language and source.

Each text becomes a short vector of transformed counts. For every group (a
source within a language, the language, all rows) the minimum covariance
determinant is sought: the mean and covariance of those ``share`` of the rows
whose covariance has the smallest determinant. Rows far from it, by squared
Mahalanobis distance, are rejected.

The search is run by Spark on all rows. A concentration step joins the current
estimates (one row per group and start) to the vectors, cuts the distances into
fine logarithmic bins, and sums counts, values and products per bin; that
collapses before the shuffle, so a hot group is no burden. The bins up to the
wanted share, the last one weighted, give the next estimate. Two starts are
followed, medians with quartile ranges and plain moments, and the smaller
determinant wins. With each statistic in units of its floor, directions whose
variance is below one are raised to one, as statistics that most rows share (no
symbols, no repeated line) would make the covariance singular; the others stay as
estimated. Distances are scaled, up or down, so that their median is that of a
chi-square with as many degrees of freedom as there are estimated directions, a
raised one counting for the part that was estimated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movecheck.llm.text import text_counts
from movecheck.sources.sinks import saved

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("x_length", "x_symbols", "x_lines", "x_repeats", "x_upper", "x_marks")
# Smallest standard deviation that a statistic is granted, in its own unit. Low
# where rows differ; one repeated line or mark, where most have none, is no outlier.
FLOORS = (0.02, 0.05, 0.12, 0.12, 0.01, 0.10)
SHARE = 0.75
STEPS = 4
MIN_ROWS = 60
TAIL = 1e-6
BINS_PER_OCTAVE = 16


def transformed(c: dict[str, int]) -> list[float]:
    """The statistic vector: a log, and square roots that even out variances."""
    words, chars = max(c["n_words"], 1), max(c["word_chars"], 1)
    return [
        math.log(chars / words),
        math.sqrt(c["n_symbols"] / words),
        math.sqrt(c["n_dup_lines"] / max(c["n_lines"], 1)),
        math.sqrt(c["n_repeat_words"] / words),
        math.sqrt(c["n_upper"] / chars),
        math.sqrt(c["n_marks"] / words),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [text_counts(t.as_py()) for t in batch.column(1)]
        vectors = [transformed(c) for c in counts]
        columns = [batch.column(0), *batch.columns[2:]]
        columns += [pa.array([c[name] for c in counts], pa.int64()) for name in BASE]
        columns += [pa.array([v[i] for v in vectors], pa.float64()) for i in range(len(FEATURES))]
        names = [batch.schema.names[0], *batch.schema.names[2:], *BASE, *FEATURES]
        yield pa.RecordBatch.from_arrays(columns, names)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts, their verdict, and the vector."""
    schema = "doc_id long, lang string, source string, "
    schema += ", ".join(f"{c} long" for c in BASE) + ", "
    schema += ", ".join(f"{c} double" for c in FEATURES)
    picked = docs.select("doc_id", "text", "lang", "source")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return picked.mapInArrow(_measure, schema).withColumn("base_failed", failed)


def _text_key(name: str) -> Column:
    value = F.col(name)
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def group_keys() -> Column:
    """The groups that a row belongs to, finest first."""
    return F.array(
        F.concat(F.lit("source "), _text_key("lang"), F.lit(" "), _text_key("source")),
        F.concat(F.lit("lang "), _text_key("lang")),
        F.lit("all"),
    )


def chi_square(p_upper: float, d: int) -> float:
    """Upper quantile of the chi-square distribution (Wilson and Hilferty)."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(1 - p_upper)
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


def _pairs() -> list[tuple[int, int]]:
    d = len(FEATURES)
    return [(i, j) for i in range(d) for j in range(i, d)]


def distance(center: str = "center", precision: str = "precision") -> Column:
    """Squared Mahalanobis distance of the row's vector."""
    offsets = [F.col(name) - F.col(center)[i] for i, name in enumerate(FEATURES)]
    terms = [
        F.col(precision)[k] * offsets[i] * offsets[j] * F.lit(1.0 if i == j else 2.0)
        for k, (i, j) in enumerate(_pairs())
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


ESTIMATE = "grp string, start int, n double, center array<double>, precision array<double>, logdet double, freedom double"

ESTIMATE_NAMES = [part.split()[0] for part in ESTIMATE.split(", ")]


def _estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean, inverse covariance and log determinant from weighted sums."""
    pairs, d = _pairs(), len(FEATURES)
    unit = np.outer(FLOORS, FLOORS)
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            weight = max(row.w, 1e-300)
            mean = np.array(row.sums) / weight
            cov = np.zeros((d, d))
            for value, (i, j) in zip(row.products, pairs):
                cov[i, j] = cov[j, i] = value / weight - mean[i] * mean[j]
            # In units of the floors, no direction may vary by less than one.
            values, axes = np.linalg.eigh(cov / unit)
            freedom = float(np.clip(values, 0.0, 1.0).sum())
            cov = (axes * np.maximum(values, 1.0)) @ axes.T * unit
            inverse = np.linalg.inv(cov)
            out.append(
                (row.grp, row.start, row.n, mean.tolist(), [inverse[p] for p in pairs],
                 float(np.linalg.slogdet(cov)[1]), max(freedom, 1.0))
            )
        yield pd.DataFrame(out, columns=ESTIMATE_NAMES)


def _solve(sums: DataFrame) -> DataFrame:
    return sums.mapInPandas(_estimates, ESTIMATE)


def _moments() -> list[Column]:
    """Sums of values and products, as separate aggregates (they stay compiled)."""
    first = [F.sum(F.col(x)).alias(f"s{i}") for i, x in enumerate(FEATURES)]
    second = [
        F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{k}")
        for k, (i, j) in enumerate(_pairs())
    ]
    return first + second


def _packed(sums: DataFrame) -> DataFrame:
    d, k = len(FEATURES), len(_pairs())
    return sums.select(
        "grp", "start", "n", "w",
        F.array(*[f"s{i}" for i in range(d)]).alias("sums"),
        F.array(*[f"p{i}" for i in range(k)]).alias("products"),
    )


def _first_estimates(rows: DataFrame) -> DataFrame:
    """Start 0: medians and quartile ranges. Start 1: moments of all rows."""
    plain = rows.groupBy("grp").agg(F.count("*").cast("double").alias("n"), *_moments())
    plain = plain.withColumn("start", F.lit(1)).withColumn("w", F.col("n"))
    quartiles = [
        F.percentile_approx(x, [0.25, 0.5, 0.75], 200).alias(f"q{i}")
        for i, x in enumerate(FEATURES)
    ]
    robust = rows.groupBy("grp").agg(F.count("*").cast("double").alias("n"), *quartiles)
    # Fixed value: quartile range of a standard normal distribution.
    spread = [F.col(f"q{i}")[2] / 1.349 - F.col(f"q{i}")[0] / 1.349 for i in range(len(FEATURES))]
    middle = [F.col(f"q{i}")[1] for i in range(len(FEATURES))]
    # As moments of one row: mean m, second moment s^2 + m^2, products m_i m_j.
    products = [
        middle[i] * middle[j] + (spread[i] * spread[i] if i == j else F.lit(0.0))
        for i, j in _pairs()
    ]
    robust = robust.select(
        "grp", F.lit(0).alias("start"), "n", F.lit(1.0).alias("w"),
        F.array(*middle).alias("sums"), F.array(*products).alias("products"),
    )
    return _solve(robust.unionByName(_packed(plain)))


def _binned(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    far = distance()
    octave = F.floor(F.log2(F.greatest(far, F.lit(1e-6))) * BINS_PER_OCTAVE).cast("int")
    return rows.join(estimates, "grp").withColumn("bin", octave)


def _concentrate(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One concentration step for every group and start."""
    d, k = len(FEATURES), len(_pairs())
    names = [f"s{i}" for i in range(d)] + [f"p{i}" for i in range(k)]
    per_bin = (
        _binned(rows, estimates)
        .groupBy("grp", "start", "bin")
        .agg(F.count("*").cast("double").alias("c"), F.max("n").alias("n"), *_moments())
    )
    from pyspark.sql import Window

    order = Window.partitionBy("grp", "start").orderBy("bin")
    before = F.sum("c").over(order) - F.col("c")
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("n") * share - before) / F.col("c")))
    weighted = per_bin.withColumn("v", weight).groupBy("grp", "start").agg(
        F.max("n").alias("n"), F.sum(F.col("v") * F.col("c")).alias("w"),
        *[F.sum(F.col("v") * F.col(name)).alias(name) for name in names],
    )
    return _solve(_packed(weighted))


def _scales(rows: DataFrame, best: DataFrame) -> DataFrame:
    """For each group, its median squared distance over what a normal has."""
    from pyspark.sql import Window

    per_bin = _binned(rows, best).groupBy("grp", "bin").agg(
        F.count("*").alias("c"), F.max("n").alias("n"), F.max("freedom").alias("freedom")
    )
    upto = F.sum("c").over(Window.partitionBy("grp").orderBy("bin"))
    middle = F.min(F.when(F.col("upto") >= F.col("n") / 2, F.col("bin")))
    # Median of a chi-square, as in :func:`chi_square`.
    normal = F.col("freedom") * F.pow(1 - 2 / (9 * F.col("freedom")), F.lit(3))
    scale = F.pow(F.lit(2.0), (F.col("middle") + 1) / BINS_PER_OCTAVE) / normal
    return (
        per_bin.withColumn("upto", upto).groupBy("grp")
        .agg(middle.alias("middle"), F.max("freedom").alias("freedom"))
        .select("grp", scale.alias("scale"))
    )


def minimum_determinants(vectors: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Per group: n, center, precision, and the scale of its distances."""
    rows = vectors.select(F.explode(group_keys()).alias("grp"), *FEATURES)
    estimates = saved(_first_estimates(rows), "mcd")
    for _ in range(steps):
        estimates = saved(_concentrate(rows, estimates, share), "mcd")
    best = estimates.groupBy("grp").agg(
        F.min_by(F.struct("n", "center", "precision", "freedom"), F.struct("logdet", "start")).alias("e")
    ).select("grp", "e.*")
    best = saved(best, "mcd")
    return best.join(_scales(rows, best), "grp")


def quality_rules(
    docs: DataFrame,
    share: float = SHARE,
    steps: int = STEPS,
    min_rows: int = MIN_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """Base counts and verdicts for every document.

    Returns doc_id, the base counts, base_failed, kept, distance (squared
    Mahalanobis, scaled), and grp, the group whose estimate was used: the
    document's source within its language if ``min_rows`` or more of its rows
    pass the base rules, else its language, else all rows. Estimates are made
    of rows that pass the base rules; if too few rows pass even in all, the
    base rules alone decide. ``tail`` is the upper tail of the chi-square
    distribution at which a distance is too large.

    Null and empty texts have no words and fail the base rules. A null language
    or source is a value of its own. Equal rows each get a result. Only doc_id,
    text, lang and source are read.
    """
    counted = saved(base_counts(docs), "counts")
    fitted = minimum_determinants(counted.filter("not base_failed"), share, steps)
    fitted = saved(fitted.filter(F.col("n") >= min_rows), "mcd")
    names = ["doc_id", "lang", "source", *BASE, "base_failed", *FEATURES]
    judged = counted.withColumn("keys", group_keys())
    for level in range(3):
        own = fitted.select(
            F.col("grp").alias(f"grp{level}"),
            F.struct("grp", "center", "precision", "scale").alias(f"e{level}"),
        )
        judged = judged.withColumn(f"grp{level}", F.col("keys")[level]).join(own, f"grp{level}", "left")
    judged = judged.select(*names, F.coalesce("e0", "e1", "e2").alias("e")).select(*names, "e.*")
    far = distance() / F.col("scale")
    limit = chi_square(tail, len(FEATURES))
    return judged.select(
        "doc_id", *BASE, "base_failed",
        (~F.col("base_failed") & F.coalesce(far <= limit, F.lit(True))).alias("kept"),
        far.alias("distance"), "grp",
    )
