"""Exact duplicates by content, combined in steps that no hot group can overfill.

Two texts are equal when they are identical without white space. The bare texts
are grouped three times, each time by the digest *and the whole content*, so a
digest that two contents share never merges them:

1. locally: every task keeps one row per content of its part (the map side of
   Spark's aggregation), however many copies it reads;
2. by digest and salt, the salt being the task a row was read by: a text that a
   third of all rows repeat is spread over ``SALTS`` groups;
3. by digest: at most one winner per salt is left of any content.

A winner is one number, made of the length and the id, so that aggregation stays
in fixed-width buffers. Contents end there: documents learn their group from a
narrow table of digests. Digests that several contents share are the exception:
their documents, and no others, are matched to their group by content again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movecheck.sources.sinks import saved

# The six white-space characters that do not count.
SPACES = " \t\n\x0b\x0c\r"
SALTS = 64
# A group is hot from so many rows on, and if it holds more than one in so many.
HOT_FROM = 1000
HOT_GROUPS = 10_000
# Ranks are length * ID_SPAN + place of the id; place 0 is that of a null id.
ID_SPAN = 1 << 65


def bare_text(text: Column) -> Column:
    """The text without white space; a null text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def rank_of(n_chars: Column, doc_id: Column) -> Column:
    """Larger for the longer text, then for the smaller id; null ids come last."""
    span = F.lit(str(ID_SPAN)).cast("decimal(20,0)")
    top = F.lit(str(1 << 63)).cast("decimal(20,0)")
    place = F.coalesce(top - doc_id.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (n_chars.cast("decimal(10,0)") * span + place).cast("decimal(38,0)")


def id_of(rank: Column) -> Column:
    """The id that a rank was made of."""
    span = F.lit(str(ID_SPAN)).cast("decimal(20,0)")
    place = rank % span
    return F.when(place != 0, (F.lit(str(1 << 63)).cast("decimal(20,0)") - place).cast("long"))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, content, best, group_size: one row per content.

    ``rows`` holds digest, content and rank.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    salted = rows.select("digest", "content", "rank", salt).groupBy("digest", "salt", "content").agg(
        F.max("rank").alias("best"), F.count("*").alias("n")
    )
    return salted.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))


def with_winner(members: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """The members with best and group_size of their digest's only group.

    Groups of over one ``HOT_GROUPS``-th of all rows are at most ``HOT_GROUPS``,
    which bounds what is broadcast at every size; no group left is larger.
    """
    hot_from = max(HOT_FROM, n_rows // HOT_GROUPS)
    hot = groups.filter(F.col("group_size") > hot_from)
    rest = groups.filter(F.col("group_size") <= hot_from)
    spread = members.join(F.broadcast(hot), "digest")
    others = members.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(rest, "digest")
    return spread.unionByName(others)


def exact_duplicates(
    docs: DataFrame,
    digest: Callable[[Column], Column] = F.xxhash64,
    salts: int = SALTS,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, for every row of docs.

    Of equal texts the row with the most code points stays, then that with the
    smallest doc_id. A row without a doc_id stays, with keep_id null, only if no
    row of its length has one. Of rows that repeat the winner in length and id
    exactly one stays. Null and empty texts are one group, together with texts of
    white space alone. ``digest`` may be any function to a long: collisions cost
    time, not correctness. An empty table gives no rows. Only doc_id and text
    are read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", bare_text(F.col("text")).alias("content"), rank_of(F.char_length("text"), F.col("doc_id")).alias("rank"),
    ).withColumn("digest", digest(F.col("content")).cast("long"))
    sha = F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256")
    row = F.monotonically_increasing_id().alias("row")

    members = saved(own.select("doc_id", "rank", "digest", sha, row), "members")
    groups = saved(winners(own, salts).select("digest", "best", "group_size"), "winners")
    n_rows = groups.agg(F.sum("group_size")).first()[0] or 0
    clashing = saved(groups.groupBy("digest").count().filter("count > 1").select("digest"), "clashing")
    decided = with_winner(
        members.join(clashing, "digest", "left_anti"), groups.join(clashing, "digest", "left_anti"), n_rows
    ).withColumn("clash", F.lit(None).cast("string"))
    if not clashing.isEmpty():
        # Digests that several contents share: the contents decide.
        again = saved(own.join(clashing, "digest", "left_semi").select("*", sha, row), "clashes")
        own_groups = winners(again, salts)
        by_content = again.join(own_groups, ["digest", "content"]).drop("content")
        decided = decided.unionByName(by_content.withColumn("clash", F.col("text_sha256")))
    decided = saved(decided, "decided")

    best = F.col("rank") == F.col("best")
    same_group = F.col("digest").eqNullSafe(F.col("tied_digest")) & F.col("clash").eqNullSafe(F.col("tied_clash"))
    tied = (
        decided.filter(best).groupBy("digest", "clash").agg(F.min("row").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("digest").alias("tied_digest"), F.col("clash").alias("tied_clash"), "first")
    )
    return decided.join(saved(tied, "ties"), same_group, "left").select(
        "doc_id", id_of(F.col("best")).alias("keep_id"), "group_size",
        (best & (F.col("first").isNull() | (F.col("row") == F.col("first")))).alias("kept"), "text_sha256",
    )
