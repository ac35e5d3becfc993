"""The corpus pipeline: filter twice, deduplicate, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. Stages decide on rows, by a
number that each gives to those of its input: rows without a doc_id and rows that
share one get a verdict each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movecheck.llm import gam
from movecheck.llm.byte_bpe import round_trip
from movecheck.llm.mixing import mix_sources
from movecheck.llm.quality_rules import quality_rules
from movecheck.llm.queries import WEIGHTS, with_domain
from movecheck.llm.rows import numbered
from movecheck.llm.simhash import one_of_each
from movecheck.sources.sinks import saved

#: Part of the tokens that the mix keeps, and the tokenizer of the last stage.
MIXED = 0.9
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _only(rows: DataFrame, row: str, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The numbered rows that kept names, without their numbers.

    Always a merge join, so that the plan does not change with the size.
    """
    return rows.join(saved(kept.select(row), "kept").hint("merge"), row, "left_semi").select(*columns)


def _by_row(rows: DataFrame, row: str) -> DataFrame:
    """The columns that operators read, with the row's number as doc_id, which they only carry."""
    return rows.select(F.col(row).alias("doc_id"), *[c for c in ("text", "lang", "source") if c in rows.columns])


def filter_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no robust outliers."""
    rows, row = numbered(docs)
    kept = quality_rules(_by_row(rows, row)).filter("kept")
    return _only(rows, row, kept.withColumnRenamed("doc_id", row), docs.columns)


def filter_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, predicts as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, row = numbered(docs)
    # Labels go by doc_id, verdicts by row.
    kept = gam.score(_by_row(rows, row), gam.train(docs, labels)).filter("predicted = 1")
    return _only(rows, row, kept.withColumnRenamed("doc_id", row), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 3-word shingles are within two bits."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, whole, and each once.

    Without further epochs a short source stays short, and its siblings, then
    its language's siblings, make up for it.
    """
    rows, row = numbered(docs)
    chosen = mix_sources(with_domain(_by_row(rows, row)), WEIGHTS, F.col("total") * MIXED, max_epochs=1, seed=1)
    return _only(rows, row, chosen.withColumnRenamed("doc_id", row), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", filter_by_rules),
    ("quality classifier", filter_by_classifier),
    ("simhash near-dedup", drop_near_duplicates),
    ("mix sources", mix),
    ("byte-level bpe", encode),
]

#: Estimates, models and ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table.

    Null and empty texts fall to the rules. Rows without a doc_id, or sharing one,
    are judged one by one; of near copies the row with the smallest doc_id stays.
    Columns beyond those of documents, whatever
    their names, come along up to the last stage. An empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
