"""Mixing with names left out by a weight of 0."""

from __future__ import annotations

from pyspark.sql import functions as F

from movecheck.llm import mixing


def test_others_take_what_a_zero_weight_leaves(spark):
    rows = [("a", "en", "s", 10), ("a", "de", "s", 90), ("b", "en", "s", 100), ("b", "en", "t", 100)]
    supplies = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    weights = {"lang": {"de": 0}, "source": {"t": 0}}
    plan = mixing.leaf_budgets(supplies, weights, F.lit(100), 1).collect()
    # 10 tokens are open in a; b makes up for the rest.
    assert {(r["domain"], r["lang"], r["source"]): r["given"] for r in plan} == {("a", "en", "s"): 10, ("b", "en", "s"): 90}
