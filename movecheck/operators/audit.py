"""Which tables failed to load, from a log of task runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.functions.names import column, resolve

# The messages of a load report.
FAILED_MESSAGE = "The following tables failed to load: "
FAILED_COUNT = " tables failed to load."
LOADED_MESSAGE = "All tables loaded successfully."


def failure_summary(
    runs: DataFrame, table: str = "table", status: str = "status", failed: str = "failed"
) -> DataFrame:
    """One row per table with at least one failed run, and how many failed.

    All runs of a table count, whichever task they belong to.
    """
    table, status = resolve(runs, [table, status])
    return (
        runs.filter((column(status) == failed) & column(table).isNotNull())
        .groupBy(column(table).alias("table_name"))
        .agg(F.count(F.lit(1)).alias("n_failures"))
    )


def failure_message(
    runs: DataFrame, table: str = "table", status: str = "status", failed: str = "failed"
) -> DataFrame:
    """A message for every failed table, and a closing one.

    The closing message has the number of failed tables, or says that all
    loaded. Nothing is gathered into one row, so tables may be many.
    """
    summary = failure_summary(runs, table, status, failed)
    named = summary.select(F.concat(F.lit(FAILED_MESSAGE), F.col("table_name").cast("string")).alias("message"))
    n = F.count(F.lit(1))
    closing = F.when(n > 0, F.concat(n.cast("string"), F.lit(FAILED_COUNT))).otherwise(F.lit(LOADED_MESSAGE))
    return named.unionByName(summary.agg(closing.alias("message")))
