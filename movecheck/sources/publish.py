"""Resumable publishing: staged batches of partitions, a record of each, a switch.

A published table is a folder:

* ``plans/run=R``: the partitions of a run, each with its batch, slot and rows,
* ``data/run=R/batch=B/``: the rows of a batch, a folder per slot,
* ``done/run=R/batch=B``: written once the batch's rows were read back and counted,
* ``versions/version=N``: which slot of which run holds each partition.

Records of plans, batches and versions are one file each, and Spark moves a
finished file into place as a whole, so a record is there or is not. Readers take
the newest version, and data without a version is not seen. A run that failed is
started again under the same name: it keeps its plan and goes on with the batches
that have no record. Earlier versions stay readable, as their data is not touched.
One run at a time may publish to a folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve
from movecheck.functions.types import FLOAT_TYPES
from movecheck.sources.sinks import write_table

SLOT = "__slot"
PARTITIONS_PER_BATCH = 64
# Types whose values filter a scan as they are.
PLAIN_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.BooleanType)
# The slot of a version's first entry, which names the run that made it.
HEAD = -1
PLAN = "value string, batch int, slot int, n_rows long"
DONE = "slot int, n_rows long"
VERSION = "value string, run string, batch int, slot int, n_rows long, version int"


class SourceChanged(ValueError):
    """The rows of a partition are not those that the run's plan counted."""


def _record(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows under a path, or None where there is no such path or no row."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if found.isEmpty() else found


def _write_record(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)


def _run_folder(base: str, kind: str, run: str) -> str:
    return f"{base}/{kind}/run={run}"


def _plan(df: DataFrame, base: str, name: str, run: str, per_batch: int) -> DataFrame:
    """The run's partitions as first counted; one row per partition."""
    spark, path = df.sparkSession, _run_folder(base, "plans", run)
    known = _record(spark, path, PLAN)
    if known is None:
        from pyspark.sql import Window

        sizes = df.groupBy(column(name).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
        # One row per partition of the table, so one task can number them.
        slot = F.row_number().over(Window.orderBy("value")) - 1
        plan = sizes.withColumn("slot", slot).select(
            "value", F.floor(F.col("slot") / per_batch).cast("int").alias("batch"), "slot", "n_rows"
        )
        _write_record(plan, path)
        known = spark.read.schema(PLAN).parquet(path)
    return known


def _write_batch(df: DataFrame, name: str, plan: DataFrame, batch: int, folder: str) -> None:
    """The batch's rows, one folder per slot."""
    members = plan.filter(F.col("batch") == batch).select(F.col("value").alias("__value"), F.col("slot").alias(SLOT))
    rows = df
    if isinstance(df.schema[name].dataType, PLAIN_TYPES):
        # At most a batch of values; they reach the scan, the join below does not.
        values = [r["__value"] for r in members.select("__value").collect()]
        kept = column(name).isin([F.lit(v).cast(df.schema[name].dataType) for v in values if v is not None])
        if None in values:
            kept = kept | column(name).isNull()
        rows = df.filter(kept)
    rows = rows.join(F.broadcast(members), column(name).cast("string").eqNullSafe(F.col("__value"))).drop("__value")
    write_table(rows, folder, mode="overwrite", partition_by=SLOT)


def _count_batch(spark: SparkSession, folder: str, plan: DataFrame, batch: int) -> DataFrame:
    """Rows per slot as they stand in the files; they must be those of the plan."""
    written = spark.read.schema(f"{SLOT} int").parquet(folder).groupBy(F.col(SLOT).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    both = plan.filter(F.col("batch") == batch).join(written, "slot", "left")
    wrong = both.filter(F.coalesce("n", F.lit(0)) != F.col("n_rows")).select("value").limit(5).collect()
    if wrong:
        raise SourceChanged(f"partitions differ from the run's plan, start a new run: {[r['value'] for r in wrong]}")
    return both.select("slot", "n_rows")


def _versions(spark: SparkSession, base: str) -> DataFrame:
    found = _record(spark, f"{base}/versions", VERSION)
    return spark.createDataFrame([], VERSION) if found is None else found


def published_versions(spark: SparkSession, target: str) -> DataFrame:
    """Every version's partitions: value (text), run, batch, slot, n_rows, version."""
    return _versions(spark, target.rstrip("/")).filter(F.col("slot") != HEAD)


def publish(
    df: DataFrame,
    target: str,
    partition_by: str,
    run: str,
    per_batch: int = PARTITIONS_PER_BATCH,
    replace_all: bool = False,
    max_batches: int | None = None,
) -> int | None:
    """Publish a frame under ``target`` as the run ``run``; the new version's number.

    Partitions that the frame holds replace those of the last version and the
    others stay, or go with ``replace_all``. Null is a partition of its own, and
    so is the empty text. Floats and nested values cannot partition.

    Batches of ``per_batch`` partitions are written one after the other; each is
    one scan of the partitions concerned. A run that stopped goes on where it was
    if it is called again; a finished run called again changes nothing.
    ``max_batches`` stops after so many batches: None is returned, and readers
    see the last version, until the run is complete. If a partition no longer has
    the rows the plan counted, :class:`SourceChanged` is raised and nothing is
    switched. The driver gets one row per partition of a batch.
    """
    spark, base = df.sparkSession, target.rstrip("/")
    (name,) = resolve(df, [partition_by])
    if isinstance(df.schema[name].dataType, (*FLOAT_TYPES, T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise ValueError(f"cannot partition by {df.schema[name].dataType.simpleString()}")
    if {n.lower() for n in df.columns} & {SLOT, "__value", "run", "batch"}:
        raise ValueError(f"column name in use by the published table: {SLOT}, __value, run or batch")
    if "/" in run or not run:
        raise ValueError("a run needs a name without '/'")
    last = _versions(spark, base)
    newest = last.agg(F.max("version")).first()[0]
    ready = last.filter((F.col("slot") == HEAD) & (F.col("run") == run)).agg(F.min("version")).first()[0]
    if ready is not None:
        return ready

    plan = _plan(df, base, name, run, per_batch)
    batches = [r["batch"] for r in plan.select("batch").distinct().orderBy("batch").collect()]
    written = 0
    for batch in batches:
        record = f"{_run_folder(base, 'done', run)}/batch={batch}"
        if _record(spark, record, DONE) is not None:
            continue
        if max_batches is not None and written >= max_batches:
            return None
        folder = f"{_run_folder(base, 'data', run)}/batch={batch}"
        _write_batch(df, name, plan, batch, folder)
        _write_record(_count_batch(spark, folder, plan, batch), record)
        written += 1

    entries = plan.select("value", F.lit(run).alias("run"), "batch", "slot", "n_rows")
    if newest is not None and not replace_all:
        before = last.filter((F.col("version") == newest) & (F.col("slot") != HEAD))
        renewed = plan.select(F.col("value").alias("__new"))
        others = before.join(renewed, F.col("value").eqNullSafe(F.col("__new")), "left_anti")
        entries = entries.unionAll(others.select(*entries.columns))
    head = spark.createDataFrame([(None, run, HEAD, HEAD, 0)], entries.schema)
    number = 1 if newest is None else newest + 1
    head.unionAll(entries).coalesce(1).write.mode("errorifexists").parquet(f"{base}/versions/version={number}")
    return number


def read_published(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    version: int | None = None,
    values: Sequence[str | None] | None = None,
) -> DataFrame:
    """The rows of the newest (or another) version, under the given schema.

    ``values`` names partitions by their text; folders of others are not read.
    Without a version there are no rows.
    """
    base = target.rstrip("/")
    entries = _versions(spark, base)
    if version is None:
        version = entries.agg(F.max("version")).first()[0]
    entries = entries.filter((F.col("version") == F.lit(version)) & (F.col("slot") != HEAD))
    if values is not None:
        named = F.col("value").isin([v for v in values if v is not None])
        entries = entries.filter(named | F.col("value").isNull() if None in values else named)
    # One folder per batch; the partitions of a batch that a later run renewed are left out.
    folders = [
        f"{_run_folder(base, 'data', r['run'])}/batch={r['batch']}" for r in entries.select("run", "batch").distinct().collect()
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(SLOT, T.IntegerType()), T.StructField("run", T.StringType()),
                         T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", f"{base}/data").parquet(*sorted(folders))
    live = entries.select("run", F.col("slot").alias(SLOT))
    return rows.join(live, ["run", SLOT], "left_semi").select(*[column(f.name) for f in schema.fields])
