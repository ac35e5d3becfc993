"""Table writes: mode, partitioning, clustering."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movecheck.functions.names import column, resolve

MODES = ("append", "overwrite", "errorifexists")

# Option names of the public BigQuery connector, which takes
# partitioning and clustering as options.
CONNECTOR_OPTIONS = {
    "bigquery": {
        "target": "table",
        "partition": "partitionField",
        "cluster": "clusterFields",
        "grain": "partitionType",
        "grains": {"day": "DAY", "month": "MONTH"},
        "defaults": {"createDisposition": "CREATE_IF_NEEDED"},
    },
}
# Text forms of the partition grains.
GRAIN_FORMATS = {"day": "yyyyMMdd", "month": "yyyyMM"}


def connector_options(
    fmt: str,
    target: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str],
    partition_grain: str | None = None,
) -> dict[str, str]:
    names = CONNECTOR_OPTIONS[fmt.lower()]
    if len(partition_by) > 1:
        raise ValueError(f"{fmt} partitions on one column")
    options = {names["target"]: target, **names["defaults"]}
    if partition_by:
        options[names["partition"]] = partition_by[0]
    if partition_grain:
        if not partition_by:
            raise ValueError("partition_grain needs one partition column")
        options[names["grain"]] = names["grains"][partition_grain]
    if cluster_by:
        options[names["cluster"]] = ",".join(cluster_by)
    return options


def with_grain(df: DataFrame, name: str, grain: str) -> tuple[DataFrame, str]:
    """Add the day or month of a date or timestamp column as a partition key."""
    (name,) = resolve(df, [name])
    key = f"{name}_{grain}"
    if key in df.columns:
        raise ValueError(f"column exists: {key}")
    return df.withColumn(key, F.date_format(column(name), GRAIN_FORMATS[grain])), key


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
    partition_grain: str | None = None,
    dynamic: bool = False,
    as_table: bool = False,
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a frame to a path, a catalog table or a connector's table.

    With ``partition_by`` the rows are rebalanced on the partition columns
    first: without that every task would write a file into every partition.
    The rebalance lets Spark cut a hot partition into several tasks by size.
    ``cluster_by`` sorts each file, which costs no shuffle; a catalog table
    without partitions also records the columns. ``dynamic`` replaces only the
    partitions that the frame holds.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if dynamic and mode != "overwrite":
        raise ValueError("dynamic belongs to mode='overwrite'")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    parts, clusters = resolve(df, parts), resolve(df, cluster_by or [])

    if fmt.lower() in CONNECTOR_OPTIONS:
        if dynamic or as_table:
            raise ValueError(f"{fmt} has no counterpart here for dynamic or as_table")
        settings = connector_options(fmt, target, parts, clusters, partition_grain)
        df.write.format(fmt).options(**settings).options(**(options or {})).mode(mode).save()
        return

    if partition_grain:
        if len(parts) != 1:
            raise ValueError("partition_grain needs one partition column")
        df, key = with_grain(df, parts[0], partition_grain)
        parts = [key]
    if parts and rebalance:
        df = df.hint("rebalance", *[column(name) for name in parts])
    if parts or clusters:
        df = df.sortWithinPartitions(*[column(name) for name in [*parts, *clusters]])
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if parts:
        writer = writer.partitionBy(*parts)
    elif clusters and as_table:
        writer = writer.clusterBy(*clusters)
    if as_table and dynamic and df.sparkSession.catalog.tableExists(target):
        # saveAsTable would make the table anew and lose its other partitions;
        # insertInto takes the mode from the session alone.
        spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
        rows = df.select(*[column(name) for name in spark.table(target).columns])
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(target)
        finally:
            spark.conf.set(setting, before)
    elif as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the cluster's shared scratch space.

    The space is ``spark.checkpoint.dir``. Where that is unset, a local master
    gets a folder of this machine and any other master an error, as executors
    could not read each other's files. Folders that results may be read from are
    not removed here: the owner of the scratch space does that, once the frames
    read from them are done with.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="movecheck-")
    return f"{base.rstrip('/')}/movecheck/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, options: Mapping[str, str | int] | None = None) -> DataFrame:
    """The frame written to scratch space and read back: its lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_in_turn(frames: Iterable[DataFrame], label: str) -> tuple[DataFrame, str]:
    """(the rows of all frames, their folder); the frames are written one after the other."""
    path = schema = spark = None
    for df in frames:
        path, schema, spark = path or scratch_path(df.sparkSession, label), df.schema, df.sparkSession
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders of scratch space that no frame in use reads from."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


# Fixed value: Spark's setting for shuffle files that go when their query ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile leave no shuffle files; for those whose results are saved."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
