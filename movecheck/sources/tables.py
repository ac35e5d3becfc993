"""Table scans: files, connector-backed tables, month ranges."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from movecheck.functions.names import column, resolve
from movecheck.functions.types import INTEGRAL_TYPES
from movecheck.operators.conform import conform
from movecheck.operators.months import in_months, month_keys
from movecheck.sources.contract import Contract, as_contract

# Fixed value: how old writers named columns in a file, by position only.
POSITIONAL_NAME = re.compile(r"_col(\d+)", re.IGNORECASE)
MERGING_FORMATS = ("orc", "parquet")


def read_table(
    spark: SparkSession,
    path: str | Sequence[str] | None = None,
    fmt: str = "orc",
    contract: Contract | DataFrame | None = None,
    options: Mapping[str, str] | None = None,
    merge_schema: bool | None = None,
    allow_extra: bool = False,
    infer_partitions: bool = True,
) -> DataFrame:
    """Scan a table, and conform it if a contract is given.

    A scan under a forced schema turns mismatched values into nulls without a
    word, so the physical schema is read and the contract is applied on top.
    Files of one folder may lack columns of others; with a contract their
    schemas are therefore merged (one parallel job over the file footers).
    ``merge_schema=False`` saves that job where all files are alike.

    Several paths under a contract are read, conformed and united one by one,
    so each may have its own physical types. Values in folder names are texts
    until the contract types them, so ``01`` stays ``01`` in a text column;
    without a contract Spark guesses their types, unless ``infer_partitions`` is
    false. Without a path the format's
    connector finds the table from ``options``; ``fmt="table"`` takes the name
    of a catalog table for the path.
    """
    options = dict(options or {})
    if contract is None and fmt.lower() == "table":
        return spark.table(path)
    if contract is None:
        reader = spark.read.format(fmt).options(**options)
        if merge_schema:
            reader = reader.option("mergeSchema", True)
        if path is None:
            return reader.load()
        path = path if isinstance(path, str) else list(path)
        return reader.load(path) if infer_partitions else _with_text_folders(spark, lambda: reader.load(path))

    contract = as_contract(contract)
    paths = [path] if path is None or isinstance(path, str) else list(path)
    parts = [
        conform(read_source(spark, one, fmt, contract, options, merge_schema, allow_extra), contract)
        for one in paths
    ]
    return reduce(DataFrame.unionByName, parts)


def _with_text_folders(spark: SparkSession, load: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``load`` makes, with the values of folder names as texts.

    Only the session holds this setting; folders are listed while it is changed.
    """
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return load()
    finally:
        spark.conf.set(setting, before)


def read_source(
    spark: SparkSession,
    path: str | None,
    fmt: str,
    contract: Contract,
    options: Mapping[str, str] | None = None,
    merge_schema: bool | None = None,
    allow_extra: bool = False,
) -> DataFrame:
    """A table in its physical types, under the contract's source names."""
    if merge_schema is None:
        merge_schema = fmt.lower() in MERGING_FORMATS
    options = dict(options or {})
    physical = read_table(spark, path, fmt, None, options, merge_schema, infer_partitions=False)
    return _name_positions(spark, physical, path, fmt, contract, options, allow_extra)


def _name_positions(
    spark: SparkSession,
    physical: DataFrame,
    path: str | None,
    fmt: str,
    contract: Contract,
    options: Mapping[str, str],
    allow_extra: bool,
) -> DataFrame:
    """Give ``_colN`` columns the contract's names, by position."""
    spots = {}
    for field in physical.schema:
        match = POSITIONAL_NAME.fullmatch(field.name)
        if match:
            spots[int(match[1])] = field
    sources = [c.source for c in contract.columns if c.present]
    if not spots or any(POSITIONAL_NAME.fullmatch(name) for name in sources):
        return physical
    extra = [spots[i].name for i in sorted(spots) if i >= len(sources)]
    if extra and not allow_extra:
        raise ValueError(f"columns beyond the contract: {', '.join(extra)}")

    named = [f for f in physical.schema if not POSITIONAL_NAME.fullmatch(f.name)]
    known = {f.name.lower(): f for f in named}
    overlap = [s for s in sources if s.lower() in known]
    if not overlap:
        renamed = [
            column(spots[i].name).alias(sources[i]) for i in sorted(spots) if i < len(sources)
        ]
        return physical.select(*renamed, *[column(f.name) for f in named])

    # Old and new files share the folder: name the columns in the scan, which
    # then goes by position in old files and by name in new ones.
    if fmt.lower() != "orc":
        raise ValueError("positional and named files can be mixed in ORC folders only")
    if extra:
        raise ValueError(
            f"columns beyond the contract in a mixed folder: {', '.join(extra)}"
        )
    fields = []
    for i, source in enumerate(sources):
        old, new = spots.get(i), known.pop(source.lower(), None)
        if old and new and old.dataType != new.dataType:
            raise ValueError(
                f"{source}: {old.dataType.simpleString()} in positional files, "
                f"{new.dataType.simpleString()} in named ones; read them apart"
            )
        if old or new:
            fields.append(T.StructField(source, (old or new).dataType))
        else:
            fields.append(T.StructField(source, T.NullType()))
    while fields and isinstance(fields[-1].dataType, T.NullType):
        fields.pop()
    holes = [f.name for f in fields if isinstance(f.dataType, T.NullType)]
    if holes:
        raise ValueError(f"no file has a column for {', '.join(holes)}")
    schema = T.StructType([*fields, *known.values()])
    reader = spark.read.format(fmt).options(**options).schema(schema)
    return _with_text_folders(spark, lambda: reader.load(path))


def scan_months(
    df: DataFrame, key: str, first: str, last: str
) -> DataFrame:
    """Rows of the months ``first``..``last`` (``yyyymm``, both included).

    ``key`` is a ``yyyymm`` column, text or number, or a date or timestamp.
    The test is on the stored column itself, so it prunes partitions or is
    pushed to the scan; a numeric key (how Spark infers such folders) is then
    returned as text.
    """
    (key,) = resolve(df, [key])
    dtype = df.schema[key].dataType
    months = month_keys(first, last)
    if isinstance(dtype, T.StringType):
        return df.filter(column(key).isin(months))
    if isinstance(dtype, INTEGRAL_TYPES):
        kept = df.filter(column(key).isin([int(month) for month in months]))
        return kept.withColumn(key, column(key).cast("string"))
    return df.filter(in_months(column(key), dtype, first, last))
