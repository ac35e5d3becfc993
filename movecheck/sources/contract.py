"""Column contracts: one row per column of a table that is to be moved.

A contract is metadata, so it is read with Spark but held on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movecheck.functions.names import column
from movecheck.functions.types import contract_type

# The attributes of a contract row that are read.
SOURCE_NAME = "src_column_name"
TARGET_NAME = "target_column_name"
TYPE_TEXT = "source_datatype"
NULLABLE = "isnullable"
PRESENT = "iscolpresentindata"
REQUIRED = "isrequired"

_OVERFLOW = "__overflow"


def _text(value: object) -> str:
    return "" if value is None else str(value).strip()


@dataclass(frozen=True)
class ContractColumn:
    source: str
    target: str
    dtype: T.DataType
    nullable: bool
    present: bool = True
    required: bool = False


@dataclass(frozen=True)
class Contract:
    columns: tuple[ContractColumn, ...]

    @property
    def schema(self) -> T.StructType:
        """The schema the contract describes, under the target names."""
        return T.StructType(
            [T.StructField(c.target, c.dtype, c.nullable) for c in self.columns]
        )

    @property
    def source_schema(self) -> T.StructType:
        """The same under the source names."""
        return T.StructType(
            [T.StructField(c.source, c.dtype, c.nullable) for c in self.columns]
        )

    @classmethod
    def from_rows(
        cls, rows: Iterable[Mapping[str, object]], strict: bool = False
    ) -> "Contract":
        """Build a contract from attribute mappings; attribute names ignore case.

        A column is nullable only if its flag reads ``true``, and required
        likewise. Target name, presence and requirement are optional and default
        to the source name, ``true`` and ``false``.
        """
        columns = []
        for raw in rows:
            row = {str(name).lower(): value for name, value in raw.items()}
            absent = [n for n in (SOURCE_NAME, TYPE_TEXT, NULLABLE) if n not in row]
            if absent:
                raise ValueError(f"contract lacks {', '.join(absent)}")
            source = _text(row[SOURCE_NAME])
            if not source:
                raise ValueError("contract row without a column name")
            columns.append(
                ContractColumn(
                    source=source,
                    target=_text(row.get(TARGET_NAME)) or source,
                    dtype=contract_type(row[TYPE_TEXT], strict),
                    nullable=_text(row[NULLABLE]).lower() == "true",
                    present=(_text(row.get(PRESENT)) or "true").lower() == "true",
                    required=_text(row.get(REQUIRED)).lower() == "true",
                )
            )
        for kind in ("source", "target"):
            names = [getattr(c, kind).lower() for c in columns]
            twice = sorted({n for n in names if names.count(n) > 1})
            if twice:
                raise ValueError(f"contract names {kind} column twice: {', '.join(twice)}")
        if not columns:
            raise ValueError("contract without columns")
        return cls(tuple(columns))


def read_contract(
    spark: SparkSession,
    path: str,
    sep: str = "|",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """The rows of a delimited contract file with a header, all as text.

    Rows keep the file's order, which is the column order of positional files.

    Lines with too many fields are dropped; short lines keep nulls at the end.
    Spark's own malformed-line mode would drop both kinds, so one extra column
    is read behind the header's and must stay empty.
    """
    reader = spark.read.options(sep=sep, encoding=encoding, header=True)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _OVERFLOW]])
    lines = reader.schema(schema).option("mode", "PERMISSIVE").csv(path)
    return lines.filter(F.col(_OVERFLOW).isNull()).select(
        *[column(name).alias(name.strip()) for name in names]
    )


def as_contract(contract: Contract | DataFrame, strict: bool = False) -> Contract:
    """Accept a contract, or a frame of contract rows (one row per column)."""
    if isinstance(contract, Contract):
        return contract
    given = {name.strip().lower(): name for name in contract.columns}
    absent = [n for n in (SOURCE_NAME, TYPE_TEXT, NULLABLE) if n not in given]
    if absent:
        raise ValueError(f"contract lacks {', '.join(absent)}")
    attributes = (SOURCE_NAME, TARGET_NAME, TYPE_TEXT, NULLABLE, PRESENT, REQUIRED)
    rows = contract.select(*[column(given[n]).alias(n) for n in attributes if n in given])
    return Contract.from_rows([row.asDict() for row in rows.collect()], strict)


def load_contract(spark: SparkSession, path: str, strict: bool = False, **options) -> Contract:
    """Read a contract file and hold it."""
    return as_contract(read_contract(spark, path, **options), strict)
