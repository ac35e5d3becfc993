"""Column lookup by name, following the session's case rule."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A top-level column, even if its name holds dots or spaces."""
    return F.col(quoted(name))


def name_key(spark: SparkSession) -> Callable[[str], str]:
    """The function that makes two names equal iff the session treats them so."""
    if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return lambda name: name
    return lambda name: name.lower()


def names_by_key(df: DataFrame) -> dict[str, str]:
    key = name_key(df.sparkSession)
    return {key(name): name for name in df.columns}


def resolve(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The frame's own spelling of ``names``; unknown names raise."""
    key, known = name_key(df.sparkSession), names_by_key(df)
    names = list(names)
    unknown = [name for name in names if key(name) not in known]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    return [known[key(name)] for name in names]
