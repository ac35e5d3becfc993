"""A key for every row of a written table, beside whatever ids it carries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movecheck.sources.sinks import saved

ROW_BITS = 40


def free_name(docs: DataFrame, wanted: str) -> str:
    """The name, with as many underscores before it as no column of docs needs."""
    taken = {name.lower() for name in docs.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number of its own for every row, nulls and copies too, and that column's name.

    The number is made of that of the file, in the order of names, and the place
    in it, so that every reading gives the same; splits of files do not matter.
    A frame that is not read from files is written to scratch space first. The
    names of files are numbered by one task, which sees one row per file, and
    Spark's own check of their size decides whether they are broadcast.
    """
    try:
        paths = docs.select("_metadata.file_path", "_metadata.row_index").select("file_path")
    except AnalysisException:
        docs = saved(docs, "rows")
        paths = docs.select("_metadata.file_path")
    name, path, at, file = (free_name(docs, wanted) for wanted in ("_row", "_row_path", "_row_at", "_row_file"))
    numbers = F.row_number().over(Window.orderBy("file_path")).cast("long").alias(file)
    files = saved(paths.distinct().select(F.col("file_path").alias(path), numbers), "files")
    placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
    number = F.shiftleft(file, ROW_BITS).bitwiseOR(F.col(at)).alias(name)
    return placed.join(files, path).select(*[F.col(f"`{c}`") for c in docs.columns], number), name
