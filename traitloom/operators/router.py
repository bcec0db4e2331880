"""Rows sent to named branches: tagged once, written once, read back branch by branch."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.functions.numeric import is_number
from traitloom.operators.columns import ref


def tag_rows(df: DataFrame, branches: Mapping[str, Column], otherwise: str, tag: str = "branch") -> DataFrame:
    """The rows with the name of the first branch whose condition holds. Each condition is evaluated once for a row."""
    name = F.lit(otherwise)
    for branch, condition in reversed(branches.items()):
        name = F.when(condition, branch).otherwise(name)
    return df.withColumn(tag, name)


def tag_numeric(df: DataFrame, column: str, tag: str = "branch") -> DataFrame:
    """Rows whose text is a number are ``number``, all others ``text``; a missing value is text."""
    return tag_rows(df, {"number": is_number(ref(column))}, "text", tag)


@contextmanager
def _open_together(spark: SparkSession, files: int) -> Iterator[None]:
    """A task keeps a file open for each branch instead of sorting its rows by branch first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_branches(tagged: DataFrame, path: str, branches: tuple[str, ...], tag: str = "branch") -> dict[str, DataFrame]:
    """All branches written in one pass over the rows, a folder each; the rows of each branch as a DataFrame.

    Rows with another tag stay in the folder under their own name. A branch without rows is an empty DataFrame.
    """
    with _open_together(tagged.sparkSession, len(branches) + 2):
        tagged.write.mode("overwrite").partitionBy(tag).parquet(path)
    # The tag is the folder's name: a filter on it reads that folder only.
    whole = tagged.sparkSession.read.schema(tagged.schema).parquet(path)
    return {branch: whole.filter(ref(tag) == branch).drop(tag) for branch in branches}
