"""Row filters. The positive ones drop missing values, the negated ones keep them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from traitloom.functions.nulls import has_text, not_in
from traitloom.functions.numeric import is_number
from traitloom.operators.columns import ref


def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(ref(column).isin(list(values)))


def drop_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop the listed values; a missing value is not listed and stays."""
    return df.filter(not_in(ref(column), values))


def drop_in_table(df: DataFrame, column: str, table: DataFrame, table_column: str) -> DataFrame:
    """``drop_in`` for a list kept as a table: an anti join, which keeps missing values as well."""
    listed = table.select(ref(table_column).alias("__listed"))
    return df.join(listed, ref(column) == listed["__listed"], "left_anti")


def keep_nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_text(ref(column)))


def drop_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Drop one value; missing values go with it."""
    return df.filter(ref(column) != value)


def keep_flagged(df: DataFrame, column: str) -> DataFrame:
    return df.filter(ref(column) == 1)


def split_numeric(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``(text rows, number rows)``. Every row lands in exactly one of the two.

    Two filters over the same rows: for both branches from one scan see ``router.tag_numeric``.
    """
    number = is_number(ref(column))
    return df.filter(~number), df.filter(number)
