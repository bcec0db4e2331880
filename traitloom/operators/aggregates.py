"""Distinct rows, ordered text collapse, means and counts per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitloom.operators.columns import keep, ref

PART = "__part"
TEXT = "__text"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Duplicates are removed before the shuffle too, so a large group of copies stays cheap."""
    return df.distinct()


def unique_projected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct over some columns; the others are not even read."""
    return keep(df, names).distinct()


def collapse_parts(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str] = (), sep: str = "; "
) -> DataFrame:
    """The text of every group in consecutive pieces: keys, piece number, piece. For groups too large for one cell.

    Rows are range-partitioned by key *and* order, so a group with very many values is spread over tasks in order and
    no task sorts or holds the whole of it. Within a partition a group is a run of rows, and partition numbers rise
    with the order, so the pieces in line are the text. The range bounds are sampled by another pass over the input.
    """
    order = list(order_by) or [value]
    ordered = [ref(name).alias(f"__o{i}") for i, name in enumerate(order)]
    text = F.coalesce(ref(value).cast("string"), F.lit("NA")).alias("v")
    return (
        df.select(*[ref(k) for k in keys], *ordered, text)
        .repartitionByRange(*[ref(k) for k in keys], *[F.col(f"__o{i}") for i in range(len(order))])
        .withColumn(PART, F.spark_partition_id())
        .groupBy(*[ref(k) for k in keys], PART)
        .agg(F.sort_array(F.collect_list(F.struct(*[f"__o{i}" for i in range(len(order))], "v"))).alias("__run"))
        .withColumn(TEXT, F.array_join(F.transform("__run", lambda x: x["v"]), sep))
        .drop("__run")
    )


def collapse_entries(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str] = (), distinct: bool = False
) -> DataFrame:
    """``keys``, the order and text of every different entry as ``__entry``, and how often it occurs as ``__n``.

    Equal entries are counted on both sides of one shuffle by key *and* entry, so neither a group with very many values nor
    one value that occurs very often lands in one task. With ``distinct`` every entry counts once.
    """
    # A string in its own order needs no order beside it.
    plain = not order_by and df.schema[value].dataType.simpleString() == "string"
    order = [] if plain else [ref(name).alias(f"__o{i}") for i, name in enumerate(list(order_by) or [value])]
    rows = df.select(*[ref(k) for k in keys], *order, ref(value).cast("string").alias("__v"))
    parts = rows.columns[len(keys) :]
    grouped = rows.groupBy(*[ref(k) for k in keys], *parts)
    counted = grouped.agg(F.lit(1).alias("__n")) if distinct else grouped.agg(F.count(F.lit(1)).cast("int").alias("__n"))
    return counted.select(*[ref(k) for k in keys], F.struct(*parts).alias("__entry"), "__n")


def join_entries(entries: Column, distinct: bool = False, sep: str = "; ") -> Column:
    """A list of ``struct(__entry, __n)`` in order and joined; a missing text shows as ``NA``."""

    def text(x: Column) -> Column:
        return F.coalesce(x["__entry"]["__v"], F.lit("NA"))

    line = F.sort_array(entries)
    if distinct:
        return F.array_join(F.transform(line, text), sep)
    return F.array_join(F.flatten(F.transform(line, lambda x: F.array_repeat(text(x), x["__n"]))), sep)


def collapse_text(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order_by: Sequence[str] = (),
    sep: str = "; ",
    name: str = "value_entry",
) -> DataFrame:
    """One string per group, values in the given order (by the value itself when none is given).

    Nothing is deduplicated or cut; a missing value shows as ``NA``. Two shuffles and one read of the input. The result of a
    group is one cell, which Spark limits to 2 GB; ``collapse_parts`` gives larger groups in pieces.
    """
    entries = collapse_entries(df, keys, value, order_by)
    line = join_entries(F.collect_list(F.struct("__entry", "__n")), sep=sep)
    return entries.groupBy(*[ref(k) for k in keys]).agg(line.alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "value_entry") -> DataFrame:
    """Mean per group over the values that are present, NULL when none is."""
    return df.groupBy(*[ref(k) for k in keys]).agg(F.avg(ref(value)).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per group; a missing key is a group of its own."""
    return df.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))
