"""Wide and long forms. Wide column lists are always given, so no job runs just to find the names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitloom.operators.aggregates import collapse_entries, join_entries
from traitloom.operators.columns import prefix_names, ref
from traitloom.operators.filters import drop_in


#: Column for the names outside the list, with ``unlisted="map"``.
OTHER = "other"


def _refuse(wide: DataFrame, key: str, columns: Sequence[str], unlisted: str, repeated: bool = False) -> DataFrame:
    """The key and the columns; an error, when the rows are read, if a name is not listed or a cell has several entries."""
    if unlisted not in ("error", "drop", "map"):
        raise ValueError(f"unlisted: {unlisted!r} is neither 'error' nor 'drop' nor 'map'")
    if unlisted == "map" and OTHER in (key, *columns):
        raise ValueError(f"{OTHER!r} is a column already: the names outside the list have no place")
    # The check sits in a column that is read, so that column pruning cannot leave it out.
    checked: Column = ref(key)
    if unlisted == "error":
        message = F.concat(F.lit("names without a column, for example "), F.col("__unlisted"))
        checked = F.when(F.col("__unlisted").isNotNull(), F.raise_error(message)).otherwise(checked)
    if repeated:
        message = F.lit("several entries for one key and name")
        checked = F.when(F.col("__most") > 1, F.raise_error(message)).otherwise(checked)
    return wide.select(checked.alias(key), *[ref(name) for name in columns], *([OTHER] if unlisted == "map" else []))


def _others(name: Column, columns: Sequence[str], entry: Column) -> Column:
    """What the rows with unlisted names hold, as a list; empty where there are none."""
    return F.collect_list(F.when(~name.isin(list(columns)), entry))


def _unlisted(name: Column, columns: Sequence[str]) -> Column:
    return F.min(F.when(~name.isin(list(columns)), name)).alias("__unlisted")


def pivot_wider(
    df: DataFrame, key: str, names_from: str, values_from: str, columns: Sequence[str], unlisted: str = "error"
) -> DataFrame:
    """One row per key, one column per listed name, NULL where there is no entry.

    A missing name counts as the name ``NA``. Two entries for one key and listed name are an error, and so are names outside
    the list unless ``unlisted`` is ``"drop"``. With ``"map"`` they go, by the same shuffle, to a column ``other``: a map from
    name to value, empty where there are none; two entries for one of them are an error as well.
    """
    name = F.col("__name")
    named = df.select(ref(key), F.coalesce(ref(names_from), F.lit("NA")).alias("__name"), ref(values_from).alias("__value"))
    cells = [F.max(F.when(name == c, F.col("__value"))).alias(c) for c in columns]
    counts = [F.count_if(name == c) for c in columns]
    most = F.greatest(F.lit(0), F.lit(0), *counts).alias("__most")
    if unlisted == "map":
        entries = _others(name, columns, F.struct("__name", "__value"))
        repeats = F.size(F.array_distinct(F.transform(entries, lambda e: e["__name"]))) < F.size(entries)
        cells.append(F.when(repeats, F.raise_error(F.lit("several entries for one key and name"))).otherwise(F.map_from_entries(entries)).alias(OTHER))
    wide = named.groupBy(ref(key)).agg(*cells, most, _unlisted(name, columns))
    return _refuse(wide, key, columns, unlisted, repeated=True)


def mean_wider(
    df: DataFrame, key: str, names_from: str, value: str, columns: Sequence[str], unlisted: str = "error"
) -> DataFrame:
    """Mean per key and name, straight into the wide form.

    Same result as grouping by key and name and pivoting, with one shuffle instead of two. Sums and counts are combined
    before the shuffle, so a key with a large share of the rows sends one row per task. A missing name counts as ``NA``;
    names outside the list are an error unless ``unlisted`` is ``"drop"``. With ``"map"`` a column ``other`` holds their
    means by name; the names are not known beforehand, so the means are taken by key and name first, in one shuffle more.
    """
    name = F.coalesce(ref(names_from), F.lit("NA"))
    if unlisted == "map":
        means = df.groupBy(ref(key), name.alias("__name")).agg(F.avg(ref(value)).alias("__value"))
        return pivot_wider(means, key, "__name", "__value", columns, unlisted)
    cells = [F.avg(F.when(name == c, ref(value))).alias(c) for c in columns]
    return _refuse(df.groupBy(ref(key)).agg(*cells, _unlisted(name, columns)), key, columns, unlisted)


def collapse_wider(
    df: DataFrame,
    key: str,
    names_from: str,
    value: str,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
    sep: str = "; ",
    unlisted: str = "error",
    distinct: bool = False,
) -> DataFrame:
    """Text collapse per key and name, straight into the wide form, in two shuffles. With ``distinct`` equal entries count once.

    A missing name counts as ``NA``; names outside the list are an error unless ``unlisted`` is ``"drop"``. With ``"map"`` a
    column ``other`` holds their collapsed texts by name, made of the same two shuffles.
    """
    name = F.coalesce(ref(names_from), F.lit("NA"))
    entries = collapse_entries(df, [key, names_from], value, order_by, distinct)
    pieces = [F.collect_list(F.when(name == c, F.struct("__entry", "__n"))).alias(c) for c in columns]
    if unlisted == "map":
        pieces.append(_others(name, columns, F.struct(name.alias("name"), "__entry", "__n")).alias(OTHER))
    listed = entries.groupBy(ref(key)).agg(*pieces, _unlisted(name, columns))
    cells = [F.when(F.size(ref(c)) > 0, join_entries(ref(c), distinct, sep)).alias(c) for c in columns]
    if unlisted == "map":
        names = F.array_distinct(F.transform(OTHER, lambda e: e["name"]))
        texts = F.transform(names, lambda n: F.struct(n, join_entries(F.filter(OTHER, lambda e: e["name"] == n), distinct, sep)))
        cells.append(F.map_from_entries(texts).alias(OTHER))
    return _refuse(listed.select(ref(key), *cells, "__unlisted"), key, columns, unlisted)


def pivot_longer(
    df: DataFrame, key: str, columns: Sequence[str] | None = None, names_to: str = "columns", values_to: str = "entries"
) -> DataFrame:
    """One row per key and column, empty cells included. Columns of different types are compared as text."""
    columns = list(columns) if columns is not None else [name for name in df.columns if name != key]
    types = {df.schema[name].dataType.simpleString() for name in columns}
    values = [ref(name) if len(types) == 1 else ref(name).cast("string").alias(name) for name in columns]
    return df.select(ref(key), *values).unpivot(
        [ref(key)], [ref(name) for name in columns], names_to, values_to
    )


def relabel_columns(
    df: DataFrame, prefix: str, key: str = "species", drop_keys: Sequence[str] = (), fixes: Mapping[str, str] | None = None
) -> DataFrame:
    """Leave out some keys, correct and prefix the column names.

    Equals going long, editing the names and going wide again, for a table with one row per key; as a filter and a
    projection it needs no shuffle.
    """
    return prefix_names(drop_in(df, key, drop_keys), prefix, key, fixes)


def separate(df: DataFrame, column: str, into: Sequence[str], sep: str = " ") -> DataFrame:
    """Split a text column into named pieces: too few give NULLs on the right, too many stay together in the last.

    The pieces take the place of the source column.
    """
    pieces = F.split(ref(column), re.escape(sep), len(into))
    out = []
    for name in df.columns:
        if name == column:
            out += [F.get(pieces, F.lit(i)).alias(piece) for i, piece in enumerate(into)]
        else:
            out.append(ref(name))
    return df.select(*out)
