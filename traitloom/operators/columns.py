"""Choosing, naming and ordering columns.

Spark's ``drop`` and ``withColumnsRenamed`` ignore names that do not exist. A misspelt column must not pass silently in a
harmonisation job, so every helper here checks its names first. All of them end in a single bare projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col(quoted(name))


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Columns in the given order. Passed as text: building a ``Column`` per name is slow for wide tables."""
    return df.selectExpr(*[quoted(name) for name in names])


def require(df: DataFrame, names: Iterable[str]) -> None:
    known = df.columns
    missing = [name for name in dict.fromkeys(names) if name not in known]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}; the table has {', '.join(known)}")


def keep(df: DataFrame, names: Sequence[str]) -> DataFrame:
    require(df, names)
    return project(df, names)


def drop_strict(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove columns; an unknown name is an error, naming one twice is not."""
    require(df, names)
    gone = set(names)
    return project(df, [name for name in df.columns if name not in gone])


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove every column whose name starts with the prefix, upper or lower case."""
    return project(df, [name for name in df.columns if not name.lower().startswith(prefix.lower())])


def rename_strict(df: DataFrame, new_names: Mapping[str, str]) -> DataFrame:
    """Rename by ``{old: new}``; unknown old names and clashing results are errors."""
    require(df, new_names)
    result = [new_names.get(name, name) for name in df.columns]
    if len(set(result)) != len(result):
        raise ValueError(f"renaming would repeat a column name: {result}")
    return df.toDF(*result)


def prefix_names(
    df: DataFrame, prefix: str, key: str = "species", fixes: Mapping[str, str] | None = None
) -> DataFrame:
    """Put a prefix on every column but the key, after correcting the names listed in ``fixes``."""
    require(df, [key])
    fixes = fixes or {}
    return rename_strict(df, {name: prefix + fixes.get(name, name) for name in df.columns if name != key})


def _place(names: list[str], name: str, before: str | None, after: str | None) -> list[str]:
    rest = [n for n in names if n != name]
    if before is None and after is None:
        return [name, *rest]
    anchor = before if before is not None else after
    if anchor not in rest:
        raise ValueError(f"no such column: {anchor}")
    at = rest.index(anchor) + (0 if before is not None else 1)
    return [*rest[:at], name, *rest[at:]]


def insert_at(
    df: DataFrame, name: str, value: Column, *, before: str | None = None, after: str | None = None
) -> DataFrame:
    """Add a column next to another one, or in front when no anchor is given.

    A column that already exists is replaced and moved.
    """
    order = _place(list(df.columns), name, before, after)
    return project(df.withColumn(name, value), order)


def relocate(df: DataFrame, moves: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply ``(column, put it after this one)`` moves one after another, as one projection."""
    require(df, [name for name, _ in moves])
    order = list(df.columns)
    for name, after in moves:
        order = _place(order, name, None, after)
    return project(df, order)
