"""Value recodes driven by small mappings. Mappings that grow with the data belong in a table: see ``recode_from_table``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitloom.functions.nulls import if_else, is_in

MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def lookup(column: Column, mapping: Mapping[str, str | float]) -> Column:
    """The mapped value, NULL for anything not in the mapping.

    A constant map, not a chain of CASE arms: the generated code stays the same size however many entries there are.
    Long chains push the method past the size the JVM is willing to compile, and the whole stage then runs interpreted.
    """
    if not mapping:
        return F.lit(None)
    return F.create_map(*[F.lit(part) for item in mapping.items() for part in item])[column]


def recode(column: Column, mapping: Mapping[str, str]) -> Column:
    """Replace exact values, keep everything else."""
    if not mapping:
        return column
    return F.coalesce(lookup(column, mapping), column)


def decode_month(
    value: Column, unit: Column, fixes: Mapping[str, str] | None = None, month_unit: str = "month"
) -> Column:
    """``1`` .. ``12`` become month names where the unit says month; ``01`` and ``5.5`` stay as they are.

    With ``fixes`` the result is that of ``recode`` followed by decoding, in one step: both look at the raw value once.
    """
    fixes = fixes or {}
    names = {str(i): name for i, name in enumerate(MONTH_NAMES, start=1)}
    months = {raw: names[raw] for raw in names if raw not in fixes}
    months.update({raw: names[fixed] for raw, fixed in fixes.items() if fixed in names})
    return F.coalesce(F.when(unit == month_unit, lookup(value, months)), recode(value, fixes))


def label(column: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    """Many-to-one: the first label whose name list holds the value, NULL when none does."""
    first: dict[str, str] = {}
    for name, members in labels.items():
        for member in members:
            first.setdefault(member, name)
    return lookup(column, first).cast("string")


def override_in(key: Column, keys: Sequence[str], value: str, column: Column) -> Column:
    """A fixed value for the listed keys, the column elsewhere (a missing key keeps the column)."""
    return F.when(is_in(key, keys), F.lit(value)).otherwise(column)


def override_equal(key: Column, keys: Sequence[str], value: str, column: Column) -> Column:
    """As ``override_in`` but by equality, so a missing key gives a missing value."""
    test = key == keys[0]
    for other in keys[1:]:
        test = test | (key == other)
    return if_else(test, F.lit(value), column)


def recode_from_table(df: DataFrame, column: str, table: DataFrame, source: str, target: str) -> DataFrame:
    """``recode`` for a mapping kept as a table with one row per ``source`` value.

    No broadcast hint: Spark broadcasts the table when its size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles otherwise.
    """
    found = table.select(F.col(source).alias("__source"), F.col(target).alias("__target"))
    joined = df.join(found, df[column] == found["__source"], "left")
    return joined.withColumn(column, F.coalesce(F.col("__target"), F.col(column))).drop("__source", "__target")
