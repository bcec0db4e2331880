"""Stacking tables by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, NumericType

from traitloom.operators.columns import insert_at


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; a column a table lacks is NULL there.

    Two numeric types are widened. Any other disagreement is an error here, at planning time: Spark would coerce text
    and number and fail on the first odd row.
    """
    seen: dict[str, object] = {}
    for df in frames:
        for field in df.schema:
            known = seen.setdefault(field.name, field.dataType)
            both_numbers = isinstance(known, NumericType) and isinstance(field.dataType, NumericType)
            if known != field.dataType and not both_numbers and not isinstance(field.dataType, NullType):
                if not isinstance(known, NullType):
                    raise TypeError(f"column {field.name} is {known.simpleString()} and {field.dataType.simpleString()}")
                seen[field.name] = field.dataType
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "site") -> DataFrame:
    """``union_by_name`` with the name of each table in a first column."""
    return union_by_name([insert_at(df, tag, F.lit(name)) for name, df in frames.items()])
