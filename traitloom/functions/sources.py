"""Choosing between two sources of the same attribute, with or without their references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefer(first: Column, second: Column, as_type: str) -> Column:
    """First non-missing value; both sides are cast first so that no silent type coercion decides."""
    return F.coalesce(first.cast(as_type), second.cast(as_type))


def prefer_with_source(
    first: Column, first_source: Column, second: Column, second_source: Column, as_type: str
) -> tuple[Column, Column]:
    """Value and reference taken from the same side (coalescing them apart can cite the losing side)."""
    value = prefer(first, second, as_type)
    source = F.when(first.isNotNull(), first_source).when(second.isNotNull(), second_source)
    return value, source
