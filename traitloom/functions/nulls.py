"""Missing-value rules.

The pipeline's rules for missing values differ from SQL's in a few places (negated membership keeps a missing value, a
two-armed conditional on a missing test gives a missing result, pasted text shows ``NA``). Each rule lives here once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(test: Column, yes: Column, no: Column) -> Column:
    """Three-valued conditional: a NULL test gives NULL, where ``otherwise`` would give ``no``."""
    return F.when(test, yes).when(~test, no)


def is_in(column: Column, values: Sequence) -> Column:
    """Membership that is FALSE, never NULL, for a missing value."""
    return column.isNotNull() & column.isin(list(values))


def not_in(column: Column, values: Sequence) -> Column:
    """Negated membership that keeps missing values; in this form it still reaches the Parquet scan."""
    return column.isNull() | ~column.isin(list(values))


def has_text(column: Column) -> Column:
    """TRUE for a non-empty string; NULL for a missing one, so a filter drops both blank and missing."""
    return F.length(column) > 0


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def paste(*columns: Column, sep: str = " ") -> Column:
    """Join as text, a missing part showing as ``NA`` (so a one-word name becomes ``Abies NA``)."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in columns])
