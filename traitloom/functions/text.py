"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitloom.functions.nulls import has_text, if_else

# A new word starts after anything that is not a letter, a digit, an underscore or an apostrophe.
WORD_START = r"(?<=[^\p{L}\p{N}_'])"


def title_case(column: Column) -> Column:
    """Capitalise every word, also after a hyphen (``initcap`` alone only splits at blanks)."""
    pieces = F.split(F.lower(column), WORD_START)
    return F.array_join(F.transform(pieces, F.initcap), "")


def with_unit(name: Column, unit: Column, value: Column) -> Column:
    """``name`` or ``name_unit``; the unit is left out when blank. A missing unit gives a missing result."""
    bare = (F.length(unit) == 0) | value.isNull()
    return F.when(bare, name).when(unit.isNotNull(), always_with_unit(name, unit))


def always_with_unit(name: Column, unit: Column) -> Column:
    """``name_unit`` in every case: a blank unit leaves a trailing underscore, missing parts show as ``NA``."""
    return F.concat_ws("_", F.coalesce(name, F.lit("NA")), F.coalesce(unit, F.lit("NA")))


def source_label(value: Column, source: str) -> Column:
    """Name of the source where it supplied a value (neither missing nor blank), NULL elsewhere."""
    return F.when(has_text(value.cast("string")), F.lit(source))


def detect_or_else(column: Column, word: str, otherwise: str) -> Column:
    """``word`` when the text contains it, ``otherwise`` when not; a missing text stays missing."""
    return if_else(column.contains(word), F.lit(word), F.lit(otherwise))


def detect_first(column: Column, contains: str, equals: str, otherwise: str) -> Column:
    """First rule that holds: text contains a word, text equals a word, anything else (missing included)."""
    return (
        F.when(column.contains(contains), F.lit(contains))
        .when(column == equals, F.lit(equals))
        .otherwise(F.lit(otherwise))
    )
