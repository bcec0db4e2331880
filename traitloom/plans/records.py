"""Row-level steps both wrangling jobs share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitloom.functions.nulls import has_text, paste
from traitloom.functions.recode import decode_month
from traitloom.plans.spec import TraitSpec


def species_name(full_name: Column) -> Column:
    """First two words; the rest (variety, author) is ignored."""
    words = F.split(full_name, " ", 3)
    return paste(F.get(words, F.lit(0)), F.get(words, F.lit(1)))


def clean_value(spec: TraitSpec) -> Column:
    """The raw value with known misprints corrected and month numbers spelled out."""
    return decode_month(F.col("OrigValueStr"), F.col("OrigUnitStr"), spec.value_fixes)


def is_wanted(spec: TraitSpec) -> Column:
    """Records of the wanted traits that hold a value, also once misprints are corrected."""
    value = F.col("OrigValueStr")
    holds = has_text(value)
    blanked = [raw for raw, fixed in spec.value_fixes.items() if not (fixed or "").strip()]
    if blanked:
        holds = holds & ~value.isin(blanked)
    return F.col("TraitID").isin(list(spec.trait_ids)) & holds


def wanted_records(eav: DataFrame, spec: TraitSpec) -> DataFrame:
    """The rows of ``is_wanted``. The conditions reach the scan."""
    return eav.filter(is_wanted(spec))
