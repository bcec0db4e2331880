"""Which job a raw record is for, decided once, when it is landed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitloom.functions.nulls import not_in
from traitloom.functions.numeric import is_number
from traitloom.functions.recode import label
from traitloom.functions.text import with_unit
from traitloom.plans.numbers import number_column
from traitloom.plans.records import clean_value, is_wanted
from traitloom.plans.spec import TraitSpec

#: Text and numbers that have a column in the wide tables, those that have none, and records no job uses.
TEXT, TEXT_OTHER, NUMBER, NUMBER_OTHER, UNUSED = "text", "text_other", "number", "number_other", "unused"
BRANCHES = (TEXT, TEXT_OTHER, NUMBER, NUMBER_OTHER, UNUSED)


def record_branch(spec: TraitSpec) -> Column:
    """The number pattern is tried once for a record that holds a value, and not for others."""
    value = F.lower(clean_value(spec))
    name = with_unit(label(F.col("DataName"), spec.text_traits), F.lower("OrigUnitStr"), value)
    used = not_in(value, spec.excluded_values) & not_in(F.col("DataName"), spec.excluded_text_names)
    text = F.when(~used, UNUSED).when(name.isin(list(spec.text_columns)), TEXT).otherwise(TEXT_OTHER)
    named = F.coalesce(F.col("DataName") != spec.excluded_number_name, F.lit(False))
    listed = number_column(spec).isin(list(spec.number_columns))
    number = F.when(~named, UNUSED).when(listed, NUMBER).otherwise(NUMBER_OTHER)
    return F.when(~F.coalesce(is_wanted(spec), F.lit(False)), UNUSED).when(is_number(clean_value(spec)), number).otherwise(text)
