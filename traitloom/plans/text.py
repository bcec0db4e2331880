"""Job 1: raw records to one row per species with one text column per trait."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.functions.nulls import not_in
from traitloom.functions.numeric import is_number
from traitloom.functions.recode import label
from traitloom.functions.text import with_unit
from traitloom.operators.reshape import collapse_wider
from traitloom.plans.records import clean_value, species_name, wanted_records
from traitloom.plans.spec import DEFAULT_SPEC, TraitSpec


def text_entries(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """(species, DataName, trait, unit, value, trait_units) for every record whose value is text.

    The whole-row distinct of the raw records is left out: the distinct over fewer columns that follows makes it
    redundant here, and without it only five columns are read.
    """
    return (
        wanted_records(eav, spec)
        .select(
            species_name(F.col("AccSpeciesName")).alias("species"),
            "DataName",
            F.lower("OrigUnitStr").alias("unit"),
            clean_value(spec).alias("value"),
        )
        .filter(~is_number(F.col("value")))
        .withColumn("value", F.lower("value"))
        .filter(not_in(F.col("value"), spec.excluded_values) & not_in(F.col("DataName"), spec.excluded_text_names))
        .withColumn("trait", label(F.col("DataName"), spec.text_traits))
        .withColumn("trait_units", with_unit(F.col("trait"), F.col("unit"), F.col("value")))
    )


def wide_text(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per species, the distinct values of each trait joined in order.

    Entries outside the required columns keep their species in the result and nothing else, so they shrink to one row
    per species before the shuffle; ``unmapped_text`` lists them.
    """
    known = F.col("trait_units").isin(list(spec.text_columns))
    entries = text_entries(eav, spec).select(
        "species", F.when(known, F.col("trait_units")).alias("name"), F.when(known, F.col("value")).alias("value")
    )
    return collapse_wider(entries, "species", "name", "value", spec.text_columns, unlisted="drop", distinct=True)


def unmapped_text(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """The entries that have no column in the wide table, under the column name they would have had."""
    name = F.coalesce(F.col("trait_units"), F.lit("NA"))
    return (
        text_entries(eav, spec)
        .select("species", name.alias("trait_units"), "DataName", "value")
        .filter(~F.col("trait_units").isin(list(spec.text_columns)))
        .distinct()
    )
