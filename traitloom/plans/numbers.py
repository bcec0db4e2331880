"""Job 2: raw records to one row per species with one numeric column per trait and unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.functions.numeric import convert_unit, convert_value, is_number, to_number
from traitloom.functions.recode import label
from traitloom.functions.text import always_with_unit
from traitloom.operators.aggregates import mean_by
from traitloom.operators.columns import ref
from traitloom.operators.reshape import mean_wider
from traitloom.plans.records import clean_value, species_name, wanted_records
from traitloom.plans.spec import DEFAULT_SPEC, TraitSpec

# Internal name: the raw records may have any other column of their own.
SPECIES = "__species"


def _number_records(eav: DataFrame, spec: TraitSpec) -> DataFrame:
    """Raw rows that hold a usable number. Filters come before the distinct; they do not change what is distinct."""
    return wanted_records(eav, spec).filter(
        is_number(clean_value(spec)) & (F.col("DataName") != spec.excluded_number_name)
    )


def number_column(spec: TraitSpec):
    trait = label(F.col("DataName"), spec.number_traits)
    return always_with_unit(trait, convert_unit(F.col("OrigUnitStr"), spec.unit_rules))


def _measurements(distinct: DataFrame, spec: TraitSpec) -> DataFrame:
    return distinct.select(
        F.col(SPECIES).alias("species"),
        number_column(spec).alias("trait_units"),
        convert_value(to_number(clean_value(spec)), F.col("OrigUnitStr"), spec.unit_rules).alias("value"),
    )


def wide_numbers(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per species, the mean of each trait in its target unit.

    Equal measurements in different raw rows each count, so the distinct has to see every raw column. Rows outside the
    required columns only keep their species: their other columns are blanked first, which leaves one of them per
    species instead of shuffling them all. ``unmapped_numbers`` lists them.
    """
    known = F.col("__known")
    distinct = (
        _number_records(eav, spec)
        .withColumns(
            {
                SPECIES: species_name(F.col("AccSpeciesName")),
                "__known": number_column(spec).isin(list(spec.number_columns)),
            }
        )
        .select(SPECIES, *[F.when(known, ref(name)).alias(name) for name in eav.columns])
        .distinct()
    )
    return mean_wider(_measurements(distinct, spec), "species", "trait_units", "value", spec.number_columns, unlisted="drop")


def distinct_measurements(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``species, trait_units, value`` of the different raw rows that hold a usable number, with or without a column."""
    rows = _number_records(eav, spec).distinct()
    return _measurements(rows.withColumn(SPECIES, species_name(F.col("AccSpeciesName"))), spec)


def unmapped_numbers(eav: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """Means that have no column in the wide table, under the column name they would have had."""
    rows = _number_records(eav, spec).filter(~number_column(spec).isin(list(spec.number_columns))).distinct()
    rows = rows.withColumn(SPECIES, species_name(F.col("AccSpeciesName")))
    return mean_by(_measurements(rows, spec), ["species", "trait_units"], "value")
