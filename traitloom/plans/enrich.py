"""Job 3: curated attribute table enriched with the two wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.functions.nulls import blank_to_null
from traitloom.functions.numeric import to_number
from traitloom.functions.recode import override_equal, override_in
from traitloom.functions.sources import prefer, prefer_with_source
from traitloom.functions.text import detect_first, detect_or_else, source_label, title_case
from traitloom.operators.columns import drop_strict, ref, rename_strict, require
from traitloom.operators.filters import keep_flagged
from traitloom.operators.joins import left_enrich_all
from traitloom.operators.reshape import relabel_columns
from traitloom.plans.spec import (
    ATTRIBUTE_NAMES,
    CURATED_COLUMNS,
    DEFAULT_SPEC,
    GROWTH_HABIT_SOURCE,
    GROWTH_HABIT_SPECIES_SOURCE,
    INTEGRATED_COLUMNS,
    NUMBER_COLUMNS,
    NUMBER_NAME_FIXES,
    NUMBER_PREFIX,
    SITE_NAMES,
    TEXT_COLUMNS,
    TEXT_PREFIX,
    TraitSpec,
)


# Wide columns the integration uses; it drops the other required ones. Columns beyond those end up in the result.
USED_TEXT = ("flowering_season", "fruit_seed_persist")
USED_NUMBERS = {"seed_dry_mass_g": "seed_dry_mass_REF", "plant_lifespan_year": "plant_lifespan_year_REF"}
NEW_COLUMNS = (
    *[TEXT_PREFIX + name + end for name in USED_TEXT for end in ("", "_REF")],
    *[NUMBER_PREFIX + name for item in USED_NUMBERS.items() for name in item],
)


def _text_side(wide: DataFrame, spec: TraitSpec) -> DataFrame:
    require(wide, ["species", *TEXT_COLUMNS])
    side = drop_strict(wide, [name for name in TEXT_COLUMNS if name not in USED_TEXT])
    side = relabel_columns(side, TEXT_PREFIX, drop_keys=spec.excluded_species)
    side = side.withColumns({TEXT_PREFIX + name: blank_to_null(F.col(TEXT_PREFIX + name)) for name in USED_TEXT})
    return side.withColumns(
        {f"{TEXT_PREFIX}{name}_REF": source_label(F.col(TEXT_PREFIX + name), spec.record_source) for name in USED_TEXT}
    )


def _number_side(wide: DataFrame, spec: TraitSpec) -> DataFrame:
    require(wide, ["species", *NUMBER_COLUMNS])
    side = drop_strict(wide, [name for name in NUMBER_COLUMNS if name not in USED_NUMBERS])
    side = relabel_columns(side, NUMBER_PREFIX, drop_keys=spec.excluded_species, fixes=NUMBER_NAME_FIXES)
    return side.withColumns(
        {
            NUMBER_PREFIX + reference: source_label(F.col(NUMBER_PREFIX + name), spec.record_source)
            for name, reference in USED_NUMBERS.items()
        }
    )


def _as_double(df: DataFrame, name: str):
    return to_number(ref(name)) if dict(df.dtypes)[name] == "string" else ref(name).cast("double")


def integrate(
    curated: DataFrame,
    text: DataFrame,
    numbers: DataFrame,
    spec: TraitSpec = DEFAULT_SPEC,
    aligned_references: bool = False,
) -> DataFrame:
    """Curated rows in the data, gaps filled from the records, one value and one reference per attribute.

    Records win for seed mass and lifespan, curated values win for flowering season and seed bank. A value and its
    reference are chosen independently, as the results to match require; ``aligned_references=True`` takes both from
    the same side instead.
    """
    require(curated, CURATED_COLUMNS)
    text_side, number_side = _text_side(text, spec), _number_side(numbers, spec)
    df = left_enrich_all(keep_flagged(curated, "included_in_data"), [text_side, number_side])

    persist = override_in(
        F.col("species"), spec.seed_persistent_species, "yes", F.col(f"{TEXT_PREFIX}fruit_seed_persist")
    )
    # new name, new reference: (first value, its reference), (second value, its reference), type
    choices = {
        ("Seed_mass_mg", "Seed_mass_REF"): (
            (F.col(f"{NUMBER_PREFIX}seed_dry_mass_g") * 1000, f"{NUMBER_PREFIX}seed_dry_mass_REF"),
            (_as_double(curated, "Seed_mass_mg"), "Seed_mass_REF"),
            "double",
        ),
        ("Lifespan_years", "Lifespan_years_REF"): (
            (F.col(f"{NUMBER_PREFIX}plant_lifespan_year"), f"{NUMBER_PREFIX}plant_lifespan_year_REF"),
            (_as_double(curated, "Lifespan_yrs"), "Lifespan_yrs_REF"),
            "double",
        ),
        ("Flowering_season", "Flowering_season_REF"): (
            (F.col("Flowering_season"), "Flowering_season_REF"),
            (F.col(f"{TEXT_PREFIX}flowering_season"), f"{TEXT_PREFIX}flowering_season_REF"),
            "string",
        ),
        ("Seed_bank", "Seed_bank_REF"): (
            (F.col("Fruit_seed_persist"), "Fruit_seed_persist_REF"),
            (persist, f"{TEXT_PREFIX}fruit_seed_persist_REF"),
            "string",
        ),
    }
    values, references = {}, {}
    for (name, reference), ((a, a_ref), (b, b_ref), as_type) in choices.items():
        if aligned_references:
            values[name], references[reference] = prefer_with_source(a, ref(a_ref), b, ref(b_ref), as_type)
        else:
            values[name] = prefer(a, b, as_type)
            references[reference] = prefer(ref(a_ref), ref(b_ref), "string")

    # The inputs of the choices go, the chosen columns come last; names may repeat, so old and new are kept apart.
    consumed = [
        "included_in_data", "Seeds_per_lb", "Seeds_per_lb_REF", "Seed_mass_mg", "Seed_mass_REF", "Lifespan_yrs",
        "Lifespan_yrs_REF", "Flowering_season", "Flowering_season_REF", "Fruit_seed_persist", "Fruit_seed_persist_REF",
        *NEW_COLUMNS,
    ]
    chosen = {**values, **references}
    df = df.select("*", *[column.alias(f"new {name}") for name, column in chosen.items()])
    df = drop_strict(df, consumed)
    df = rename_strict(df, {**{f"new {name}": name for name in chosen}, **ATTRIBUTE_NAMES, **SITE_NAMES})

    habit_reference = override_equal(
        F.col("species"),
        spec.growth_habit_species,
        GROWTH_HABIT_SPECIES_SOURCE,
        source_label(F.col("Growth_habit"), GROWTH_HABIT_SOURCE),
    )
    common = F.col("common")
    for species, name in spec.common_names.items():
        common = override_equal(F.col("species"), [species], name, common)
    made = {
        "Growth_habit_REF": habit_reference,
        "Pollinator_code": detect_or_else(F.col("Pollinator_vector"), "wind", "animal"),
        "Seed_dispersal_code": detect_first(
            F.col("Seed_dispersal_vector"), contains="wind", equals="water", otherwise="animal"
        ),
        "Shade_tolerance": title_case(F.col("Shade_tolerance")),
        "Flowering_season": blank_to_null(F.col("Flowering_season")),
        "common": common,
    }
    beyond = [name for name in df.columns if name not in INTEGRATED_COLUMNS]
    return df.select(*[(made[name] if name in made else ref(name)).alias(name) for name in INTEGRATED_COLUMNS], *map(ref, beyond))
