"""What the jobs are configured with. Everything in this file is data; a different study passes a different spec."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from traitloom.functions.numeric import UnitRule

# They decide the results and are spelled exactly as in the source data.

TRAIT_IDS = (205, 213, 915, 99, 59, 347, 343, 335, 29, 26, 2807)

VALUE_FIXES = {
    "disk flowers with nectar ± hidden in centre of flower": "disk flowers with nectar hidden in centre of flower",
    "poly-annuals < 5 years (short-lived perennials)": "poly-annuals less than 5 years (short-lived perennials)",
    "other|polygamodioecy": "other/polygamodioecy",
    "long lived perennial >= 50 yrs.": "long lived perennial greater than or equal 50 yrs.",
}

EXCLUDED_VALUES = ("not applicable", "not available")

EXCLUDED_TEXT_NAMES = ("Plant phenology: Annual", "Plant phenology: Biennial", "Plant phenology: Perennial")

EXCLUDED_NUMBER_NAME = "Plant lifespan (longevity) extreme"

TEXT_TRAITS = {
    "plant_life_form": ("Plant life form (Raunkiaer life form)",),
    "plant_lifespan": ("Plant life span",),
    "flowering_begin": ("Onset of flowering (first flowering date, beginning of flowering period)",),
    "flowering_end": ("End of flowering",),
    "flower_sexual_system": ("Flower sexual system", "Dicliny (monoeceous, dioecious, hermaphrodite)"),
    "apomixis": ("Apomixis",),
    "pollinator": (
        "Flower: pollinator and type of reward",
        "Pollination syndrome (pollen vector)",
        "Pollination syndrom 2",
    ),
    "flower_type": ("Flower type",),
    "fruit_type": ("Fruit type",),
    "fruit_seed_begin": ("Fruit/Seed Period Begin", "Seed shedding season (time of seed dispersal)"),
    "fruit_seed_end": ("Fruit/Seed Period End",),
    "fruit_seed_persist": ("Fruit/Seed Persistence",),
    "perenniality": ("Plant lifespan, longevity, plant maximum age", "Perennation 1 (plant age)", "Perenniality"),
    "flowering_season": (
        "Flowering season",
        "Flowering Period Length (duration of flowering period)",
        "Flowering periode: peak month",
    ),
    "germination_season": ("Time (season) of germination (seedling emergence)",),
}

NUMBER_TRAITS = {
    "plant_lifespan": (
        "Plant lifespan (longevity) min",
        "Plant lifespan (longevity) max",
        "Plant lifespan, longevity, plant maximum age",
        "Plant life span",
        "Plant longevity",
    ),
    "seed_mass": (
        "Seed mass original value: min",
        "Seed mass original value: max",
        "Seed mass min",
        "Seed mass max",
        "Seed mass",
        "Seed mass original value: mean",
    ),
    "seed_dry_mass": ("Seed dry mass",),
    "flowering_begin": ("Onset of flowering (first flowering date, beginning of flowering period)",),
    "flowering_season": ("Flowering season",),
    "plant_life_form": ("Plant life form (Raunkiaer life form)",),
}

UNIT_RULES = (
    UnitRule("mg", "g", divide=1000.0),
    UnitRule("gr", "g"),
    UnitRule("g / 1000 seeds", "g", divide=1000.0),
    UnitRule("1/lb", "1_per_kg", multiply=2.2),
    UnitRule("1/pound", "1_per_kg", multiply=2.2),
    UnitRule("1/kg", "1_per_kg"),
    UnitRule("years", "year"),
    UnitRule("yr", "year"),
    UnitRule("yrs", "year"),
    UnitRule("doy", "day_of_year"),
)

TEXT_COLUMNS = (
    "flowering_season",
    "fruit_seed_persist",
    "fruit_type",
    "flowering_begin_month",
    "flower_type",
    "apomixis",
    "germination_season",
    "flowering_end_month",
    "flowering_season_month",
    "plant_life_form",
    "perenniality",
    "plant_lifespan",
    "fruit_seed_begin",
    "fruit_seed_end",
    "flower_sexual_system",
    "pollinator",
)

NUMBER_COLUMNS = (
    "seed_dry_mass_g",
    "plant_lifespan_year",
    "plant_lifespan_",
    "plant_life_form_",
    "flowering_season_month",
    "seed_mass_g",
    "flowering_season_day_of_year",
    "flowering_begin_month",
    "seed_dry_mass_1_per_kg",
    "seed_mass_1_per_kg",
)

# Names whose blank unit left a trailing underscore.
NUMBER_NAME_FIXES = {"plant_life_form_": "plant_life_form", "plant_lifespan_": "plant_lifespan"}

EXCLUDED_SPECIES = (
    "Abies balsamea",
    "Acer negundo",
    "Acer pensylvanicum",
    "Betula lenta",
    "Betula papyrifera",
    "Carpinus caroliniana",
    "Casearia guianensis",
    "Cercis canadensis",
    "Frangula caroliniana",
    "Hamamelis virginiana",
    "Liquidambar styraciflua",
    "Ostrya virginiana",
    "Picea rubens",
    "Pinus contorta",
    "Pinus flexilis",
    "Pinus rigida",
    "Pinus strobus",
    "Piper glabrescens",
    "Platanus occidentalis",
    "Prunus virginiana",
    "Quercus coccinea",
    "Quercus falcata",
    "Quercus michauxii",
    "Quercus velutina",
    "Sambucus canadensis",
    "Sassafras albidum",
    "Solanum rugosum",
    "Sorbus americana",
    "Thuja occidentalis",
    "Ulmus americana",
    "Viburnum lantanoides",
    "Viburnum nudum",
)

# The spelling "alleghanienesis" is the one that decides the result.
SEED_PERSISTENT_SPECIES = (
    "Cecropia schreberiana",
    "Picea mariana",
    "Pinus contorta",
    "Pinus rigida",
    "Prunus virginiana",
    "Amelanchier arborea",
    "Acer rubrum",
    "Betula alleghanienesis",
    "Betula papyrifera",
    "Nyssa sylvatica",
    "Robinia pseudoacacia",
    "Sassafras albidum",
)

GROWTH_HABIT_SPECIES = ("Clusia gundlachii", "Clusia rosea")

COMMON_NAMES = {"Quercus ellipsoidalis": "northern pin oak", "Quercus macrocarpa": "bur oak"}

RECORD_SOURCE = "TRY_Kattge_etal_2020"
GROWTH_HABIT_SOURCE = "Pearse, I (pers comm)"
GROWTH_HABIT_SPECIES_SOURCE = "Zimmerman (pers comm)"
TEXT_PREFIX = "TRY_qual_"
NUMBER_PREFIX = "TRY_quant_"

SITE_NAMES = {
    "Andrews": "AND",
    "Adirondack": "ADK",
    "CedarCreek": "CDR",
    "HubbardBrook": "HBR",
    "Coweeta": "CWT",
    "Harvard": "HFR",
    "Bonanza": "BNZ",
    "Sevilleta": "SEV",
    "Luquillo": "LUQ",
}

ATTRIBUTE_NAMES = {
    "Monoecious_or_Dioecious": "Sexual_system",
    "Monoecious.or.Dioecious_REF": "Sexual_system_REF",
    "Seed_development_2yrsOR3yrs": "Seed_development_1_2or3yrs",
    "Seed_development_2yrsOR3yrs_REF": "Seed_development_1_2or3yrs_REF",
    "GrowthForm": "Growth_form",
    "GrowthForm_REF": "Growth_form_REF",
    "Growth.Habit": "Growth_habit",
}

NUMERIC_PROFILE = ("Lifespan_years", "Seed_mass_mg")

CATEGORICAL_PROFILE = (
    "Seed_development_1_2or3yrs",
    "Seed_dispersal_vector",
    "Seed_dispersal_code",
    "Pollinator_vector",
    "Pollinator_code",
    "Mycorrhiza_AM_EM",
    "Needleleaf_Broadleaf",
    "Deciduous_Evergreen_yrs",
    "Seed_Maturation_Phenology",
    "Seed_Maturation_Code",
    "Sexual_system",
    "Shade_tolerance",
    "Growth_form",
    "Growth_habit",
    "Flowering_season",
    "Seed_bank",
    "Fleshy_fruit",
    "Dispersal_syndrome",
)

# Columns the integration reads from the curated table; any others pass through.
CURATED_COLUMNS = (
    "species",
    "common",
    "included_in_data",
    *SITE_NAMES,
    "Lifespan_yrs",
    "Lifespan_yrs_REF",
    "Seed_mass_mg",
    "Seed_mass_REF",
    "Seeds_per_lb",
    "Seeds_per_lb_REF",
    "Seed_dispersal_vector",
    "Pollinator_vector",
    "Seed_Maturation_Phenology_REF",
    "Shade_tolerance",
    "Flowering_season",
    "Flowering_season_REF",
    "Fruit_seed_persist",
    "Fruit_seed_persist_REF",
    "Fleshy_fruit",
    "Fleshy_fruit_REF",
    "Dispersal_syndrome",
    "Dispersal_syndrome_REF",
    *ATTRIBUTE_NAMES,
)

# Columns of the integrated table, in order. Columns beyond these follow behind them.
INTEGRATED_COLUMNS = (
    "species", "common", *SITE_NAMES.values(),
    "Seed_development_1_2or3yrs", "Seed_development_1_2or3yrs_REF",
    "Seed_dispersal_vector", "Seed_dispersal_code",
    "Pollinator_vector", "Pollinator_code",
    "Mycorrhiza_AM_EM", "Needleleaf_Broadleaf", "Deciduous_Evergreen_yrs",
    "Seed_Maturation_Phenology", "Seed_Maturation_Phenology_REF",
    "Lifespan_years", "Lifespan_years_REF",
    "Seed_mass_mg", "Seed_mass_REF",
    "Seed_Maturation_Code", "Sexual_system", "Sexual_system_REF",
    "Shade_tolerance", "Growth_form", "Growth_form_REF", "Growth_habit", "Growth_habit_REF",
    "Flowering_season", "Flowering_season_REF",
    "Seed_bank", "Seed_bank_REF",
    "Fleshy_fruit", "Fleshy_fruit_REF",
    "Dispersal_syndrome", "Dispersal_syndrome_REF",
)


@dataclass(frozen=True)
class TraitSpec:
    """One study's vocabulary. The defaults are the fixed values above."""

    trait_ids: tuple[int, ...] = TRAIT_IDS
    value_fixes: Mapping[str, str] = field(default_factory=lambda: VALUE_FIXES)
    excluded_values: tuple[str, ...] = EXCLUDED_VALUES
    excluded_text_names: tuple[str, ...] = EXCLUDED_TEXT_NAMES
    excluded_number_name: str = EXCLUDED_NUMBER_NAME
    text_traits: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: TEXT_TRAITS)
    number_traits: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: NUMBER_TRAITS)
    unit_rules: tuple[UnitRule, ...] = UNIT_RULES
    text_columns: tuple[str, ...] = TEXT_COLUMNS
    number_columns: tuple[str, ...] = NUMBER_COLUMNS
    excluded_species: tuple[str, ...] = EXCLUDED_SPECIES
    seed_persistent_species: tuple[str, ...] = SEED_PERSISTENT_SPECIES
    growth_habit_species: tuple[str, ...] = GROWTH_HABIT_SPECIES
    common_names: Mapping[str, str] = field(default_factory=lambda: COMMON_NAMES)
    record_source: str = RECORD_SOURCE
    sites: tuple[str, ...] = tuple(SITE_NAMES.values())
    numeric_profile: tuple[str, ...] = NUMERIC_PROFILE
    categorical_profile: tuple[str, ...] = CATEGORICAL_PROFILE


DEFAULT_SPEC = TraitSpec()


def spec_from_json(text: str) -> TraitSpec:
    """A study's vocabulary from JSON: the fields named there, the defaults for all others. Unknown fields are an error."""
    given = json.loads(text)
    unknown = set(given) - {f.name for f in fields(TraitSpec)}
    if unknown:
        raise ValueError(f"TraitSpec has no fields {sorted(unknown)}")

    def plain(value):
        if isinstance(value, list):
            return tuple(plain(v) for v in value)
        return {k: plain(v) for k, v in value.items()} if isinstance(value, dict) else value

    values = {name: plain(value) for name, value in given.items()}
    if "unit_rules" in values:
        values["unit_rules"] = tuple(UnitRule(*rule) for rule in values["unit_rules"])
    return replace(DEFAULT_SPEC, **values)
