"""The four jobs on the driver's tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from traitloom.catalog import sql
from traitloom.catalog.registry import query
from traitloom.catalog.views import CURATED_SQL, RECORDS_SQL, curated, records
from traitloom.plans.enrich import integrate
from traitloom.plans.numbers import unmapped_numbers, wide_numbers
from traitloom.plans.spec import DEFAULT_SPEC
from traitloom.plans.stats import profiles
from traitloom.plans.text import unmapped_text, wide_text

# The study's vocabulary with species that occur in the driver's tables.
SPEC = replace(
    DEFAULT_SPEC,
    excluded_species=("Customer 3", "Customer 21", "Customer 34", "Customer 55"),
    seed_persistent_species=("Customer 8", "Customer 21", "Customer 89"),
    growth_habit_species=("Customer 5", "Customer 13"),
    common_names={"Customer 11": "northern pin oak", "Customer 12": "bur oak"},
)

_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

_CLEAN_SQL = f"""{RECORDS_SQL}, fixed AS (
    SELECT DISTINCT *, {sql.case_values('"OrigValueStr"', SPEC.value_fixes)} AS fixed
    FROM records WHERE "TraitID" IN {sql.in_list(SPEC.trait_ids)}),
clean AS (
    SELECT coalesce(string_split("AccSpeciesName", ' ')[1], 'NA') || ' ' || coalesce(string_split("AccSpeciesName", ' ')[2], 'NA')
    AS species, "DataName", "OrigUnitStr" AS unit, CASE WHEN "OrigUnitStr" = 'month'
    THEN {sql.case_values('fixed', {str(i): m for i, m in enumerate(_MONTHS, 1)})} ELSE fixed END AS val
    FROM fixed WHERE length(fixed) > 0)"""

_TEXT_SQL = f"""labelled AS (
    SELECT DISTINCT species, "DataName", {sql.case_members('"DataName"', SPEC.text_traits)} AS trait, lower(val) AS val,
    lower(unit) AS unit FROM clean WHERE NOT {sql.IS_NUMBER.format('val')}
    AND NOT coalesce(lower(val) IN {sql.in_list(SPEC.excluded_values)}, false)
    AND NOT coalesce("DataName" IN {sql.in_list(SPEC.excluded_text_names)}, false)),
text_entries AS (
    SELECT DISTINCT species, "DataName", trait, unit, CASE WHEN length(unit) = 0 OR val IS NULL THEN trait
    WHEN NOT (length(unit) = 0 OR val IS NULL) THEN coalesce(trait, 'NA') || '_' || coalesce(unit, 'NA') END AS trait_units, val
    FROM labelled),
wide_text AS (SELECT species,
    {", ".join(f"string_agg(val, '; ' ORDER BY val) FILTER (WHERE trait_units = '{c}') AS {c}" for c in SPEC.text_columns)}
    FROM (SELECT DISTINCT species, trait, unit, trait_units, val FROM text_entries) GROUP BY species)"""

_NUMBER_SQL = f"""converted AS (
    SELECT species, {sql.case_members('"DataName"', SPEC.number_traits)} AS trait,
    CASE WHEN unit IN ('mg', 'g / 1000 seeds') THEN v / 1000 WHEN unit IN ('1/lb', '1/pound') THEN v * 2.2 ELSE v END AS v,
    CASE WHEN unit IN ('mg', 'gr', 'g / 1000 seeds') THEN 'g' WHEN unit IN ('years', 'yr', 'yrs') THEN 'year'
    WHEN unit IN ('1/lb', '1/pound', '1/kg') THEN '1_per_kg' WHEN unit = 'doy' THEN 'day_of_year' ELSE unit END AS unit
    FROM (SELECT *, {sql.TO_NUMBER.format('val')} AS v FROM clean) WHERE v IS NOT NULL AND "DataName" <> 'Plant lifespan (longevity) extreme'),
number_means AS (SELECT species, coalesce(trait, 'NA') || '_' || coalesce(unit, 'NA') AS trait_units, avg(v) AS value_entry
    FROM converted GROUP BY 1, 2),
wide_numbers AS (SELECT species,
    {", ".join(f"max(CASE WHEN trait_units = '{c}' THEN value_entry END) AS {c}" for c in SPEC.number_columns)}
    FROM number_means GROUP BY species)"""


@query("job_qual_wide", f"WITH {_CLEAN_SQL}, {_TEXT_SQL} SELECT * FROM wide_text")
def job_qual_wide(spark, sf_dir):
    return wide_text(records(spark, sf_dir), SPEC)


@query(
    "job_qual_unmapped",
    f"""WITH {_CLEAN_SQL}, {_TEXT_SQL} SELECT DISTINCT species, coalesce(trait_units, 'NA') AS trait_units, "DataName", val AS value
    FROM text_entries WHERE NOT coalesce(trait_units, 'NA') IN {sql.in_list(SPEC.text_columns)}""",
)
def job_qual_unmapped(spark, sf_dir):
    return unmapped_text(records(spark, sf_dir), SPEC)


@query(
    "job_quant_wide",
    f"""WITH {_CLEAN_SQL}, {_NUMBER_SQL} SELECT species, {", ".join(f"round({c}, 6) AS {c}" for c in SPEC.number_columns)}
    FROM wide_numbers""",
)
def job_quant_wide(spark, sf_dir):
    wide = wide_numbers(records(spark, sf_dir), SPEC)
    return wide.select("species", *[F.round(name, 6).alias(name) for name in SPEC.number_columns])


@query(
    "job_quant_unmapped",
    f"""WITH {_CLEAN_SQL}, {_NUMBER_SQL} SELECT species, trait_units, round(value_entry, 6) AS value_entry FROM number_means
    WHERE trait_units NOT IN {sql.in_list(SPEC.number_columns)}""",
)
def job_quant_unmapped(spark, sf_dir):
    means = unmapped_numbers(records(spark, sf_dir), SPEC)
    return means.withColumn("value_entry", F.round("value_entry", 6))


_EXCLUDED = sql.in_list(SPEC.excluded_species)

_INTEGRATED_SQL = f"""{_CLEAN_SQL}, {_TEXT_SQL}, {_NUMBER_SQL}, {CURATED_SQL}, text_side AS (
    SELECT species, nullif(flowering_season, '') AS season, nullif(fruit_seed_persist, '') AS persist,
    CASE WHEN length(flowering_season) > 0 THEN 'TRY_Kattge_etal_2020' END AS season_ref,
    CASE WHEN length(fruit_seed_persist) > 0 THEN 'TRY_Kattge_etal_2020' END AS persist_ref
    FROM wide_text WHERE NOT coalesce(species IN {_EXCLUDED}, false)),
number_side AS (
    SELECT species, seed_dry_mass_g * 1000 AS mass, plant_lifespan_year AS years,
    CASE WHEN seed_dry_mass_g IS NOT NULL THEN 'TRY_Kattge_etal_2020' END AS mass_ref,
    CASE WHEN plant_lifespan_year IS NOT NULL THEN 'TRY_Kattge_etal_2020' END AS years_ref
    FROM wide_numbers WHERE NOT coalesce(species IN {_EXCLUDED}, false)),
integrated AS (
    SELECT c.species, CASE c.species WHEN 'Customer 11' THEN 'northern pin oak' WHEN 'Customer 12' THEN 'bur oak' ELSE common END AS common,
    "Andrews" AS "AND", "Adirondack" AS "ADK", "CedarCreek" AS "CDR", "HubbardBrook" AS "HBR", "Coweeta" AS "CWT",
    "Harvard" AS "HFR", "Bonanza" AS "BNZ", "Sevilleta" AS "SEV", "Luquillo" AS "LUQ",
    "Seed_development_2yrsOR3yrs" AS "Seed_development_1_2or3yrs",
    "Seed_development_2yrsOR3yrs_REF" AS "Seed_development_1_2or3yrs_REF", "Seed_dispersal_vector",
    CASE WHEN contains("Seed_dispersal_vector", 'wind') THEN 'wind' WHEN "Seed_dispersal_vector" = 'water' THEN 'water'
    ELSE 'animal' END AS "Seed_dispersal_code", "Pollinator_vector",
    CASE WHEN contains("Pollinator_vector", 'wind') THEN 'wind' WHEN NOT contains("Pollinator_vector", 'wind') THEN 'animal' END
    AS "Pollinator_code", "Mycorrhiza_AM_EM", "Needleleaf_Broadleaf", "Deciduous_Evergreen_yrs", "Seed_Maturation_Phenology",
    "Seed_Maturation_Phenology_REF", round(coalesce(years, "Lifespan_yrs"), 6) AS "Lifespan_years",
    coalesce(years_ref, "Lifespan_yrs_REF") AS "Lifespan_years_REF",
    round(coalesce(mass, {sql.TO_NUMBER.format('"Seed_mass_mg"')}), 6) AS "Seed_mass_mg",
    coalesce(mass_ref, "Seed_mass_REF") AS "Seed_mass_REF", "Seed_Maturation_Code", "Monoecious_or_Dioecious" AS "Sexual_system",
    "Monoecious.or.Dioecious_REF" AS "Sexual_system_REF",
    CASE "Shade_tolerance" WHEN 'semi-tolerant' THEN 'Semi-Tolerant' WHEN 'INTOLERANT' THEN 'Intolerant'
    WHEN 'very tolerant' THEN 'Very Tolerant' END AS "Shade_tolerance",
    "GrowthForm" AS "Growth_form", "GrowthForm_REF" AS "Growth_form_REF", "Growth.Habit" AS "Growth_habit",
    CASE WHEN c.species IN ('Customer 5', 'Customer 13') THEN 'Zimmerman (pers comm)'
    WHEN length("Growth.Habit") > 0 THEN 'Pearse, I (pers comm)' END AS "Growth_habit_REF",
    nullif(coalesce("Flowering_season", season), '') AS "Flowering_season",
    coalesce("Flowering_season_REF", season_ref) AS "Flowering_season_REF",
    coalesce("Fruit_seed_persist", CASE WHEN c.species IN ('Customer 8', 'Customer 21', 'Customer 89') THEN 'yes' ELSE persist END)
    AS "Seed_bank", coalesce("Fruit_seed_persist_REF", persist_ref) AS "Seed_bank_REF", "Fleshy_fruit", "Fleshy_fruit_REF",
    "Dispersal_syndrome", "Dispersal_syndrome_REF"
    FROM curated c LEFT JOIN text_side t ON c.species = t.species LEFT JOIN number_side n ON c.species = n.species
    WHERE included_in_data = 1)"""


def _integrated(spark, sf_dir, aligned_references=False):
    raw = records(spark, sf_dir)
    return integrate(curated(spark, sf_dir), wide_text(raw, SPEC), wide_numbers(raw, SPEC), SPEC, aligned_references)


@query("job_enrich", f"WITH {_INTEGRATED_SQL} SELECT * FROM integrated")
def job_enrich(spark, sf_dir):
    rounded = {name: F.round(name, 6) for name in ("Lifespan_years", "Seed_mass_mg")}
    return _integrated(spark, sf_dir).withColumns(rounded)


_OVERALL = {"": "true"}
_BY_SITE = {site: f'"{site}" = 1' for site in SPEC.sites}


@query(
    "job_stats_quant_overall",
    f"WITH {_INTEGRATED_SQL} {sql.numeric_profile('integrated', SPEC.numeric_profile, _OVERALL)}",
)
def job_stats_quant_overall(spark, sf_dir):
    return profiles(_integrated(spark, sf_dir), SPEC)["overall_stats_for_quant_atts"]


@query(
    "job_stats_quant_by_site",
    f"WITH {_INTEGRATED_SQL} {sql.numeric_profile('integrated', SPEC.numeric_profile, _BY_SITE, 'site')}",
)
def job_stats_quant_by_site(spark, sf_dir):
    return profiles(_integrated(spark, sf_dir), SPEC)["site_stats_for_quant_atts"]


@query(
    "job_stats_qual_overall",
    f"WITH {_INTEGRATED_SQL} {sql.frequencies('integrated', SPEC.categorical_profile, _OVERALL)}",
)
def job_stats_qual_overall(spark, sf_dir):
    return profiles(_integrated(spark, sf_dir), SPEC)["overall_stats_for_qual_atts"]


@query(
    "job_stats_qual_by_site",
    f"WITH {_INTEGRATED_SQL} {sql.frequencies('integrated', SPEC.categorical_profile, _BY_SITE, 'site')}",
)
def job_stats_qual_by_site(spark, sf_dir):
    return profiles(_integrated(spark, sf_dir), SPEC)["site_stats_for_qual_atts"]
