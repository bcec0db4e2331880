import random

import pytest
from pyspark.sql import functions as F

from traitloom.operators.setops import union_tagged
from traitloom.plans.enrich import integrate
from traitloom.plans.numbers import unmapped_numbers, wide_numbers
from traitloom.plans.spec import (
    CATEGORICAL_PROFILE,
    CURATED_COLUMNS,
    DEFAULT_SPEC,
    EXCLUDED_SPECIES,
    NUMBER_COLUMNS,
    SEED_PERSISTENT_SPECIES,
    TEXT_COLUMNS,
)
from traitloom.plans.stats import profiles
from traitloom.plans.text import unmapped_text, wide_text

RAW = "TraitID int, AccSpeciesName string, TraitName string, DataName string, OrigValueStr string, OrigUnitStr string, ObsID string"


def record(species, name, value, unit="", obs="1", trait_id=59):
    return (trait_id, species, "t", name, value, unit, obs)


def by_species(df):
    return {r.species: {k: v for k, v in r.asDict().items() if k != "species" and v is not None} for r in df.collect()}


def test_fixed_values():
    assert len(EXCLUDED_SPECIES) == 32 and len(SEED_PERSISTENT_SPECIES) == 12
    assert len(set(EXCLUDED_SPECIES) & set(SEED_PERSISTENT_SPECIES)) == 5
    assert len(TEXT_COLUMNS) == 16 and len(NUMBER_COLUMNS) == 10 and len(CATEGORICAL_PROFILE) == 18
    assert sum(map(len, DEFAULT_SPEC.text_traits.values())) == 23 and len(DEFAULT_SPEC.text_traits) == 15
    assert sum(map(len, DEFAULT_SPEC.number_traits.values())) == 15 and len(DEFAULT_SPEC.number_traits) == 6


@pytest.fixture
def raw(spark):
    life = "Plant life span"
    data = [
        # names of one to four words
        record("Abies", life, "Perennial"),
        record("Abies alba", life, "perennial"),
        record("Abies alba var.", life, "Annual"),
        record("Abies alba var. x", life, "ANNUAL", obs="2"),
        # not wanted, blank, missing, excluded
        record("Abies alba", life, "biennial", trait_id=1),
        record("Abies alba", life, ""),
        record("Abies alba", life, None),
        record("Abies alba", life, "Not Available"),
        record("Abies alba", "Plant phenology: Annual", "yes"),
        # corrected values
        record("Abies alba", "Flower: pollinator and type of reward", "disk flowers with nectar ± hidden in centre of flower"),
        record("Abies alba", "Flower sexual system", "other|polygamodioecy"),
        # months: text with a unit; 01 and 5.5 stay numbers
        record("Abies alba", "Flowering season", "1", "month"),
        record("Abies alba", "Flowering season", "12", "month"),
        record("Abies alba", "Flowering season", "01", "month"),
        record("Abies alba", "Flowering season", "5.5", "month"),
        # missing and unknown data names
        record("Abies alba", None, "free text"),
        record("Abies alba", "Something else", "free text", "cm"),
        record("Abies alba", "Something else", "7", "cm"),
        record("Abies alba", None, "7"),
        # a missing unit hides the trait
        record("Abies alba", "Apomixis", "yes", None),
        # equal value, different raw row: counts twice in a mean; fully equal rows count once
        record("Pinus nigra", "Seed dry mass", "10", "mg", "1"),
        record("Pinus nigra", "Seed dry mass", "10", "mg", "2"),
        record("Pinus nigra", "Seed dry mass", "40", "mg", "3"),
        record("Pinus nigra", "Seed dry mass", "40", "mg", "3"),
        record("Pinus nigra", "Seed dry mass", "5", "gr", "4"),
        record("Pinus nigra", "Seed dry mass", "10", "1/lb", "5"),
        record("Pinus nigra", "Seed dry mass", "10", "1/kg", "6"),
        record("Pinus nigra", "Seed dry mass", "5", "MG", "7"),
        record("Pinus nigra", "Plant lifespan (longevity) max", "20", "yrs"),
        record("Pinus nigra", "Plant lifespan (longevity) min", "10", "yr"),
        record("Pinus nigra", "Plant lifespan (longevity) extreme", "999", "yr"),
        record("Pinus nigra", "Plant longevity", "30", ""),
        record("Pinus nigra", "Seed mass original value: min", "1", "g / 1000 seeds"),
        record("Pinus nigra", "Seed mass original value: mean", "3", "g / 1000 seeds"),
        # only entries without a column: the species still has a row
        record("Quercus robur", "Something else", "words"),
        record("Quercus robur", "Something else", "8", "cm"),
    ]
    return spark.createDataFrame(data, RAW).repartition(3)


def test_wide_text(raw):
    wide = wide_text(raw)
    assert wide.columns == ["species", *TEXT_COLUMNS]
    assert by_species(wide) == {
        "Abies NA": {"plant_lifespan": "perennial"},
        "Abies alba": {
            "plant_lifespan": "annual; perennial",
            "pollinator": "disk flowers with nectar hidden in centre of flower",
            "flower_sexual_system": "other/polygamodioecy",
            "flowering_season_month": "dec; jan",
        },
        "Quercus robur": {},
    }


def test_unmapped_text(raw, rows):
    assert rows(unmapped_text(raw)) == [
        ("Abies alba", "NA", None, "free text"),
        ("Abies alba", "NA", "Apomixis", "yes"),
        ("Abies alba", "NA_cm", "Something else", "free text"),
        ("Quercus robur", "NA", "Something else", "words"),
    ]


def test_wide_numbers(raw):
    wide = wide_numbers(raw)
    assert wide.columns == ["species", *NUMBER_COLUMNS]
    got = by_species(wide)
    assert set(got) == {"Abies alba", "Pinus nigra", "Quercus robur"}
    assert got["Quercus robur"] == {}
    assert got["Abies alba"] == pytest.approx({"flowering_season_month": 3.25})
    assert got["Pinus nigra"] == pytest.approx(
        {
            "seed_dry_mass_g": (0.01 + 0.01 + 0.04 + 5) / 4,
            "seed_dry_mass_1_per_kg": 16.0,
            "plant_lifespan_year": 15.0,
            "plant_lifespan_": 30.0,
            "seed_mass_g": 0.002,
        }
    )


def test_unmapped_numbers(raw, rows):
    assert rows(unmapped_numbers(raw)) == [
        ("Abies alba", "NA_cm", 7.0),
        ("Pinus nigra", "seed_dry_mass_MG", 5.0),
        ("Quercus robur", "NA_cm", 8.0),
    ]


def test_dropping_the_raw_distinct_changes_means_but_not_text(raw, rows):
    doubled = raw.unionAll(raw)
    assert rows(wide_text(doubled)) == rows(wide_text(raw))
    assert rows(wide_numbers(doubled)) == rows(wide_numbers(raw))
    renumbered = raw.unionAll(raw.withColumn("ObsID", F.concat("ObsID", F.lit("x"))).filter("OrigValueStr = '40'"))
    assert rows(wide_text(renumbered)) == rows(wide_text(raw))
    assert by_species(wide_numbers(renumbered))["Pinus nigra"]["seed_dry_mass_g"] == pytest.approx(5.1 / 5)


def test_hot_species_and_copies_equal_python(spark):
    """A third of the rows are copies of one record, another third belong to one species."""
    rng = random.Random(2)
    data = [record("Hot one", "Perenniality", "Same")] * 4000
    data += [record("Hot one", "Perenniality", f"V{rng.randrange(2000)}", obs=str(i)) for i in range(4000)]
    data += [record(f"S {i % 300}", "Perenniality", f"w{rng.randrange(40)}") for i in range(2000)]
    data += [record("Hot one", "Seed dry mass", str(rng.randrange(1000)), "gr", str(i)) for i in range(2000)]
    df = spark.createDataFrame(data, RAW).repartition(6)
    text = {k: v.get("perenniality") for k, v in by_species(wide_text(df)).items()}
    want = {}
    for r in data:
        if r[3] == "Perenniality":
            want.setdefault(r[1], set()).add(r[4].lower())
    assert text == {k: "; ".join(sorted(v)) for k, v in want.items()}
    masses = [float(r[4]) for r in set(data) if r[3] == "Seed dry mass"]
    assert by_species(wide_numbers(df)) == {"Hot one": {"seed_dry_mass_g": pytest.approx(sum(masses) / len(masses))}}


TYPES = {"included_in_data": "int", "Lifespan_yrs": "double", "Seeds_per_lb": "double"}
SITES = ("Andrews", "Adirondack", "CedarCreek", "HubbardBrook", "Coweeta", "Harvard", "Bonanza", "Sevilleta", "Luquillo")


def curated_table(spark, *entries):
    names = [*CURATED_COLUMNS, "Mycorrhiza_AM_EM", "Needleleaf_Broadleaf", "Deciduous_Evergreen_yrs",
             "Seed_Maturation_Phenology", "Seed_Maturation_Code", "extra"]
    types = {**TYPES, **{site: "int" for site in SITES}}
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    rows = [tuple({"included_in_data": 1, **entry}.get(n) for n in names) for entry in entries]
    return spark.createDataFrame(rows, schema)


def wide_table(spark, columns, kind, *entries):
    schema = "species string, " + ", ".join(f"{n} {kind}" for n in columns)
    return spark.createDataFrame([tuple(e.get(n) for n in ["species", *columns]) for e in entries], schema)


@pytest.fixture
def integrated(spark):
    curated = curated_table(
        spark,
        {"species": "Both set", "Seed_mass_mg": "7", "Seed_mass_REF": "book", "Lifespan_yrs": 3.0, "Lifespan_yrs_REF": "book",
         "Flowering_season": "spring", "Flowering_season_REF": "book", "Fruit_seed_persist": "no",
         "Fruit_seed_persist_REF": "book", "Pollinator_vector": "wind, bees", "Seed_dispersal_vector": "water",
         "Shade_tolerance": "semi-tolerant", "Growth.Habit": "erect", "common": "kept", "extra": "through"},
        {"species": "Only records", "Seed_mass_mg": "unknown", "Pollinator_vector": "bees", "Growth.Habit": ""},
        {"species": "Only curated", "Seed_mass_mg": "1e2", "Lifespan_yrs": 9.0, "Flowering_season": ""},
        {"species": "Not included", "included_in_data": 0},
        {"species": "Unknown inclusion", "included_in_data": None},
        {"species": "Acer negundo", "Fruit_seed_persist": "no"},
        {"species": "Pinus rigida"},
        {"species": "Acer rubrum", "Fruit_seed_persist_REF": "book"},
        {"species": "Clusia rosea", "Growth.Habit": None},
        {"species": "Quercus macrocarpa", "common": "x"},
        {"species": None, "common": "nobody", "Growth.Habit": "erect"},
        {"species": "Only curated", "Seed_mass_mg": "5"},
    )
    text = wide_table(
        spark, TEXT_COLUMNS, "string",
        {"species": "Both set", "flowering_season": "autumn", "fruit_seed_persist": "yes"},
        {"species": "Only records", "flowering_season": "autumn", "fruit_seed_persist": "long"},
        {"species": "Acer negundo", "flowering_season": "autumn"},
        {"species": "Acer rubrum", "fruit_seed_persist": "short", "flowering_season": ""},
        {"species": "Nowhere", "flowering_season": "autumn"},
    )
    numbers = wide_table(
        spark, NUMBER_COLUMNS, "double",
        {"species": "Both set", "seed_dry_mass_g": 0.5, "plant_lifespan_year": 30.0},
        {"species": "Only records", "seed_dry_mass_g": 0.25},
        {"species": "Acer negundo", "seed_dry_mass_g": 0.25},
    )
    return curated, text, numbers


def test_integration(integrated):
    out = integrate(*integrated)
    got = {}
    for r in out.collect():
        got.setdefault(r.species, []).append({k: v for k, v in r.asDict().items() if k != "species" and v is not None})
    assert len(got.pop("Only curated")) == 2  # a repeated curated row stays repeated
    got = {k: v[0] for k, v in got.items()}
    source = "TRY_Kattge_etal_2020"
    assert got["Both set"] == {
        "common": "kept", "Seed_mass_mg": 500.0, "Seed_mass_REF": source, "Lifespan_years": 30.0, "Lifespan_years_REF": source,
        "Flowering_season": "spring", "Flowering_season_REF": "book", "Seed_bank": "no", "Seed_bank_REF": "book",
        "Pollinator_vector": "wind, bees", "Pollinator_code": "wind", "Seed_dispersal_vector": "water",
        "Seed_dispersal_code": "water", "Shade_tolerance": "Semi-Tolerant", "Growth_habit": "erect",
        "Growth_habit_REF": "Pearse, I (pers comm)", "extra": "through",
    }
    assert got["Only records"] == {
        "Seed_mass_mg": 250.0, "Seed_mass_REF": source, "Flowering_season": "autumn", "Flowering_season_REF": source,
        "Seed_bank": "long", "Seed_bank_REF": source, "Pollinator_vector": "bees", "Pollinator_code": "animal",
        "Seed_dispersal_code": "animal", "Growth_habit": "",
    }
    # excluded from the records, kept in the table; persistence is still set by hand
    assert got["Acer negundo"] == {"Seed_bank": "no", "Seed_dispersal_code": "animal"}
    assert got["Pinus rigida"] == {"Seed_bank": "yes", "Seed_dispersal_code": "animal"}
    assert got["Acer rubrum"] == {"Seed_bank": "yes", "Seed_bank_REF": "book", "Seed_dispersal_code": "animal"}
    assert got["Clusia rosea"]["Growth_habit_REF"] == "Zimmerman (pers comm)"
    assert got["Quercus macrocarpa"]["common"] == "bur oak"
    assert got[None] == {"Growth_habit": "erect", "Seed_dispersal_code": "animal"}
    assert "Not included" not in got and "Unknown inclusion" not in got and "Nowhere" not in got


def test_integration_column_order(integrated):
    names = integrate(*integrated).columns
    assert not [n for n in names if n.startswith("TRY_")] and len(names) == len(set(names))

    def in_a_row(*wanted):
        at = names.index(wanted[0])
        assert names[at : at + len(wanted)] == list(wanted)

    in_a_row("species", "common", "AND", "ADK", "CDR", "HBR", "CWT", "HFR", "BNZ", "SEV", "LUQ")
    in_a_row("Seed_Maturation_Phenology_REF", "Lifespan_years", "Lifespan_years_REF", "Seed_mass_mg", "Seed_mass_REF")
    in_a_row("Flowering_season", "Flowering_season_REF")
    in_a_row("Seed_bank", "Seed_bank_REF", "Fleshy_fruit", "Fleshy_fruit_REF", "Dispersal_syndrome", "Dispersal_syndrome_REF")
    in_a_row("Growth_habit", "Growth_habit_REF")
    in_a_row("Pollinator_vector", "Pollinator_code")
    in_a_row("Seed_dispersal_vector", "Seed_dispersal_code")


def test_aligned_references(integrated):
    curated, text, numbers = integrated
    curated = curated.withColumn("Flowering_season_REF", F.when(F.col("species") == "Only records", "stray"))
    faithful = {r.species: r.Flowering_season_REF for r in integrate(curated, text, numbers).collect()}
    aligned = {r.species: r.Flowering_season_REF for r in integrate(curated, text, numbers, aligned_references=True).collect()}
    assert faithful["Only records"] == "stray"
    assert aligned["Only records"] == "TRY_Kattge_etal_2020"


def test_integration_checks_its_inputs(integrated):
    curated, text, numbers = integrated
    with pytest.raises(ValueError, match="apomixis"):
        integrate(curated, text.drop("apomixis"), numbers)
    with pytest.raises(ValueError, match="Seeds_per_lb"):
        integrate(curated.drop("Seeds_per_lb"), text, numbers)


def test_profiles_equal_the_loops(spark, integrated, rows):
    curated, text, numbers = integrated
    curated = curated.withColumns({"Andrews": F.lit(1), "Harvard": F.when(F.col("species") == "Both set", 1)})
    table = integrate(curated, text, numbers)
    out = profiles(table)
    by_site = out["site_stats_for_qual_atts"]
    assert by_site.columns == ["site", "variable", "value", "count"]
    looped = union_tagged(
        {
            site: union_tagged(
                {
                    name: table.filter(f"{site} = 1").groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("count"))
                    for name in CATEGORICAL_PROFILE
                },
                "variable",
            )
            for site in ("AND", "HFR", "BNZ")
        }
    )
    assert rows(by_site) == rows(looped)
    assert out["overall_stats_for_quant_atts"].columns == ["variable", "n", "min", "max", "mean", "sd"]
    stats = {(r.site, r.variable): tuple(r)[2:] for r in out["site_stats_for_quant_atts"].collect()}
    assert stats[("HFR", "Seed_mass_mg")] == (1, 500.0, 500.0, 500.0, None)
    assert {site for site, _ in stats} == {"AND", "HFR"}
