"""Queries for value-level functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitloom.catalog.registry import query
from traitloom.catalog.sql import IS_NUMBER, TO_NUMBER
from traitloom.catalog.views import CURATED_SQL, RECORDS_SQL, curated, records, table
from traitloom.functions.nulls import blank_to_null, if_else, is_in, not_in, paste
from traitloom.functions.numeric import convert_unit, convert_value, is_number, to_number
from traitloom.functions.recode import (
    decode_month,
    label,
    override_equal,
    override_in,
    recode,
    recode_from_table,
)
from traitloom.functions.sources import prefer, prefer_with_source
from traitloom.functions.text import (
    always_with_unit,
    detect_first,
    detect_or_else,
    source_label,
    title_case,
    with_unit,
)
from traitloom.plans.spec import DEFAULT_SPEC


@query(
    "sc_recode_map",
    f"""WITH {RECORDS_SQL} SELECT "OrigValueStr", CASE "OrigValueStr"
        WHEN 'disk flowers with nectar ± hidden in centre of flower' THEN 'disk flowers with nectar hidden in centre of flower'
        WHEN 'other|polygamodioecy' THEN 'other/polygamodioecy' ELSE "OrigValueStr" END AS fixed, "DataName" FROM records""",
)
def sc_recode_map(spark, sf_dir):
    fixed = recode(F.col("OrigValueStr"), DEFAULT_SPEC.value_fixes).alias("fixed")
    return records(spark, sf_dir).select("OrigValueStr", fixed, "DataName")


@query(
    "sc_recode_table",
    """SELECT c_custkey, coalesce(r_name, CAST(c_nationkey AS STRING)) AS nation, c_acctbal FROM customer
    LEFT JOIN region ON c_nationkey = r_regionkey""",
)
def sc_recode_table(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CAST(c_nationkey AS STRING) AS nation", "c_acctbal"
    )
    # Five codes have a name, the others stay as they are.
    mapping = table(spark, sf_dir, "region").selectExpr("CAST(r_regionkey AS STRING) AS code", "r_name")
    return recode_from_table(customers, "nation", mapping, "code", "r_name")


@query(
    "sc_month_decode",
    f"""WITH {RECORDS_SQL} SELECT "OrigValueStr", "OrigUnitStr", CASE WHEN "OrigUnitStr" = 'month' THEN
        CASE "OrigValueStr" WHEN '1' THEN 'Jan' WHEN '2' THEN 'Feb' WHEN '3' THEN 'Mar' WHEN '4' THEN 'Apr' WHEN '5' THEN 'May'
        WHEN '6' THEN 'Jun' WHEN '7' THEN 'Jul' WHEN '8' THEN 'Aug' WHEN '9' THEN 'Sep' WHEN '10' THEN 'Oct' WHEN '11' THEN 'Nov'
        WHEN '12' THEN 'Dec' ELSE "OrigValueStr" END ELSE "OrigValueStr" END AS decoded FROM records""",
)
def sc_month_decode(spark, sf_dir):
    decoded = decode_month(F.col("OrigValueStr"), F.col("OrigUnitStr")).alias("decoded")
    return records(spark, sf_dir).select("OrigValueStr", "OrigUnitStr", decoded)


@query(
    "sc_label_map",
    f"""WITH {RECORDS_SQL} SELECT "DataName", CASE "DataName" WHEN 'Flowering season' THEN 'flowering_season'
        WHEN 'Dicliny (monoeceous, dioecious, hermaphrodite)' THEN 'flower_sexual_system'
        WHEN 'Plant life form (Raunkiaer life form)' THEN 'plant_life_form'
        WHEN 'Fruit/Seed Persistence' THEN 'fruit_seed_persist' WHEN 'Fruit type' THEN 'fruit_type'
        WHEN 'Flower: pollinator and type of reward' THEN 'pollinator' END AS text_trait,
        CASE "DataName" WHEN 'Flowering season' THEN 'flowering_season' WHEN 'Seed dry mass' THEN 'seed_dry_mass'
        WHEN 'Seed mass' THEN 'seed_mass' WHEN 'Plant lifespan (longevity) max' THEN 'plant_lifespan'
        WHEN 'Plant life form (Raunkiaer life form)' THEN 'plant_life_form' END AS number_trait FROM records""",
)
def sc_label_map(spark, sf_dir):
    name = F.col("DataName")
    return records(spark, sf_dir).select(
        name,
        label(name, DEFAULT_SPEC.text_traits).alias("text_trait"),
        label(name, DEFAULT_SPEC.number_traits).alias("number_trait"),
    )


@query("sc_lower", "SELECT doc_id, lower(source) AS source, lower(text) AS text FROM documents")
def sc_lower(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.lower("source").alias("source"), F.lower("text").alias("text"))


# Numbers in several spellings, and things that only look like numbers.
_SPELLINGS = """CASE o_orderpriority WHEN '1-URGENT' THEN concat(' ', CAST(o_custkey AS STRING), ' ')
    WHEN '2-HIGH' THEN concat(CAST(o_custkey AS STRING), CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'O' THEN '_0' ELSE 'e2' END)
    WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN '.5' WHEN 'O' THEN '5.' ELSE '-1.5E-3' END
    WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'Inf' WHEN 'O' THEN '0x1F' ELSE 'NaN' END
    ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN NULL ELSE '1,5' END END"""


@query(
    "sc_try_numeric",
    f"""SELECT o_orderkey, v, {IS_NUMBER.format('v')} AS numeric_text,
    {TO_NUMBER.format('v')} AS number
    FROM (SELECT o_orderkey, {_SPELLINGS} AS v FROM orders)""",
)
def sc_try_numeric(spark, sf_dir):
    spelled = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SPELLINGS).alias("v"))
    return spelled.select("o_orderkey", "v", is_number(F.col("v")).alias("numeric_text"), to_number(F.col("v")).alias("number"))


@query(
    "sc_ifelse_3vl",
    """SELECT o_orderkey, CASE WHEN p = '1-URGENT' THEN 'urgent' WHEN NOT p = '1-URGENT' THEN 'other' END AS outcome,
    coalesce(p IN ('1-URGENT', '2-HIGH'), false) AS listed, NOT coalesce(p IN ('1-URGENT', '2-HIGH'), false) AS unlisted
    FROM (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders)""",
)
def sc_ifelse_3vl(spark, sf_dir):
    p = F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')")
    listed = ["1-URGENT", "2-HIGH"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        if_else(p == "1-URGENT", F.lit("urgent"), F.lit("other")).alias("outcome"),
        is_in(p, listed).alias("listed"),
        not_in(p, listed).alias("unlisted"),
    )


@query(
    "sc_provenance",
    f"""WITH {CURATED_SQL} SELECT species, CASE WHEN length("Growth.Habit") > 0 THEN 'field team' END AS habit_source,
    CASE WHEN "Lifespan_yrs" IS NOT NULL THEN 'field team' END AS lifespan_source FROM curated""",
)
def sc_provenance(spark, sf_dir):
    return curated(spark, sf_dir).select(
        "species",
        source_label(F.col("`Growth.Habit`"), "field team").alias("habit_source"),
        source_label(F.col("Lifespan_yrs"), "field team").alias("lifespan_source"),
    )


@query(
    "sc_override",
    """SELECT o_orderkey, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'yes' ELSE o_orderstatus END AS by_list,
    CASE WHEN p = '1-URGENT' OR p = '2-HIGH' THEN 'yes' WHEN NOT (p = '1-URGENT' OR p = '2-HIGH') THEN o_orderstatus END AS by_equality
    FROM (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS p FROM orders)""",
)
def sc_override(spark, sf_dir):
    p = F.expr("nullif(o_orderpriority, '5-LOW')")
    keys, status = ["1-URGENT", "2-HIGH"], F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        override_in(p, keys, "yes", status).alias("by_list"),
        override_equal(p, keys, "yes", status).alias("by_equality"),
    )


@query(
    "sc_coalesce_precedence",
    f"""WITH {CURATED_SQL} SELECT species, coalesce("Lifespan_yrs", {TO_NUMBER.format('"Seed_mass_mg"')}) AS value, coalesce("Flowering_season", "Fruit_seed_persist") AS season,
    coalesce("Lifespan_yrs_REF", "Seed_mass_REF") AS value_ref FROM curated""",
)
def sc_coalesce_precedence(spark, sf_dir):
    return curated(spark, sf_dir).select(
        "species",
        prefer(F.col("Lifespan_yrs"), to_number(F.col("Seed_mass_mg")), "double").alias("value"),
        prefer(F.col("Flowering_season"), F.col("Fruit_seed_persist"), "string").alias("season"),
        prefer(F.col("Lifespan_yrs_REF"), F.col("Seed_mass_REF"), "string").alias("value_ref"),
    )


@query(
    "sc_coalesce_with_source",
    f"""WITH {CURATED_SQL} SELECT species, coalesce("Flowering_season", "Fruit_seed_persist") AS value,
    CASE WHEN "Flowering_season" IS NOT NULL THEN "Flowering_season_REF" WHEN "Fruit_seed_persist" IS NOT NULL
    THEN "Fruit_seed_persist_REF" END AS value_ref FROM curated""",
)
def sc_coalesce_with_source(spark, sf_dir):
    value, source = prefer_with_source(
        F.col("Flowering_season"),
        F.col("Flowering_season_REF"),
        F.col("Fruit_seed_persist"),
        F.col("Fruit_seed_persist_REF"),
        "string",
    )
    return curated(spark, sf_dir).select("species", value.alias("value"), source.alias("value_ref"))


@query(
    "sc_paste_na",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'NA') || ' ' || coalesce(nullif(o_orderpriority, '5-LOW'), 'NA')
    AS pasted FROM orders""",
)
def sc_paste_na(spark, sf_dir):
    pasted = paste(F.expr("nullif(o_orderstatus, 'P')"), F.expr("nullif(o_orderpriority, '5-LOW')"))
    return table(spark, sf_dir, "orders").select("o_orderkey", pasted.alias("pasted"))


@query(
    "sc_suffix_unit",
    f"""WITH {RECORDS_SQL} SELECT "TraitName", "OrigUnitStr",
    CASE WHEN length("OrigUnitStr") = 0 OR "OrigValueStr" IS NULL THEN "TraitName"
    WHEN NOT (length("OrigUnitStr") = 0 OR "OrigValueStr" IS NULL) THEN "TraitName" || '_' || coalesce("OrigUnitStr", 'NA') END AS optional,
    "TraitName" || '_' || coalesce("OrigUnitStr", 'NA') AS always FROM records""",
)
def sc_suffix_unit(spark, sf_dir):
    name, unit, value = F.col("TraitName"), F.col("OrigUnitStr"), F.col("OrigValueStr")
    return records(spark, sf_dir).select(
        name, unit, with_unit(name, unit, value).alias("optional"), always_with_unit(name, unit).alias("always")
    )


@query("sc_blank_to_null", f"""WITH {CURATED_SQL} SELECT species, nullif("Flowering_season", '') AS season FROM curated""")
def sc_blank_to_null(spark, sf_dir):
    return curated(spark, sf_dir).select("species", blank_to_null(F.col("Flowering_season")).alias("season"))


@query(
    "sc_detect_binary",
    """SELECT conv_id, turn, CASE WHEN contains(text, 'the') THEN 'the' WHEN NOT contains(text, 'the') THEN 'none' END AS code
    FROM conversations""",
)
def sc_detect_binary(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", detect_or_else(F.col("text"), "the", "none").alias("code"))


@query(
    "sc_detect_ternary",
    f"""WITH {CURATED_SQL} SELECT species, CASE WHEN "Seed_dispersal_vector" LIKE '%wind%' THEN 'wind'
    WHEN "Seed_dispersal_vector" = 'water' THEN 'water' ELSE 'animal' END AS code FROM curated""",
)
def sc_detect_ternary(spark, sf_dir):
    code = detect_first(F.col("Seed_dispersal_vector"), contains="wind", equals="water", otherwise="animal")
    return curated(spark, sf_dir).select("species", code.alias("code"))


def _title_sql(column: str) -> str:
    """Title case for text whose words are separated by blanks and hyphens only."""
    words = f"""list_transform(string_split({{piece}}, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2)))"""
    inner = "array_to_string(" + words.format(piece="h") + ", ' ')"
    return f"array_to_string(list_transform(string_split({column}, '-'), lambda h: {inner}), '-')"


@query("sc_title_case", f"SELECT o_orderkey, {_title_sql('o_orderpriority')} AS title FROM orders")
def sc_title_case(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", title_case(F.col("o_orderpriority")).alias("title"))


@query(
    "sc_unit_convert",
    f"""WITH {RECORDS_SQL} SELECT "OrigValueStr", "OrigUnitStr", round(CASE WHEN "OrigUnitStr" = 'mg' THEN v / 1000
    WHEN "OrigUnitStr" = '1/lb' THEN v * 2.2 ELSE v END, 6) AS converted, CASE WHEN "OrigUnitStr" IN ('mg', 'gr') THEN 'g'
    WHEN "OrigUnitStr" = '1/lb' THEN '1_per_kg' WHEN "OrigUnitStr" IN ('yr', 'yrs') THEN 'year' WHEN "OrigUnitStr" = 'doy'
    THEN 'day_of_year' ELSE "OrigUnitStr" END AS unit
    FROM (SELECT *, {TO_NUMBER.format('"OrigValueStr"')} AS v FROM records)""",
)
def sc_unit_convert(spark, sf_dir):
    value, unit = to_number(F.col("OrigValueStr")), F.col("OrigUnitStr")
    return records(spark, sf_dir).select(
        "OrigValueStr",
        "OrigUnitStr",
        F.round(convert_value(value, unit, DEFAULT_SPEC.unit_rules), 6).alias("converted"),
        convert_unit(unit, DEFAULT_SPEC.unit_rules).alias("unit"),
    )
