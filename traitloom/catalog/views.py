"""The driver's tables in the shape the jobs expect.

``records`` turns every order into raw attribute records, ``curated`` turns every customer into a curated attribute row,
``flagged`` gives every line item overlapping memberships. A view is one list of expressions that both Spark and the SQL
oracle understand, so both sides start from the same rows; everything after that is written twice.

A third of the records belong to the single species ``Customer NA`` and a fifth have no mapped name: the hot groups the
jobs have to cope with are part of every run.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = datetime.date(2022, 11, 9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- raw records: one order gives fifteen -------------------------------------------------------------------------

_SPECIES = """CASE o_orderstatus
    WHEN 'F' THEN concat('Customer ', CAST(o_custkey AS STRING), ' var. alba')
    WHEN 'O' THEN concat('Customer ', CAST(o_custkey AS STRING))
    ELSE 'Customer' END"""

_SEASON = """CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""

# Whole thousands: means in the target unit are then sums of integers, which no order of addition changes.
_PRICE = "CAST(CAST(floor(o_totalprice / 1000) * 1000 AS BIGINT) AS STRING)"

# TraitID, TraitName, DataName, OrigValueStr, OrigUnitStr; the last two are expressions.
_RECORDS = [
    (335, "Flowering time", "Flowering season", "CAST(month(o_orderdate) AS STRING)", "'month'"),
    (335, "Flowering time", "Flowering season", "CAST(dayofyear(o_orderdate) AS STRING)", "'doy'"),
    (335, "Flowering time", "Flowering season", _SEASON, "''"),
    (
        29,
        "Dicliny",
        "Dicliny (monoeceous, dioecious, hermaphrodite)",
        """CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Not available' WHEN '1-URGENT' THEN 'other|polygamodioecy'
        ELSE o_orderpriority END""",
        "''",
    ),
    (
        26,
        "Seed mass",
        "Seed dry mass",
        _PRICE,
        "CASE o_orderstatus WHEN 'F' THEN 'mg' WHEN 'O' THEN 'gr' ELSE '1/lb' END",
    ),
    (26, "Seed mass", "Seed mass", _PRICE, "'MG'"),
    (59, "Lifespan", "Plant lifespan (longevity) max", "CAST(year(o_orderdate) - 1990 AS STRING)", "'yrs'"),
    (59, "Lifespan", "Plant lifespan (longevity) extreme", "CAST(year(o_orderdate) AS STRING)", "'yr'"),
    (343, "Life form", "Plant life form (Raunkiaer life form)", "substr(o_orderpriority, 1, 1)", "''"),
    (
        2807,
        "Persistence",
        "Fruit/Seed Persistence",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'No' ELSE '' END",
        "''",
    ),
    (
        213,
        "Pollination",
        "Flower: pollinator and type of reward",
        """CASE o_orderstatus WHEN 'F' THEN 'disk flowers with nectar ± hidden in centre of flower'
        WHEN 'O' THEN 'WIND' END""",
        "''",
    ),
    (347, "Phenology", "Plant phenology: Annual", "'yes'", "''"),
    (915, "Fruit", "Fruit type", "o_orderstatus", "'Class'"),
    (205, "Other", "Unlisted name", "o_orderpriority", "CASE o_orderstatus WHEN 'F' THEN NULL ELSE '' END"),
    (1, "Other", "Flowering season", _SEASON, "''"),
]

# Tells two measurements of the same value apart, but not all of them: equal rows do occur.
_OBSERVATION = "o_orderpriority"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(
        f"""struct({trait_id} AS TraitID, '{trait}' AS TraitName, '{name}' AS DataName, {value} AS OrigValueStr,
        {unit} AS OrigUnitStr)"""
        for trait_id, trait, name, value, unit in _RECORDS
    )
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(f"{_SPECIES} AS AccSpeciesName", f"{_OBSERVATION} AS ObsID", f"explode(array({rows})) AS r")
        .select("r.TraitID", "AccSpeciesName", "r.TraitName", "r.DataName", "r.OrigValueStr", "r.OrigUnitStr", "ObsID")
    )


RECORDS_SQL = "records AS (\n" + "\nUNION ALL\n".join(
    f"""SELECT {trait_id} AS TraitID, {_SPECIES} AS AccSpeciesName, '{trait}' AS TraitName, '{name}' AS DataName,
    {value} AS OrigValueStr, {unit} AS OrigUnitStr, {_OBSERVATION} AS ObsID FROM orders"""
    for trait_id, trait, name, value, unit in _RECORDS
) + ")"


# --- curated attributes: one row per customer ------------------------------------------------------------------------

_CURATED = {
    "species": "CASE WHEN c_custkey = 0 THEN 'Customer NA' ELSE concat('Customer ', CAST(c_custkey AS STRING)) END",
    "common": "c_name",
    "included_in_data": "CASE WHEN c_nationkey = 3 THEN 0 WHEN c_nationkey = 4 THEN CAST(NULL AS INT) ELSE 1 END",
    "Andrews": "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN CAST(NULL AS INT) ELSE 0 END",
    "Adirondack": "CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END",
    "CedarCreek": "CASE WHEN c_nationkey < 10 THEN 1 ELSE 0 END",
    "HubbardBrook": "CASE WHEN c_nationkey BETWEEN 5 AND 15 THEN 1 ELSE 0 END",
    "Coweeta": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
    "Harvard": "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 1 ELSE 0 END",
    "Bonanza": "0",
    "Sevilleta": "CASE WHEN c_acctbal BETWEEN 0 AND 1000 THEN 1 ELSE 0 END",
    "Luquillo": "1",
    "Lifespan_yrs": "CASE WHEN c_nationkey < 12 THEN CAST(c_nationkey AS DOUBLE) END",
    "Lifespan_yrs_REF": "CASE WHEN c_nationkey < 9 THEN 'field guide' END",
    "Seed_mass_mg": "CASE WHEN c_acctbal > 0 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) ELSE 'unknown' END",
    "Seed_mass_REF": "CASE WHEN c_acctbal > 2000 THEN 'seed handbook' END",
    "Seeds_per_lb": "CAST(c_nationkey AS DOUBLE)",
    "Seeds_per_lb_REF": "'seed handbook'",
    "Seed_development_2yrsOR3yrs": "CASE WHEN c_nationkey < 5 THEN '1' WHEN c_nationkey < 10 THEN '2or3' WHEN c_nationkey < 15 THEN '01' END",
    "Seed_development_2yrsOR3yrs_REF": "CASE WHEN c_nationkey < 10 THEN 'field guide' END",
    "Seed_dispersal_vector": "CASE c_mktsegment WHEN 'BUILDING' THEN 'gravity, wind' WHEN 'MACHINERY' THEN 'water' WHEN 'HOUSEHOLD' THEN 'birds' END",
    "Pollinator_vector": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'wind' WHEN 'MACHINERY' THEN 'bees' WHEN 'FURNITURE' THEN 'wind, bees' END",
    "Mycorrhiza_AM_EM": "CASE WHEN c_nationkey < 12 THEN 'AM' ELSE 'EM' END",
    "Needleleaf_Broadleaf": "CASE WHEN c_acctbal < 4000 THEN 'B' ELSE 'N' END",
    "Deciduous_Evergreen_yrs": "CASE WHEN c_nationkey < 20 THEN 'D' END",
    "Seed_Maturation_Phenology": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Aug-Sep' ELSE 'Oct' END",
    "Seed_Maturation_Phenology_REF": "CASE c_mktsegment WHEN 'BUILDING' THEN 'field guide' END",
    "Seed_Maturation_Code": "CASE c_mktsegment WHEN 'BUILDING' THEN '2' ELSE '3' END",
    "Monoecious_or_Dioecious": "CASE WHEN c_nationkey < 6 THEN 'dioecious' ELSE 'monoecious' END",
    "Monoecious.or.Dioecious_REF": "'field guide'",
    "Shade_tolerance": "CASE c_mktsegment WHEN 'BUILDING' THEN 'semi-tolerant' WHEN 'MACHINERY' THEN 'INTOLERANT' WHEN 'FURNITURE' THEN 'very tolerant' END",
    "GrowthForm": "CASE WHEN c_nationkey < 13 THEN 'tree' ELSE 'shrub' END",
    "GrowthForm_REF": "'field guide'",
    "Growth.Habit": "CASE WHEN c_nationkey < 7 THEN 'erect' WHEN c_nationkey < 9 THEN '' END",
    "Flowering_season": "CASE WHEN c_nationkey < 6 THEN 'spring' WHEN c_nationkey < 9 THEN '' END",
    "Flowering_season_REF": "CASE WHEN c_nationkey < 5 THEN 'field guide' END",
    "Fruit_seed_persist": "CASE WHEN c_nationkey > 20 THEN 'no' END",
    "Fruit_seed_persist_REF": "CASE WHEN c_nationkey > 18 THEN 'field guide' END",
    "Fleshy_fruit": "CASE WHEN c_acctbal < 3000 THEN 'yes' ELSE 'no' END",
    "Fleshy_fruit_REF": "'field guide'",
    "Dispersal_syndrome": "CASE c_mktsegment WHEN 'BUILDING' THEN 'abiotic' ELSE 'biotic' END",
    "Dispersal_syndrome_REF": "'field guide'",
}


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS `{name}`" for name, e in _CURATED.items()])


CURATED_SQL = (
    "curated AS (SELECT\n" + ",\n".join(f'{e} AS "{name}"' for name, e in _CURATED.items()) + "\nFROM customer)"
)


# --- memberships: one row per line item ------------------------------------------------------------------------------

_FLAGGED = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "nullif(l_discount, 0)",
    "flag": "nullif(l_returnflag, 'N')",
    "status": "l_linestatus",
    "line": "CAST(l_linenumber AS STRING)",
    "ship_month": "CAST(month(l_shipdate) AS STRING)",
    "AND": "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END",
    "ADK": "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'N' THEN CAST(NULL AS INT) ELSE 0 END",
    "CDR": "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END",
    "HBR": "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END",
    "CWT": "CASE WHEN l_discount = 0 THEN 1 ELSE 0 END",
    "HFR": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
    "BNZ": "0",
    "SEV": "CASE WHEN month(l_shipdate) < 4 THEN 1 ELSE 0 END",
    "LUQ": "1",
}

SITES = ("AND", "ADK", "CDR", "HBR", "CWT", "HFR", "BNZ", "SEV", "LUQ")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS `{name}`" for name, e in _FLAGGED.items()])


FLAGGED_SQL = (
    "flagged AS (SELECT\n" + ",\n".join(f'{e} AS "{name}"' for name, e in _FLAGGED.items()) + "\nFROM lineitem)"
)
