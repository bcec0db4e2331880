"""Queries for grouping, reshaping and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitloom.catalog import sql
from traitloom.catalog.registry import query
from traitloom.catalog.views import FLAGGED_SQL, SITES, flagged, table
from traitloom.operators.aggregates import (
    collapse_text,
    count_by,
    distinct_rows,
    mean_by,
    unique_projected,
)
from traitloom.operators.long_text import collapse_long
from traitloom.operators.profile import (
    frequency_profile,
    frequency_profile_by_flag,
    numeric_profile,
    numeric_profile_by_flag,
)
from traitloom.operators.reshape import (
    collapse_wider,
    mean_wider,
    pivot_longer,
    pivot_wider,
    relabel_columns,
    separate,
)


@query("agg_distinct_rows", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def agg_distinct_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return distinct_rows(lines.unionAll(lines))


@query("agg_unique_projected", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def agg_unique_projected(spark, sf_dir):
    return unique_projected(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"])


# Two text attributes per supplier, as entity, attribute, value.
_ENTRIES_SQL = """entries AS (
    SELECT DISTINCT l_suppkey AS entity, 'flag' AS attribute, concat(l_returnflag, l_linestatus) AS value FROM lineitem
    UNION ALL
    SELECT DISTINCT l_suppkey, nullif('ship_month', CASE WHEN l_returnflag = 'N' THEN 'ship_month' END),
        CAST(month(l_shipdate) AS STRING) FROM lineitem)"""


def _entries(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    flags = lines.select(
        F.col("l_suppkey").alias("entity"),
        F.lit("flag").alias("attribute"),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
    )
    months = lines.select(
        "l_suppkey",
        F.when(F.col("l_returnflag") == "N", None).otherwise("ship_month"),
        F.month("l_shipdate").cast("string"),
    )
    return flags.distinct().unionAll(months.distinct())


@query(
    "agg_string_collapse",
    f"""WITH {_ENTRIES_SQL} SELECT entity, attribute, string_agg(value, '; ' ORDER BY value) AS value_entry
    FROM entries GROUP BY entity, attribute""",
)
def agg_string_collapse(spark, sf_dir):
    return collapse_text(_entries(spark, sf_dir), ["entity", "attribute"], "value")


@query(
    "agg_string_collapse_ordered",
    """SELECT o_custkey, o_orderstatus,
    string_agg(coalesce(nullif(o_orderpriority, '5-LOW'), 'NA'), '; ' ORDER BY o_orderkey) AS value_entry
    FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def agg_string_collapse_ordered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return collapse_text(orders, ["o_custkey", "o_orderstatus"], "priority", order_by=["o_orderkey"])


@query(
    "agg_mean",
    """SELECT l_partkey, l_returnflag, round(avg(nullif(l_quantity, 50)), 6) AS value_entry FROM lineitem
    GROUP BY l_partkey, l_returnflag""",
)
def agg_mean(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("quantity", F.expr("nullif(l_quantity, 50)"))
    means = mean_by(lines, ["l_partkey", "l_returnflag"], "quantity")
    return means.withColumn("value_entry", F.round("value_entry", 6))


@query(
    "agg_count_null_group",
    """SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, CAST(count(*) AS BIGINT) AS count FROM lineitem
    GROUP BY 1, 2""",
)
def agg_count_null_group(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("flag", F.expr("nullif(l_returnflag, 'N')"))
    return count_by(lines, ["flag", "l_linestatus"])


@query(
    "rsh_pivot_string",
    f"""WITH {_ENTRIES_SQL}, collapsed AS (
        SELECT entity, coalesce(attribute, 'NA') AS attribute, string_agg(value, '; ' ORDER BY value) AS v
        FROM entries GROUP BY 1, 2)
    SELECT entity, max(CASE WHEN attribute = 'flag' THEN v END) AS flag,
    max(CASE WHEN attribute = 'ship_month' THEN v END) AS ship_month,
    max(CASE WHEN attribute = 'NA' THEN v END) AS "NA",
    max(CASE WHEN attribute = 'absent' THEN v END) AS absent FROM collapsed GROUP BY entity""",
)
def rsh_pivot_string(spark, sf_dir):
    collapsed = collapse_text(_entries(spark, sf_dir), ["entity", "attribute"], "value")
    return pivot_wider(collapsed, "entity", "attribute", "value_entry", ["flag", "ship_month", "NA", "absent"])


@query(
    "rsh_collapse_wide",
    f"""WITH {_ENTRIES_SQL} SELECT entity,
    string_agg(value, '; ' ORDER BY value) FILTER (WHERE attribute = 'flag') AS flag,
    string_agg(value, '; ' ORDER BY value) FILTER (WHERE attribute = 'ship_month') AS ship_month,
    string_agg(value, '; ' ORDER BY value) FILTER (WHERE attribute IS NULL) AS "NA"
    FROM entries GROUP BY entity""",
)
def rsh_collapse_wide(spark, sf_dir):
    return collapse_wider(_entries(spark, sf_dir), "entity", "attribute", "value", ["flag", "ship_month", "NA"])


@query(
    "agg_collapse_long",
    """WITH lines AS (
        SELECT l_returnflag AS mode, concat(coalesce(l_linestatus, ''), ' ', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING)) AS v
        FROM lineitem
    ), counted AS (
        SELECT mode, v, count(*) AS n FROM lines GROUP BY mode, v
    ), placed AS (
        SELECT mode, v, n, sum(n * (strlen(v) + 2)) OVER (PARTITION BY mode ORDER BY v ROWS UNBOUNDED PRECEDING) AS upto FROM counted
    )
    SELECT mode, CAST(floor((upto - 1) / 20000) AS BIGINT) AS piece,
    string_agg(array_to_string([v FOR x IN range(n)], '; '), '; ' ORDER BY v) AS text FROM placed GROUP BY 1, 2""",
)
def agg_collapse_long(spark, sf_dir):
    """Three groups hold all lines; pieces of 20 kB."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS mode",
        "concat(coalesce(l_linestatus, ''), ' ', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING)) AS v",
    )
    return collapse_long(lines, ["mode"], "v", piece_bytes=20_000)


_AS_TEXT = "array_join(transform(array_sort(map_entries(other)), e -> concat(e.key, '=', e.value)), '|')"


@query(
    "rsh_pivot_overflow",
    f"""WITH {_ENTRIES_SQL}, collapsed AS (
        SELECT entity, coalesce(attribute, 'NA') AS attribute, string_agg(value, '; ' ORDER BY value) AS v
        FROM entries GROUP BY 1, 2)
    SELECT entity, max(CASE WHEN attribute = 'flag' THEN v END) AS flag,
    coalesce(string_agg(concat(attribute, '=', v), '|' ORDER BY attribute) FILTER (WHERE attribute <> 'flag'), '') AS other
    FROM collapsed GROUP BY entity""",
)
def rsh_pivot_overflow(spark, sf_dir):
    wide = collapse_wider(_entries(spark, sf_dir), "entity", "attribute", "value", ["flag"], unlisted="map")
    return wide.select("entity", "flag", F.expr(_AS_TEXT).alias("other"))


@query(
    "rsh_pivot_mean_overflow",
    """WITH means AS (SELECT l_partkey, l_returnflag AS f, CAST(floor(avg(l_quantity) * 100) AS BIGINT) AS m FROM lineitem GROUP BY 1, 2)
    SELECT l_partkey, max(CASE WHEN f = 'A' THEN m END) AS "A",
    coalesce(string_agg(concat(f, '=', CAST(m AS STRING)), '|' ORDER BY f) FILTER (WHERE f <> 'A'), '') AS other
    FROM means GROUP BY l_partkey""",
)
def rsh_pivot_mean_overflow(spark, sf_dir):
    wide = mean_wider(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", "l_quantity", ["A"], unlisted="map")
    hundredths = F.transform_values("other", lambda _, v: F.floor(v * 100).cast("string"))
    return wide.select("l_partkey", F.floor(F.col("A") * 100).alias("A"), hundredths.alias("other")).select(
        "l_partkey", "A", F.expr(_AS_TEXT).alias("other")
    )


@query(
    "rsh_pivot_mean",
    """SELECT l_partkey, round(avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 6) AS "A",
    round(avg(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 6) AS "N",
    round(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 6) AS "R" FROM lineitem GROUP BY l_partkey""",
)
def rsh_pivot_mean(spark, sf_dir):
    wide = mean_wider(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", "l_quantity", ["A", "N", "R"])
    return wide.select("l_partkey", *[F.round(c, 6).alias(c) for c in ("A", "N", "R")])


@query(
    "rsh_unpivot_keep_null",
    """SELECT o_orderkey, 'status' AS columns, nullif(o_orderstatus, 'P') AS entries FROM orders
    UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS STRING) FROM orders""",
)
def rsh_unpivot_keep_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        "o_custkey",
    )
    return pivot_longer(orders, "o_orderkey")


@query(
    "rsh_roundtrip",
    """SELECT species, name AS new_name, c_acctbal AS new_c_acctbal, c_mktsegment AS new_c_mktsegment FROM (
        SELECT nullif(c_name, 'Customer#000000005') AS species, c_name AS name, c_acctbal, c_mktsegment FROM customer)
    WHERE NOT coalesce(species IN ('Customer#000000001', 'Customer#000000002'), false)""",
)
def rsh_roundtrip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.expr("nullif(c_name, 'Customer#000000005')").alias("species"),
        F.col("c_name").alias("name_"),
        "c_acctbal",
        "c_mktsegment",
    )
    return relabel_columns(
        customers, "new_", drop_keys=["Customer#000000001", "Customer#000000002"], fixes={"name_": "name"}
    )


_NAMES = """CASE o_orderstatus WHEN 'F' THEN concat('Abies alba var. ', o_orderpriority) WHEN 'O' THEN o_orderpriority
    ELSE concat('Abies', CAST(o_custkey AS STRING)) END"""


@query(
    "rsh_separate",
    f"""SELECT o_orderkey, nullif(split_part(full_name, ' ', 1), '') AS genus,
    nullif(split_part(full_name, ' ', 2), '') AS epithet,
    nullif(substr(full_name, length(split_part(full_name, ' ', 1)) + length(split_part(full_name, ' ', 2)) + 3), '') AS extra
    FROM (SELECT o_orderkey, {_NAMES} AS full_name FROM orders)""",
)
def rsh_separate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_NAMES).alias("full_name"))
    return separate(orders, "full_name", ["genus", "epithet", "extra"])


_NUMERIC = ("quantity", "price", "discount")
_CATEGORICAL = ("flag", "status", "line", "ship_month")


_OVERALL = {"": "true"}
_BY_SITE = {site: f'"{site}" = 1' for site in SITES}


@query("stat_quant_overall", f"WITH {FLAGGED_SQL} {sql.numeric_profile('flagged', _NUMERIC, _OVERALL)}")
def stat_quant_overall(spark, sf_dir):
    return numeric_profile(flagged(spark, sf_dir), _NUMERIC)


@query("stat_quant_by_site", f"WITH {FLAGGED_SQL} {sql.numeric_profile('flagged', _NUMERIC, _BY_SITE, 'site')}")
def stat_quant_by_site(spark, sf_dir):
    return numeric_profile_by_flag(flagged(spark, sf_dir), _NUMERIC, SITES)


@query("stat_qual_overall", f"WITH {FLAGGED_SQL} {sql.frequencies('flagged', _CATEGORICAL, _OVERALL)}")
def stat_qual_overall(spark, sf_dir):
    return frequency_profile(flagged(spark, sf_dir), _CATEGORICAL)


@query("stat_qual_by_site", f"WITH {FLAGGED_SQL} {sql.frequencies('flagged', _CATEGORICAL, _BY_SITE, 'site')}")
def stat_qual_by_site(spark, sf_dir):
    return frequency_profile_by_flag(flagged(spark, sf_dir), _CATEGORICAL, SITES)
