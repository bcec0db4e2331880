"""Queries for filters, joins and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitloom.catalog.registry import query
from traitloom.catalog.sql import IS_NUMBER
from traitloom.catalog.views import CURATED_SQL, RECORDS_SQL, curated, records, table
from traitloom.operators.aggregates import mean_by
from traitloom.operators.columns import rename_strict
from traitloom.operators.filters import (
    drop_equal,
    drop_in,
    drop_in_table,
    keep_flagged,
    keep_in,
    keep_nonblank,
)
from traitloom.operators.joins import left_enrich, left_enrich_all
from traitloom.operators.router import tag_numeric
from traitloom.operators.setops import union_by_name, union_tagged


@query("flt_in", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def flt_in(spark, sf_dir):
    return keep_in(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"])


def _orders_with_gaps(spark, sf_dir):
    """Priority: missing where it says not specified, blank where it says low."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '' ELSE o_orderpriority END").alias("priority"),
    )


_GAPS_SQL = """gaps AS (SELECT o_orderkey, o_custkey,
    CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '' ELSE o_orderpriority END AS priority
    FROM orders)"""


@query(
    "flt_not_in_null_safe",
    f"WITH {_GAPS_SQL} SELECT * FROM gaps WHERE NOT coalesce(priority IN ('1-URGENT', '2-HIGH'), false)",
)
def flt_not_in_null_safe(spark, sf_dir):
    return drop_in(_orders_with_gaps(spark, sf_dir), "priority", ["1-URGENT", "2-HIGH"])


@query(
    "flt_not_in_table",
    """SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def flt_not_in_table(spark, sf_dir):
    in_debt = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return drop_in_table(table(spark, sf_dir, "orders"), "o_custkey", in_debt, "c_custkey")


@query("flt_nonblank", f"WITH {_GAPS_SQL} SELECT * FROM gaps WHERE length(priority) > 0")
def flt_nonblank(spark, sf_dir):
    return keep_nonblank(_orders_with_gaps(spark, sf_dir), "priority")


@query("flt_ne", f"WITH {_GAPS_SQL} SELECT * FROM gaps WHERE priority <> '3-MEDIUM'")
def flt_ne(spark, sf_dir):
    return drop_equal(_orders_with_gaps(spark, sf_dir), "priority", "3-MEDIUM")


@query("flt_flag", f'WITH {CURATED_SQL} SELECT species, "Andrews", common FROM curated WHERE "Andrews" = 1')
def flt_flag(spark, sf_dir):
    return keep_flagged(curated(spark, sf_dir).select("species", "Andrews", "common"), "Andrews")


@query(
    "flt_numeric_split",
    f"""WITH {RECORDS_SQL}
    SELECT CASE WHEN {IS_NUMBER.format('"OrigValueStr"')} THEN 'number' ELSE 'text' END AS branch, "DataName", "OrigValueStr", CAST(count(*) AS BIGINT) AS n
    FROM records GROUP BY 1, 2, 3""",
)
def flt_numeric_split(spark, sf_dir):
    both = tag_numeric(records(spark, sf_dir).select("DataName", "OrigValueStr"), "OrigValueStr")
    return both.groupBy("branch", "DataName", "OrigValueStr").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_left_enrich",
    """SELECT c_custkey, c_name, c_acctbal, n_orders, mean_price FROM customer LEFT JOIN (
        SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_orders, round(avg(floor(o_totalprice)), 4) AS mean_price
        FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
)
def join_left_enrich(spark, sf_dir):
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.avg(F.floor("o_totalprice")), 4).alias("mean_price"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return left_enrich(customers, per_customer, "c_custkey")  # the left side has one row per customer


@query(
    "join_left_two_way",
    """WITH parts AS (SELECT l_partkey AS partkey, round(avg(l_quantity), 4) AS mean_quantity FROM lineitem GROUP BY l_partkey)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS partkey, parts.mean_quantity, p_name, p_brand
    FROM lineitem l LEFT JOIN parts ON l.l_partkey = parts.partkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
)
def join_left_two_way(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    means = mean_by(lines, ["l_partkey"], "l_quantity", "mean_quantity")
    means = means.select(F.col("l_partkey").alias("partkey"), F.round("mean_quantity", 4).alias("mean_quantity"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), "p_name", "p_brand")
    left = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("partkey"))
    return left_enrich_all(left, [means, parts], "partkey")


@query(
    "set_union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::INT AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def set_union_by_name(spark, sf_dir):
    customers = rename_strict(
        table(spark, sf_dir, "customer").drop("c_nationkey"),
        {"c_custkey": "key", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    suppliers = rename_strict(
        table(spark, sf_dir, "supplier"),
        {"s_suppkey": "key", "s_name": "name", "s_acctbal": "balance", "s_nationkey": "nation"},
    )
    return union_by_name([customers, suppliers])


@query(
    "set_union_tagged",
    """SELECT 'customer' AS site, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier""",
)
def set_union_tagged(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return union_tagged({"customer": customers, "supplier": suppliers})
