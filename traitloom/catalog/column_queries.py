"""Queries for choosing, naming and ordering columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitloom.catalog.registry import query
from traitloom.catalog.views import table
from traitloom.operators.columns import (
    drop_prefix,
    drop_strict,
    insert_at,
    keep,
    prefix_names,
    relocate,
    rename_strict,
)


@query("proj_select", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders")
def proj_select(spark, sf_dir):
    return keep(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderkey", "o_totalprice"])


@query("proj_drop_strict", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def proj_drop_strict(spark, sf_dir):
    return drop_strict(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderdate", "o_orderstatus"])


@query(
    "proj_drop_prefix",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate
    FROM lineitem""",
)
def proj_drop_prefix(spark, sf_dir):
    return drop_prefix(table(spark, sf_dir, "lineitem"), "L_LINE")


@query(
    "proj_rename_map",
    'SELECT c_custkey AS key, c_name AS "Customer.Name", c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer',
)
def proj_rename_map(spark, sf_dir):
    return rename_strict(
        table(spark, sf_dir, "customer"), {"c_custkey": "key", "c_name": "Customer.Name", "c_acctbal": "balance"}
    )


@query(
    "proj_prefix_rename",
    """SELECT c_custkey, c_name AS src_name, c_nationkey AS src_c_nationkey, c_acctbal AS src_c_acctbal,
    c_mktsegment AS src_c_mktsegment FROM customer""",
)
def proj_prefix_rename(spark, sf_dir):
    return prefix_names(table(spark, sf_dir, "customer"), "src_", key="c_custkey", fixes={"c_name": "name"})


@query(
    "proj_insert_at",
    """SELECT 'orders' AS origin, o_orderkey, o_custkey, o_orderstatus, o_totalprice / 2 AS half_price, o_totalprice,
    CAST(year(o_orderdate) AS INT) AS order_year, o_orderpriority FROM orders""",
)
def proj_insert_at(spark, sf_dir):
    df = insert_at(table(spark, sf_dir, "orders"), "half_price", F.col("o_totalprice") / 2, before="o_totalprice")
    df = insert_at(df, "order_year", F.year("o_orderdate"), after="o_orderdate")
    df = insert_at(df, "origin", F.lit("orders"))
    return drop_strict(df, ["o_orderdate"])


@query("proj_relocate", "SELECT c_custkey, c_mktsegment, c_acctbal, c_name, c_nationkey FROM customer")
def proj_relocate(spark, sf_dir):
    return relocate(
        table(spark, sf_dir, "customer"), [("c_mktsegment", "c_custkey"), ("c_acctbal", "c_mktsegment")]
    )
