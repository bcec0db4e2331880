"""Queries that write whole tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from traitloom.catalog.registry import query
from traitloom.catalog.views import CURATED_SQL, RECORDS_SQL, RUN_DATE, curated, records, table
from traitloom.plans.spec import CURATED_COLUMNS
from traitloom.sources.checked import LONG, NOT_WHOLE, SHORT, checked_lines, land_checked
from traitloom.sources.lossless_csv import read_csv_lossless, write_csv_lossless
from traitloom.sources.published import publish, read_published
from traitloom.sources.readers import EAV_FORMAT, read_attributes, read_csv, read_csv_inferred, read_eav_tsv
from traitloom.sources.scratch import scratch_folder
from traitloom.sources.writers import write_csv_blank, write_csv_na, write_eav_tsv, write_snapshot


@query(
    "src_tsv_latin1",
    f"""WITH {RECORDS_SQL} SELECT "TraitID", "AccSpeciesName", "TraitName", "DataName", nullif("OrigValueStr", 'NA') AS "OrigValueStr",
    "OrigUnitStr", "ObsID" FROM records""",
)
def src_tsv_latin1(spark, sf_dir):
    raw = records(spark, sf_dir)
    return read_eav_tsv(spark, write_eav_tsv(raw, scratch_folder(spark, "records")), raw.schema)


# What is done to some of the records before they are written: the line that comes of it, and why it cannot be read.
_SPOILT = {
    "whole with a point": ("TraitID = 59 AND ObsID = '1-URGENT'", None),
    "no number": ("TraitID = 26 AND ObsID = '2-HIGH'", NOT_WHOLE),
    "short": ("TraitID = 343 AND ObsID = '3-MEDIUM'", SHORT),
    "long": ("TraitID = 915 AND ObsID = '5-LOW'", LONG),
}
_FIELDS = ("AccSpeciesName", "TraitName", "DataName", "OrigValueStr", "OrigUnitStr")
_ID = "concat(CAST(TraitID AS STRING), CASE spoilt WHEN 'whole with a point' THEN '.0' WHEN 'no number' THEN 'x' ELSE '' END)"
_TAIL = "CASE spoilt WHEN 'short' THEN '' WHEN 'long' THEN concat('\t', ObsID, '\tmore') ELSE concat('\t', ObsID) END"
_LINE = f"concat({_ID}, " + ", ".join(f"'\t', coalesce({f}, 'NA')" for f in _FIELDS) + f", {_TAIL})"
_CHOICE = "CASE " + " ".join(f"WHEN {when} THEN '{name}'" for name, (when, _) in _SPOILT.items()) + " ELSE '' END"
_REASON = "CASE spoilt " + " ".join(f"WHEN '{name}' THEN '{why}'" for name, (_, why) in _SPOILT.items() if why) + " END"


def _lines_of(spark, sf_dir):
    """A folder of raw text, some of its lines spoilt; every part starts with the header."""
    lines = records(spark, sf_dir).selectExpr("*", f"{_CHOICE} AS spoilt")
    header = "\t".join(["TraitID", *_FIELDS, "ObsID"])
    path = scratch_folder(spark, "lines")
    whole_lines = {"sep": "\x01", "quote": "", "header": True, "encoding": EAV_FORMAT["encoding"], "emptyValue": ""}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.select(F.expr(_LINE).alias(header)).write.options(**whole_lines, **kept).csv(path)
    return path


@query(
    "src_tsv_rejects",
    f"""WITH {RECORDS_SQL}, tagged AS (SELECT *, {_CHOICE} AS spoilt FROM records),
    lines AS (SELECT *, {_LINE} AS line, {_REASON} AS reason FROM tagged)
    SELECT reason, CASE WHEN reason IS NOT NULL THEN line END AS line, CASE WHEN reason IS NULL THEN "TraitID" END AS trait_id,
    CASE WHEN reason IS NULL THEN "DataName" END AS data_name, CASE WHEN reason IS NULL THEN nullif("OrigValueStr", 'NA') END AS value,
    CASE WHEN reason IS NULL THEN "ObsID" END AS obs_id, CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY ALL""",
)
def src_tsv_rejects(spark, sf_dir):
    landed = land_checked(checked_lines(spark, _lines_of(spark, sf_dir)), scratch_folder(spark, "landed"))
    nothing = F.lit(None).cast("string")
    read = landed.records.select(
        nothing.alias("reason"),
        nothing.alias("line"),
        F.col("TraitID").alias("trait_id"),
        F.col("DataName").alias("data_name"),
        F.col("OrigValueStr").alias("value"),
        F.col("ObsID").alias("obs_id"),
    )
    unread = landed.rejects.select("reason", "line")
    both = read.unionByName(unread, allowMissingColumns=True)
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("n"))


_ORDER_COLUMNS = """o_orderkey, o_custkey, {status} AS status, o_totalprice, {priority} AS priority"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.expr("nullif(o_totalprice, 0)").alias("o_totalprice"),
        F.expr("CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'said \"now\", twice' ELSE o_orderpriority END").alias("priority"),
    )


_PRIORITY_SQL = "CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'said \"now\", twice' ELSE o_orderpriority END"


@query(
    "src_csv",
    f"""SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderstatus, 'P'), '') AS status, o_totalprice,
    {_PRIORITY_SQL} AS priority FROM orders""",
)
def src_csv(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return read_csv(spark, write_csv_blank(orders, scratch_folder(spark, "orders")), orders.schema)


#: Bytes of the table that go into one CSV file: several ranges, whatever the size of the table.
_FILE_BYTES = 256 << 20


def _files_for(docs):
    """In how many files the rows of a stored table are written."""
    files = docs.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size").alias("size")).first()["size"] or 0
    return max(1, -(-size // _FILE_BYTES))


@query(
    "src_csv_multiline",
    """SELECT doc_id, coalesce(nullif(text, 'NA'), '') AS text, coalesce(nullif(lang, 'NA'), '') AS lang,
    coalesce(nullif(source, 'NA'), '') AS source, n_chars FROM documents""",
)
def src_csv_multiline(spark, sf_dir):
    """All texts in few large files; their ranges are read by many tasks, most of them beginning within a quoted text."""
    whole = table(spark, sf_dir, "documents")
    docs = whole.select("doc_id", "text", "lang", "source", "n_chars")
    path = write_csv_blank(docs.coalesce(_files_for(whole)), scratch_folder(spark, "documents"))
    return read_csv(spark, path, docs.schema, split=True)


@query(
    "src_csv_override",
    """SELECT CAST(s_suppkey AS INT) AS s_suppkey, concat('0', CAST(s_nationkey AS STRING)) AS code,
    nullif(s_acctbal, 0) AS s_acctbal, nullif(s_name, 'Supplier#000000003') AS s_name FROM supplier""",
)
def src_csv_override(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.expr("concat('0', CAST(s_nationkey AS STRING))").alias("code"),
        F.expr("nullif(s_acctbal, 0)").alias("s_acctbal"),
        F.expr("nullif(s_name, 'Supplier#000000003')").alias("s_name"),
    )
    path = write_csv_na(suppliers, scratch_folder(spark, "suppliers"))
    return read_csv_inferred(spark, path, {"code": StringType()})


@query(
    "src_dim_strict",
    f"""WITH {CURATED_SQL} SELECT species, common, included_in_data, "Andrews", "Lifespan_yrs", "Seed_mass_mg",
    nullif("Growth.Habit", '') AS growth_habit, nullif("Flowering_season", '') AS "Flowering_season" FROM curated""",
)
def src_dim_strict(spark, sf_dir):
    path = scratch_folder(spark, "curated")
    curated(spark, sf_dir).write.parquet(path)
    return read_attributes(spark, path, CURATED_COLUMNS).select(
        "species",
        "common",
        "included_in_data",
        "Andrews",
        "Lifespan_yrs",
        "Seed_mass_mg",
        F.col("`Growth.Habit`").alias("growth_habit"),
        "Flowering_season",
    )


@query(
    "sink_csv_blank_null",
    f"""SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice,
    nullif({_PRIORITY_SQL}, '') AS priority FROM orders""",
)
def sink_csv_blank_null(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    path = write_csv_blank(orders, scratch_folder(spark, "orders"))
    return read_csv(spark, path, orders.schema, blank_text="null")


@query(
    "sink_csv_na_text",
    f"""SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_custkey AS STRING) AS o_custkey,
    coalesce(nullif(o_orderstatus, 'P'), 'NA') AS status, {_PRIORITY_SQL} AS priority FROM orders""",
)
def sink_csv_na_text(spark, sf_dir):
    orders = _orders(spark, sf_dir).drop("o_totalprice")
    path = write_csv_na(orders, scratch_folder(spark, "orders"))
    # Read as plain text: the fields as they are in the file.
    as_text = StructType([StructField(name, StringType()) for name in orders.columns])
    return spark.read.options(header=True, escape='"').schema(as_text).csv(path).fillna("")


@query(
    "sink_csv_lossless",
    f"""SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, nullif(o_totalprice, 0) AS o_totalprice,
    {_PRIORITY_SQL} AS priority, o_orderdate FROM orders""",
)
def sink_csv_lossless(spark, sf_dir):
    """Missing and blank texts, and the types, as they went out."""
    orders = _orders(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return read_csv_lossless(spark, write_csv_lossless(orders, scratch_folder(spark, "orders")))


@query(
    "sink_documents_lossless",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def sink_documents_lossless(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return read_csv_lossless(spark, write_csv_lossless(docs, scratch_folder(spark, "documents")))


@query(
    "sink_published",
    """SELECT c_custkey AS key, c_name AS name, '2022-11-09' AS run_date FROM customer
    UNION ALL SELECT s_suppkey, s_name, '2022-11-10' FROM supplier""",
)
def sink_published(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    path = scratch_folder(spark, "published")
    for rows, day in ((customers, RUN_DATE), (customers, "2022-11-10"), (suppliers, "2022-11-10")):
        publish(rows, path, day)
    return read_published(spark, path)


@query(
    "sink_dated_snapshot",
    """SELECT c_custkey AS key, c_name AS name, '2022-11-09' AS run_date FROM customer
    UNION ALL SELECT s_suppkey, s_name, '2022-11-10' FROM supplier""",
)
def sink_dated_snapshot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    path = scratch_folder(spark, "snapshot")
    write_snapshot(customers, path, RUN_DATE)
    write_snapshot(customers, path, "2022-11-10")
    write_snapshot(suppliers, path, "2022-11-10")  # the rerun replaces its own day only
    schema = StructType([*customers.schema.fields, StructField("run_date", StringType())])
    return spark.read.schema(schema).parquet(path)
