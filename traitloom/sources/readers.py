"""Delimited and Parquet inputs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from traitloom.functions.nulls import blank_to_null
from traitloom.operators.columns import ref, require
from traitloom.sources.split_csv import read_csv_split, read_csv_split_inferred

EAV_COLUMNS = ("TraitID", "AccSpeciesName", "TraitName", "DataName", "OrigValueStr", "OrigUnitStr")

EAV_FORMAT = {
    "header": True,
    "sep": "\t",
    "encoding": "ISO-8859-1",
    "quote": "",
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}

# Quotes inside a quoted field are doubled; blanks around a field belong to the value. A quoted text may hold line breaks, so
# Spark does not split a file; for large ones see split_csv. A header that differs from the schema is an error.
CSV_FORMAT = {"header": True, "escape": '"', "multiLine": True, "enforceSchema": False}


def _map_text(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(ref(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else ref(f.name)
            for f in df.schema
        ]
    )


def _blank_is_text(df: DataFrame) -> DataFrame:
    """Blank text is ``""`` and the text ``NA`` is missing. Spark reads a blank field as NULL, so it is put back."""
    return _map_text(df, lambda c: F.nullif(F.coalesce(c, F.lit("")), F.lit("NA")))


def _blank_is_missing(df: DataFrame) -> DataFrame:
    return _map_text(df, lambda c: blank_to_null(F.nullif(c, F.lit("NA"))))


def read_eav_tsv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Raw attribute records: tab-separated, header line, Latin-1, no quoting.

    Give the schema for production runs. Without one the names come from the header line alone (no inference pass): the
    trait id is an integer, everything else text. A blank unit must stay ``""``: it decides the name of the wide column.

    A file whose header differs from the schema is an error. Only where the names are read from a header with a column
    that has no name, which Spark then names itself, are the files not compared.
    """
    reader = spark.read.options(**EAV_FORMAT)
    compare = True
    if schema is None:
        names = reader.csv(path).columns
        compare = not any(n == f"_c{i}" for i, n in enumerate(names))
        schema = StructType(
            [StructField(n, IntegerType() if n == "TraitID" else StringType()) for n in names]
        )
    df = _blank_is_text(reader.option("enforceSchema", not compare).schema(schema).csv(path))
    require(df, EAV_COLUMNS)
    return df


def read_csv(spark: SparkSession, path: str, schema: StructType, blank_text: str = "keep", split: bool = False) -> DataFrame:
    """CSV with a given schema: no inference pass over the data.

    Blank numbers and ``NA`` are NULL. Blank text is ``""`` with ``blank_text="keep"`` and NULL with ``"null"``. With ``split``
    many tasks read a file, which takes one pass more: for large files.
    """
    df = read_csv_split(spark, path, schema) if split else spark.read.options(**CSV_FORMAT).schema(schema).csv(path)
    return _blank_is_text(df) if blank_text == "keep" else _blank_is_missing(df)


def read_csv_inferred(
    spark: SparkSession, path: str, types: Mapping[str, DataType] | None = None, split: bool = False
) -> DataFrame:
    """CSV with inferred types, some of them overridden; blank and ``NA`` are NULL.

    With ``split`` many tasks read a file; the types are then those of ``split_csv.infer_types``.

    The override enters the schema before the rows are read. Casting afterwards would be too late: ``01`` inferred as a
    number has already lost its zero.
    """
    types = types or {}
    if split:
        return read_csv_split_inferred(spark, path, types)
    inferred = spark.read.options(**CSV_FORMAT, inferSchema=True, nullValue="NA").csv(path)
    require(inferred, types)
    schema = StructType([StructField(f.name, types.get(f.name, f.dataType)) for f in inferred.schema])
    return _blank_is_missing(spark.read.options(**CSV_FORMAT, nullValue="NA").schema(schema).csv(path))


def read_attributes(
    spark: SparkSession, path: str, required: Iterable[str], schema: StructType | None = None
) -> DataFrame:
    """Curated attribute table from Parquet, or from CSV when a schema is given; every required column must be there."""
    df = spark.read.parquet(path) if schema is None else spark.read.options(**CSV_FORMAT).schema(schema).csv(path)
    require(df, required)
    return _blank_is_missing(df)
