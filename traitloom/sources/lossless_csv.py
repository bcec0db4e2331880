"""CSV that comes back as it went out: missing and blank texts apart, line breaks kept, types known.

A missing value is ``\\N``, as in database dumps. In texts a backslash and the line ends are written as ``\\\\``, ``\\n`` and
``\\r``, so that a record is always one line and Spark may split the files anywhere. The schema stands beside the data.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructField, StructType, TimestampType, VariantType

from traitloom.operators.columns import ref

_FORMAT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_MISSING = "\\N"
_SCHEMA = "_schema"


def _out(column: Column, kind: DataType) -> Column:
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        raise ValueError(f"a CSV field cannot hold {kind.simpleString()}")
    if isinstance(kind, BinaryType):
        text = F.base64(column)
    elif isinstance(kind, TimestampType):
        text = F.unix_micros(column).cast("string")  # an instant; the same whatever time zone reads it
    else:
        text = column.cast("string")
    if isinstance(kind, StringType):
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        text = F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.coalesce(text, F.lit(_MISSING))


def _back(column: Column, kind: DataType) -> Column:
    text = F.coalesce(column, F.lit(""))
    value = F.when(text != _MISSING, text)
    if isinstance(kind, StringType):
        # Pieces between doubled backslashes hold single ones only before n and r.
        pieces = F.transform(
            F.split(value, r"\\\\", -1),
            lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
        )
        return F.array_join(pieces, "\\")
    if isinstance(kind, BinaryType):
        return F.unbase64(value)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(value.cast("long"))
    return value.cast(kind)


def write_csv_lossless(df: DataFrame, path: str) -> str:
    fields = [_out(ref(f.name), f.dataType).alias(f.name) for f in df.schema]
    df.select(*fields).write.mode("overwrite").options(**_FORMAT).csv(path)
    schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "json string")
    schema.coalesce(1).write.mode("overwrite").text(f"{path}/{_SCHEMA}")
    return path


def read_csv_lossless(spark: SparkSession, path: str) -> DataFrame:
    """The rows and types that were written; the order of rows is not kept. Header lines must have the names of the schema."""
    schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/{_SCHEMA}").first()["value"]))
    texts = StructType([StructField(f.name, StringType()) for f in schema])
    raw = spark.read.options(**_FORMAT, enforceSchema=False).schema(texts).csv(path)
    return raw.select(*[_back(ref(f.name), f.dataType).alias(f.name) for f in schema])

