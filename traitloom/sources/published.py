"""Daily snapshots that readers see whole or not at all, whenever they look.

Every publication writes a folder of its own and then one line that points to it. Readers follow the last line of a day, so a
run that fails, or that is still going on, changes nothing, and a reader that began earlier keeps its files.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from traitloom.operators.columns import ref
from traitloom.sources import folders

_POINTER = "day string, number long, version string, schema string"


def _pointers(spark: SparkSession, path: str) -> list:
    """One row for every publication so far, in order."""
    lines = f"{path}/published"
    if not folders.exists(spark, lines):
        return []
    rows = spark.read.schema(_POINTER).json(lines).collect()
    return sorted(rows, key=lambda r: (r["number"], r["version"]))


def _folder(path: str, day: str, version: str) -> str:
    return f"{path}/versions/run_date={day}/version={version}"


def publish(df: DataFrame, path: str, run_date: datetime.date | str) -> str:
    """The rows as the snapshot of a day, in the place of an earlier one; returns the folder they are in."""
    spark = df.sparkSession
    day = run_date if isinstance(run_date, str) else run_date.isoformat()
    datetime.date.fromisoformat(day)
    version = uuid.uuid4().hex
    folder = _folder(path, day, version)
    df.write.parquet(folder)
    number = max([r["number"] for r in _pointers(spark, path)], default=0) + 1
    line = spark.createDataFrame([(day, number, version, df.schema.json())], _POINTER)
    line.coalesce(1).write.mode("append").json(f"{path}/published")
    return folder


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder in force of every day."""
    return {r["day"]: _folder(path, r["day"], r["version"]) for r in _pointers(spark, path)}


def read_published(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """All days, or one, with the day as ``run_date`` (text). The schema is that of the last publication."""
    pointers = _pointers(spark, path)
    if not pointers or day is not None and day not in {r["day"] for r in pointers}:
        raise FileNotFoundError(f"{path} has no published snapshot" + (f" of {day}" if day else ""))
    chosen = [f for d, f in current(spark, path).items() if day in (None, d)]
    schema = StructType.fromJson(json.loads(pointers[-1]["schema"]))
    schema = StructType([*[f for f in schema if f.name != "run_date"], StructField("run_date", StringType())])
    return spark.read.schema(schema).option("basePath", f"{path}/versions").parquet(*chosen).select(*[ref(f.name) for f in schema])


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Deletes the folders that no reader is led to any more; returns how many. Readers that began before may still need them."""
    kept = set(current(spark, path).values())
    old = {_folder(path, r["day"], r["version"]) for r in _pointers(spark, path)} - kept
    found = [folder for folder in sorted(old) if folders.exists(spark, folder)]
    for folder in found:
        folders.delete(spark, folder)
    return len(found)
