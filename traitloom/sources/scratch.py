"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from traitloom.sources import folders


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared storage the session names in ``spark.checkpoint.dir``.

    Executors on other machines must be able to read it, so a machine-local folder is used only where the setting is
    absent and Spark runs in this very process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="traitloom-")
    folder = f"{base.rstrip('/')}/traitloom-{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


#: Folders this process has named, in order.
_made: list[str] = []


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the intermediate tables this process has made so far; returns how many there were.

    For the end of a job: a DataFrame that still reads one of them cannot be read any more.
    """
    found = 0
    while _made:
        folder = _made.pop()
        if folders.exists(spark, folder):
            folders.delete(spark, folder)
            found += 1
    return found
