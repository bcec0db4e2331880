"""Moving whole folders, on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _at(spark, folder)
    return files.exists(path)


def delete(spark: SparkSession, folder: str) -> None:
    files, path = _at(spark, folder)
    files.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    files, path = _at(spark, source)
    where = _at(spark, target)[1]
    files.mkdirs(where.getParent())
    if not files.exists(path) or files.exists(where) or not files.rename(path, where):
        raise OSError(f"{source} could not be moved to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """``source`` in the place of ``target``, which is put aside first and put back if the move fails."""
    parent, name = target.rsplit("/", 1)
    aside = f"{parent}/_replaced-{uuid.uuid4().hex}"
    there = exists(spark, target)
    if there:
        move(spark, target, aside)
    try:
        move(spark, source, target)
    except Exception:
        if there and not exists(spark, target):
            move(spark, aside, target)
        raise
    if there:
        delete(spark, aside)
