"""Outputs. Every writer writes in parallel; the path is a folder."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame

from traitloom.sources import folders

_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv_blank(df: DataFrame, path: str) -> str:
    """CSV in which a missing value is an empty field."""
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def write_csv_na(df: DataFrame, path: str) -> str:
    """CSV in which a missing value is the text ``NA``. A real text ``NA`` cannot be told apart: Parquet can."""
    df.write.mode("overwrite").options(**_CSV, nullValue="NA").csv(path)
    return path


def write_eav_tsv(df: DataFrame, path: str) -> str:
    """Records in the form ``read_eav_tsv`` reads."""
    df.write.mode("overwrite").options(
        header=True, sep="\t", encoding="ISO-8859-1", quote="", emptyValue="", nullValue="NA"
    ).csv(path)
    return path


def write_snapshot(
    df: DataFrame, path: str, run_date: datetime.date | str, file_format: str = "parquet", na_text: str = ""
) -> str:
    """Daily snapshot under ``run_date=YYYY-MM-DD``. A rerun replaces that day, also by nothing, and leaves the others.

    The rows are written beside the day and moved into its place when they are whole: a run that fails leaves the day as it was.
    For readers that must never meet a day between two moves see ``published``.
    """
    day = run_date if isinstance(run_date, str) else run_date.isoformat()
    datetime.date.fromisoformat(day)
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.options(**_CSV, nullValue=na_text)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    try:
        writer.format(file_format).save(staged)
    except Exception:
        folders.delete(df.sparkSession, staged)
        raise
    folders.replace(df.sparkSession, staged, f"{path}/run_date={day}")
    return path
