"""What the queries on files cost does not sit in one task, nor in work done for every line for the sake of a few."""

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from traitloom.catalog import QUERIES, file_queries
from traitloom.sources.checked import SHORT, checked_lines

HEADER = "TraitID\tAccSpeciesName\tTraitName\tDataName\tOrigValueStr\tOrigUnitStr\tObsID"


def documents(spark, folder, parts=6):
    text = F.concat(F.lit('said "'), F.col("id").cast("string"), F.lit('",\nthen'), F.repeat(F.lit(" more\n"), 40))
    docs = spark.range(0, 60, 1, parts).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.col("id").alias("n_chars")
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    return docs


def test_a_larger_table_goes_to_more_csv_files(spark, tmp_path, monkeypatch):
    docs = documents(spark, str(tmp_path))
    sizes = [f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet")]
    for name, value in (("spark.sql.files.maxPartitionBytes", str(max(sizes) + 1)), ("spark.sql.files.openCostInBytes", str(max(sizes)))):
        spark.conf.set(name, value)
    written = []
    write = file_queries.write_csv_blank
    monkeypatch.setattr(file_queries, "write_csv_blank", lambda df, path: written.append(write(df, path)) or path)
    try:
        whole = sorted(tuple(r) for r in QUERIES["src_csv_multiline"](spark, str(tmp_path)).collect())
        monkeypatch.setattr(file_queries, "_FILE_BYTES", sum(sizes) // 3 + 1)
        cut = sorted(tuple(r) for r in QUERIES["src_csv_multiline"](spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = [len([f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]) for path in written]
    assert files == [1, 3]
    assert whole == cut == sorted((*tuple(r)[:3], "", r["n_chars"]) for r in docs.collect())


def test_lines_are_checked_in_generated_code(spark, tmp_path):
    folder = tmp_path / "raw text é 50%25 #1"
    folder.mkdir()
    (folder / "part 1.txt").write_text(f"{HEADER}\n59\ta\tb\tc\td\te\t1\n59\tshort\n")
    lines = checked_lines(spark, str(folder))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        lines.explain("simple")
    operators = [line for line in shown.getvalue().split("\n") if re.search(r"\b(Project|Filter|FileScan)\b", line)]
    assert operators and all("*(" in line or "FileScan" in line for line in operators)
    # The name of the file is asked for where a line is rejected, the same name as Spark's own column gives.
    assert "_metadata" not in shown.getvalue()
    want = spark.read.text(str(folder)).select("_metadata.file_path").first()[0]
    assert [tuple(r) for r in lines.filter("reason is not null").select("file", "reason").collect()] == [(want, SHORT)]
