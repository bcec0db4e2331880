"""Inputs that once lost or changed rows without a word."""

import pytest
from pyspark.sql import functions as F

from traitloom.functions.recode import label
from traitloom.operators.aggregates import collapse_text
from traitloom.operators.reshape import collapse_wider, mean_wider, pivot_wider
from traitloom.plans.records import wanted_records
from traitloom.plans.spec import DEFAULT_SPEC
from traitloom.sources.readers import read_attributes, read_csv, read_eav_tsv
from traitloom.sources.writers import write_csv_blank, write_eav_tsv, write_snapshot

EAV = "TraitID int, AccSpeciesName string, TraitName string, DataName string, OrigValueStr string, OrigUnitStr string"
ROW = (59, "Abies alba", "t", "d", "5", "mg")


def test_empty_rerun_replaces_the_day(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "a int, b string"
    write_snapshot(spark.createDataFrame([(1, "x")], schema), path, "2022-11-08")
    write_snapshot(spark.createDataFrame([(2, "y")], schema), path, "2022-11-09")
    write_snapshot(spark.createDataFrame([], schema), path, "2022-11-09")
    assert [r["a"] for r in spark.read.parquet(path).collect()] == [1]
    assert spark.read.parquet(f"{path}/run_date=2022-11-09").count() == 0


def test_line_breaks_in_quoted_text(spark, tmp_path):
    path, rows = str(tmp_path / "c"), [(1, 'two\nlines, "quoted"'), (2, "one")]
    write_csv_blank(spark.createDataFrame(rows, "id int, text string"), path)
    back = read_csv(spark, path, spark.createDataFrame(rows, "id int, text string").schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_another_column_order_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    write_eav_tsv(spark.createDataFrame([ROW], EAV), path)
    swapped = spark.createDataFrame([ROW], EAV).select(
        "TraitID", "AccSpeciesName", "TraitName", "DataName", "OrigUnitStr", "OrigValueStr"
    )
    with pytest.raises(Exception, match="header"):
        read_eav_tsv(spark, path, swapped.schema).collect()
    assert read_eav_tsv(spark, path, spark.createDataFrame([ROW], EAV).schema).count() == 1


def test_a_required_column_must_be_in_the_csv_file(spark, tmp_path):
    path = str(tmp_path / "a")
    write_csv_blank(spark.createDataFrame([("x", "y")], "species string, other string"), path)
    schema = spark.createDataFrame([("x", "y")], "species string, common string").schema
    with pytest.raises(Exception, match="header"):
        read_attributes(spark, path, ["species", "common"], schema).collect()


def test_the_first_label_wins(spark):
    row = spark.range(1).select(label(F.lit("x"), {"a": ("x",), "b": ("x",)}).alias("l")).first()
    assert row["l"] == "a"


def test_a_value_corrected_to_blank_is_no_value(spark):
    import dataclasses

    spec = dataclasses.replace(DEFAULT_SPEC, value_fixes={**DEFAULT_SPEC.value_fixes, "n/a": ""})
    trait = list(spec.trait_ids)[0]
    rows = [(trait, *ROW[1:4], "n/a", "mg"), (trait, *ROW[1:])]
    assert [r["OrigValueStr"] for r in wanted_records(spark.createDataFrame(rows, EAV), spec).collect()] == ["5"]


def test_pivots_refuse_names_without_a_column_and_repeated_cells(spark):
    df = spark.createDataFrame([("k", "a", "x"), ("k", "a", "y"), ("k", "c", "w")], "k string, n string, v string")
    with pytest.raises(Exception, match="several entries"):
        pivot_wider(df, "k", "n", "v", ["a", "c"]).collect()
    for wide in (pivot_wider, collapse_wider, mean_wider):
        with pytest.raises(Exception, match="names without a column, for example c"):
            wide(df.filter("v <> 'y'").withColumn("v", F.lit("1")), "k", "n", "v", ["a"]).collect()
    assert [tuple(r) for r in collapse_wider(df, "k", "n", "v", ["a"], unlisted="drop").collect()] == [("k", "x; y")]


def test_collapse_takes_two_shuffles_and_reads_its_table_once(spark, tmp_path, capfd):
    rows = [("k", "n", v) for v in ("b", "a", "b", None)]
    spark.createDataFrame(rows, "k string, n string, v string").write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    for out, text in ((collapse_text(df, ["k"], "v"), "NA; a; b; b"), (collapse_wider(df, "k", "n", "v", ["n"]), "NA; a; b; b")):
        capfd.readouterr()
        out.explain()
        shown = capfd.readouterr().out
        assert shown.count("Exchange hashpartitioning") == 2 and "rangepartitioning" not in shown
        assert shown.count("FileScan") == 1
        assert out.first()[1] == text
    assert collapse_wider(df, "k", "n", "v", ["n"], distinct=True).first()["n"] == "NA; a; b"
