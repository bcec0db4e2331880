"""What the plans look like: these hold whatever the size of the data."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from traitloom.catalog import QUERIES
from traitloom.operators.filters import drop_in
from traitloom.operators.joins import left_enrich, left_enrich_all
from traitloom.operators.profile import frequency_profile_by_flag, numeric_profile, numeric_profile_by_flag
from traitloom.operators.reshape import relabel_columns
from traitloom.plans.numbers import wide_numbers
from traitloom.plans.text import wide_text

SF = "/root/testdata/sf0.001"
RAW = "TraitID int, AccSpeciesName string, TraitName string, DataName string, OrigValueStr string, OrigUnitStr string, ObsID string, More string"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def count(df, pattern):
    return len(re.findall(pattern, plan(df, "simple")))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "records")
    row = (59, "Abies alba", "t", "Plant life span", "annual", "", "1", "more")
    spark.createDataFrame([row], RAW).write.parquet(path)
    return spark.read.parquet(path)


def test_text_job_prunes_and_pushes(raw):
    shown = plan(wide_text(raw))
    assert "ReadSchema: struct<TraitID:int,AccSpeciesName:string,DataName:string,OrigValueStr:string,OrigUnitStr:string>" in shown
    assert re.search(r"PushedFilters: \[.*In\(TraitID", shown)
    assert count(wide_text(raw), "Exchange ") == 2 and count(wide_text(raw), "rangepartitioning") == 0


def test_number_job_has_two_shuffles(raw):
    df = wide_numbers(raw)
    assert re.search(r"PushedFilters: \[.*In\(TraitID", plan(df))
    assert count(df, "Exchange ") == 2


def test_negated_membership_reaches_the_scan(raw):
    assert re.search(r"PushedFilters: \[Or\(IsNull\(DataName\),Not\(In\(DataName", plan(drop_in(raw, "DataName", ["a", "b"])))


def test_relabelling_is_not_a_shuffle(raw):
    assert count(relabel_columns(raw, "p_", key="ObsID", drop_keys=["x"]), "Exchange") == 0


def test_profiles_read_the_table_once(raw):
    flags = ["TraitID"]
    for df in (
        numeric_profile(raw, ["TraitID"]),
        frequency_profile_by_flag(raw, ["DataName", "TraitName", "OrigUnitStr"], flags),
    ):
        assert count(df, "FileScan") == 1 and count(df, "Exchange ") == 1


def test_numeric_profile_by_flag_folds_rows_by_mask_and_repeats_none(raw):
    """One scan, nothing between it and the aggregation by mask that repeats rows; behind it only states are shuffled."""
    shown = plan(numeric_profile_by_flag(raw.withColumn("v", F.length("More")), ["v"], ["TraitID", "ObsID"]), "simple")
    assert len(re.findall("FileScan", shown)) == 1 and len(re.findall("Exchange ", shown)) == 2
    below = shown[shown.rindex("Exchange ") :]
    assert "partial_var_pop" in below and not re.search("Generate|Expand|Join", below)


def with_conf(spark, settings, action):
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return action()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def sides(spark):
    left = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5000)).alias("species"), "id",
        F.repeat(F.lit("x"), 50).alias("pad"),
    )
    keys = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("species"))
    hot = spark.range(1).select(F.lit("hot").alias("species"))
    right = keys.unionAll(hot)
    return left, right.withColumn("t", F.lit("t")), right.withColumn("n", F.lit(1.0))


def test_small_right_side_is_broadcast_by_size_only(spark):
    left, one, _ = sides(spark)
    assert count(left_enrich(left, one.limit(10)), "BroadcastHashJoin") == 1
    large = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: plan(left_enrich(left, one), "simple"))
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large


def test_hot_key_is_split_and_nothing_is_lost(spark):
    """A third of the rows share a species and the right side is too large to broadcast."""
    left, one, two = sides(spark)

    def action():
        df = left_enrich_all(left, [one, two])
        rows, matched = df.agg(F.count(F.lit(1)), F.count("t")).first()
        out = left_enrich_all(left, [one, two])
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        return rows, matched, plan(out, "simple")

    rows, matched, shown = with_conf(
        spark,
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        },
        action,
    )
    assert (rows, matched) == (200_000, 200_000)
    assert "skew=true" in shown


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_catalog_plan(spark, name):
    """No nested-loop joins, no Python in the data path, no generated method the JVM refuses to compile."""
    df = QUERIES[name](spark, SF)
    shown = plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Window"):
        assert operator not in shown
    code = with_conf(spark, {"spark.sql.adaptive.enabled": "false"}, lambda: plan(QUERIES[name](spark, SF), "codegen"))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert max(sizes, default=0) < 8000
