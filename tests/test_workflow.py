"""The workflow on files: branches at the landing, outputs for readers outside Spark, options."""

import json

import pytest
from pyspark.sql import functions as F

from traitloom.catalog.views import curated as curated_view
from traitloom.catalog.views import records as records_view
from traitloom.plans import layout
from traitloom.plans.branches import BRANCHES, record_branch
from traitloom.plans.enrich import integrate
from traitloom.plans.numbers import unmapped_numbers, wide_numbers
from traitloom.plans.spec import CURATED_COLUMNS, DEFAULT_SPEC, spec_from_json
from traitloom.plans.text import unmapped_text, wide_text
from traitloom.plans.workflow import run
from traitloom.sources.lossless_csv import read_csv_lossless
from traitloom.sources.readers import read_attributes, read_csv, read_eav_tsv
from traitloom.sources.writers import write_csv_blank, write_eav_tsv

SF = "/root/testdata/sf0.001"


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return write_eav_tsv(records_view(spark, SF), str(tmp_path_factory.mktemp("raw") / "tsv"))


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "table")
    curated_view(spark, SF).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def plain(spark, raw, curated):
    """The jobs straight from the plain readers."""
    records = read_eav_tsv(spark, raw, records_view(spark, SF).schema)
    jobs = {"wide_text": wide_text, "wide_numbers": wide_numbers, "unmapped_text": unmapped_text, "unmapped_numbers": unmapped_numbers}
    tables = {name: job(records) for name, job in jobs.items()}
    tables["integrated"] = integrate(
        read_attributes(spark, curated, CURATED_COLUMNS), tables["wide_text"], tables["wide_numbers"]
    )
    return tables


def test_tables_from_branches_are_those_of_the_jobs(spark, raw, curated, plain, tmp_path):
    out = run(spark, raw, curated, str(tmp_path / "out"), "2022-11-09", file_format="csv_lossless")
    for name, table in plain.items():
        assert same(table, spark.read.schema(table.schema).parquet(f"{out[name]}/run_date=2022-11-09")), name
    for name in ("wide_text", "wide_numbers", "integrated"):
        assert same(plain[name], read_csv_lossless(spark, out[f"{name}_file"])), name
    accounts = {r["entry"]: r["lines"] for r in spark.read.parquet(out["accounts"]).collect()}
    assert accounts["lines"] == accounts["records"] + accounts["rejected"] == records_view(spark, SF).count()
    assert spark.read.parquet(out["rejects"]).count() == accounts["rejected"] == 0
    folders = {f.name for f in (tmp_path / "out" / "records").iterdir() if f.is_dir()}
    assert folders <= {f"branch={b}" for b in BRANCHES} and len(folders) == len(BRANCHES)


def test_stored_entries_give_the_same_tables(spark, raw, curated, plain, tmp_path):
    out = run(spark, raw, curated, str(tmp_path / "out"), "2022-11-09", buckets=5)
    for name, table in plain.items():
        assert same(table, spark.read.schema(table.schema).parquet(f"{out[name]}/run_date=2022-11-09")), name


def test_everything_behind_stored_entries_is_local(spark, tmp_path, capfd):
    """The entries are exchanged when they are stored; pivots, lists and the join of the wide tables are not."""
    records = records_view(spark, SF)
    text = layout.store_text(records, str(tmp_path / "text"), 6)
    numbers = layout.store_numbers(records, str(tmp_path / "numbers"), 6)
    wide, means = layout.stored_wide_text(text), layout.stored_wide_numbers(numbers)
    both = wide.hint("merge").join(means.withColumnRenamed("species", "s"), wide["species"] == F.col("s"), "full")
    results = [wide, means, layout.stored_unmapped_text(text), layout.stored_unmapped_numbers(numbers), both]
    for df in results:
        df.explain("simple")
        shown = capfd.readouterr().out
        assert "Exchange" not in shown and "FileScan" in shown
    species = wide_text(records).select("species").union(wide_numbers(records).select("species")).distinct()
    assert both.count() == species.count() > 0


def test_curated_csv_schema_and_aligned_references(spark, raw, plain, tmp_path):
    table = curated_view(spark, SF)
    curated = write_csv_blank(table, str(tmp_path / "curated"))
    out = run(
        spark, raw, curated, str(tmp_path / "out"), "2022-11-09", curated_schema=table.schema, aligned_references=True, file_format="csv"
    )
    want = integrate(read_attributes(spark, curated, CURATED_COLUMNS, table.schema), plain["wide_text"], plain["wide_numbers"], aligned_references=True)
    got = spark.read.schema(want.schema).parquet(f"{out['integrated']}/run_date=2022-11-09")
    assert got.count() == want.count()
    references = ["species", "Seed_mass_mg", "Seed_mass_REF", "Lifespan_years", "Lifespan_years_REF"]
    assert same(want.select(*references), got)
    wide = read_csv(spark, out["wide_numbers_file"], plain["wide_numbers"].schema, "null")
    assert same(plain["wide_numbers"], wide)
    with pytest.raises(ValueError, match="file_format"):
        run(spark, raw, curated, str(tmp_path / "other"), "2022-11-09", file_format="xlsx")


def test_every_record_has_one_branch_and_one_pattern(spark, capfd):
    tagged = records_view(spark, SF).withColumn("branch", record_branch(DEFAULT_SPEC))
    counts = {r["branch"]: r["count"] for r in tagged.groupBy("branch").count().collect()}
    assert set(counts) == set(BRANCHES)
    tagged.explain("simple")
    assert capfd.readouterr().out.count("RLIKE") == 1


def test_spec_from_json():
    spec = spec_from_json(json.dumps({"trait_ids": [1, 2], "value_fixes": {"a": "b"}, "unit_rules": [["g", "mg", 1000, 1]]}))
    assert spec.trait_ids == (1, 2) and spec.value_fixes == {"a": "b"} and spec.unit_rules[0].to_unit == "mg"
    assert spec.text_columns == DEFAULT_SPEC.text_columns
    with pytest.raises(ValueError, match="trait_id"):
        spec_from_json('{"trait_id": [1]}')
