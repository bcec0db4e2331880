"""All four jobs on files, for ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.plans.branches import BRANCHES, NUMBER, NUMBER_OTHER, TEXT, TEXT_OTHER, record_branch
from traitloom.plans.enrich import integrate
from traitloom.plans.layout import (
    store_numbers,
    store_text,
    stored_unmapped_numbers,
    stored_unmapped_text,
    stored_wide_numbers,
    stored_wide_text,
)
from traitloom.plans.numbers import unmapped_numbers, wide_numbers
from traitloom.plans.spec import CURATED_COLUMNS, DEFAULT_SPEC, TraitSpec, spec_from_json
from traitloom.plans.stats import write_profiles
from traitloom.plans.text import unmapped_text, wide_text
from traitloom.session import CLUSTER_SETTINGS, SETTINGS
from traitloom.sources.checked import Landed, checked_lines, land_checked
from traitloom.sources.lossless_csv import write_csv_lossless
from traitloom.sources.readers import read_attributes
from traitloom.sources.writers import write_csv_blank, write_csv_na, write_snapshot


def land_records(raw: DataFrame, path: str, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """Parse the text file once: wanted traits to Parquet, where both wrangling jobs read only what they need."""
    raw.filter(F.col("TraitID").isin(list(spec.trait_ids))).write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(raw.schema).parquet(path)


def land_raw(spark: SparkSession, raw_path: str, path: str, schema: StructType | None = None, spec: TraitSpec = DEFAULT_SPEC) -> Landed:
    """The text file read once, with an account of every line: wanted traits by the job that uses them, lines that could not be
    read, and counts."""
    checked = checked_lines(spark, raw_path, schema)
    return land_checked(checked, path, F.col("TraitID").isin(list(spec.trait_ids)), record_branch(spec), BRANCHES)


#: How the tables for readers outside Spark are written, beside the Parquet folders: a missing value is a blank field, the text
#: ``NA``, or told apart from a blank text.
FILE_FORMATS = {"csv": write_csv_blank, "csv_na": write_csv_na, "csv_lossless": write_csv_lossless}


def run(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    out: str,
    run_date: datetime.date | str,
    raw_schema: StructType | None = None,
    spec: TraitSpec = DEFAULT_SPEC,
    curated_schema: StructType | None = None,
    aligned_references: bool = False,
    file_format: str = "parquet",
    buckets: int = 0,
) -> dict[str, str]:
    """Raw records and curated table in, written tables out; returns their folders by name.

    ``rejects`` holds the raw lines that could not be read, ``accounts`` how many lines went where; neither stops the run. With a
    ``curated_schema`` the curated table is CSV. With a ``file_format`` of ``FILE_FORMATS`` the wide tables and the integrated
    one are written once more, under ``out/files``. With ``buckets`` the cleaned entries are stored in that many buckets by
    species first, and everything behind them does without an exchange (``layout``).
    """
    if file_format not in ("parquet", *FILE_FORMATS):
        raise ValueError(f"file_format: {file_format!r} is neither 'parquet' nor one of {sorted(FILE_FORMATS)}")
    day = str(run_date)
    landed = land_raw(spark, raw_path, f"{out}/records", raw_schema, spec)
    part = landed.branches
    text_records, number_records = part[TEXT].unionByName(part[TEXT_OTHER]), part[NUMBER].unionByName(part[NUMBER_OTHER])
    tables = {"rejects": landed.rejects, "accounts": accounts(spark, landed)}
    if buckets:
        text_entries = store_text(text_records, f"{out}/entries/text", buckets, spec)
        means = store_numbers(number_records, f"{out}/entries/numbers", buckets, spec)
        tables |= {
            "wide_text": stored_wide_text(text_entries, spec),
            "wide_numbers": stored_wide_numbers(means, spec),
            "unmapped_text": stored_unmapped_text(text_entries, spec),
            "unmapped_numbers": stored_unmapped_numbers(means, spec),
        }
    else:
        tables |= {
            "wide_text": wide_text(text_records, spec),
            "wide_numbers": wide_numbers(number_records, spec),
            "unmapped_text": unmapped_text(part[TEXT_OTHER], spec),
            "unmapped_numbers": unmapped_numbers(part[NUMBER_OTHER], spec),
        }
    written = {name: write_snapshot(table, f"{out}/{name}", day) for name, table in tables.items()}

    def of_day(name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{out}/{name}/run_date={day}")

    text, numbers = (of_day(name, tables[name].schema) for name in ("wide_text", "wide_numbers"))
    curated = read_attributes(spark, curated_path, CURATED_COLUMNS, curated_schema)
    integrated = integrate(curated, text, numbers, spec, aligned_references)
    written["integrated"] = write_snapshot(integrated, f"{out}/integrated", day)
    traits = of_day("integrated", integrated.schema)
    written.update(write_profiles(traits, f"{out}/stats", day, spec))
    if file_format != "parquet":
        for name, table in (("wide_text", text), ("wide_numbers", numbers), ("integrated", traits)):
            written[f"{name}_file"] = FILE_FORMATS[file_format](table, f"{out}/files/{name}/run_date={day}")
    return written


def accounts(spark: SparkSession, landed: Landed) -> DataFrame:
    """``entry, lines``: lines read, records, rejected lines, and the reasons for which lines were set aside."""
    rows = [("lines", landed.lines), ("records", landed.kept), ("rejected", landed.rejected)]
    return spark.createDataFrame(rows + sorted(landed.reasons.items()), "entry string, lines long")


def _schema(path: str | None) -> StructType | None:
    """A schema as in ``CREATE TABLE``, from a text file."""
    if path is None:
        return None
    with open(path) as file:
        return StructType.fromDDL(file.read())


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw", help="raw records, tab-separated")
    parser.add_argument("curated", help="curated attribute table: Parquet, or CSV with --curated-schema")
    parser.add_argument("out", help="output folder")
    parser.add_argument("--run-date", default=datetime.date.today().isoformat())
    parser.add_argument("--raw-schema", help="text file: names and types of the raw columns")
    parser.add_argument("--curated-schema", help="text file: names and types of the curated table's CSV columns")
    parser.add_argument("--spec", help="JSON file: fields of TraitSpec that differ from the defaults")
    parser.add_argument("--aligned-references", action="store_true", help="a value and its reference from the same source")
    parser.add_argument("--buckets", type=int, default=0, help="store the cleaned entries in so many buckets by species")
    parser.add_argument("--file-format", default="parquet", choices=["parquet", *FILE_FORMATS])
    args = parser.parse_args()
    spec = DEFAULT_SPEC
    if args.spec:
        with open(args.spec) as file:
            spec = spec_from_json(file.read())
    conf = SparkConf()
    local = conf.get("spark.master", "local").startswith("local")
    for name, value in (SETTINGS if local else CLUSTER_SETTINGS).items():
        conf.setIfMissing(name, value)
    spark = SparkSession.builder.appName("traitloom").config(conf=conf).getOrCreate()
    options = dict(
        raw_schema=_schema(args.raw_schema),
        curated_schema=_schema(args.curated_schema),
        spec=spec,
        aligned_references=args.aligned_references,
        file_format=args.file_format,
        buckets=args.buckets,
    )
    for name, path in run(spark, args.raw, args.curated, args.out, args.run_date, **options).items():
        print(f"{name}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()
