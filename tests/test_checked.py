"""Every line of the raw text is a record, a reject with its reason, or a header, and the counts say so."""

import pytest
from pyspark.sql import functions as F

from traitloom.operators.router import tag_numeric, write_branches
from traitloom.sources.checked import LONG, NOT_WHOLE, SHORT, checked_lines, land_checked, read_eav_tsv_checked
from traitloom.sources.readers import read_eav_tsv

HEADER = "TraitID\tAccSpeciesName\tTraitName\tDataName\tOrigValueStr\tOrigUnitStr\tObsID"
GOOD = [
    '59\tAbies alba\tt\tPollination "x\tnectar \xb1 hidden\t\t1',
    "59.0\tAbies alba\tt\tspan\t 5 \tNA\t2",
    "\tAbies alba\tt\tspan\tNA\tyr\t3",
    "+26.\tAbies alba\t\t\tx\\y\t\t4",
]
BAD = {
    "59\tAbies alba\tt\tspan\t5\tyr": SHORT,
    "59": SHORT,
    "59\tAbies alba\tt\tspan\t5\tyr\t1\textra": LONG,
    "59.5\tAbies alba\tt\tspan\t5\tyr\t1": NOT_WHOLE,
    "0x3b\tAbies alba\tt\tspan\t5\tyr\t1": NOT_WHOLE,
    "99999999999\tAbies alba\tt\tspan\t5\tyr\t1": NOT_WHOLE,
    "Trait\tSpecies\ta\tb\tc\td\te": NOT_WHOLE,
    HEADER: NOT_WHOLE,
}


def put(path, lines, end="\n"):
    path.write_bytes(end.join([*lines, ""]).encode("latin-1"))
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_line_goes_to_one_place(spark, tmp_path, end):
    path = put(tmp_path / "raw.txt", [HEADER, *GOOD, *BAD, '', '  '], end)
    landed = land_checked(checked_lines(spark, path), str(tmp_path / "landed"))
    rows = sorted(tuple(r) for r in landed.records.select("ObsID", "TraitID", "OrigValueStr", "OrigUnitStr").collect())
    assert rows == [("1", 59, "nectar ± hidden", ""), ("2", 59, "5", None), ("3", None, None, "yr"), ("4", 26, "x\\y", "")]
    rejects = landed.rejects.collect()
    assert {r["line"]: r["reason"] for r in rejects} == BAD and len(rejects) == len(BAD)
    assert all(r["file"].endswith("raw.txt") for r in rejects)
    assert (landed.kept, landed.rejected, landed.lines) == (len(GOOD), len(BAD), len(GOOD) + len(BAD))
    assert landed.adds_up and sum(landed.reasons.values()) == len(BAD)


def test_readable_lines_give_what_the_plain_reader_gives(spark, tmp_path, rows):
    lines = ["  59 \t Abies alba\tNA\t\t\x0b 5\t \t 7 ", *[g for g in GOOD if not g.startswith(("59.0", "+26."))]]
    path = put(tmp_path / "raw.txt", [HEADER, *lines])
    plain = read_eav_tsv(spark, path)
    records, rejects = read_eav_tsv_checked(spark, path, plain.schema)
    assert rows(records) == rows(plain) and rejects.count() == 0 and records.schema == plain.schema


def test_a_folder_has_a_header_in_every_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for i in range(5):
        put(folder / f"part-{i}.txt", [HEADER, f"59\ta\tb\tc\td\te\t{i}"])
    put(folder / "part-9.txt", [])
    landed = land_checked(checked_lines(spark, str(folder)), str(tmp_path / "landed"))
    assert (landed.kept, landed.rejected, landed.adds_up) == (5, 0, True)


def test_unwanted_records_are_counted_and_not_kept(spark, tmp_path):
    path = put(tmp_path / "raw.txt", [HEADER, *GOOD, *BAD])
    landed = land_checked(checked_lines(spark, path), str(tmp_path / "landed"), F.col("TraitID") == 59)
    assert sorted(r["ObsID"] for r in landed.records.collect()) == ["1", "2"]
    assert landed.reasons["not wanted"] == 2 and landed.kept == 4 and landed.adds_up
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 2 + len(BAD)


def test_wrong_headers_and_types_are_errors(spark, tmp_path):
    path = put(tmp_path / "raw.txt", [HEADER, *GOOD])
    schema = checked_lines(spark, path).drop("file", "line", "reason").schema
    with pytest.raises(ValueError, match="AccSpeciesName"):
        checked_lines(spark, put(tmp_path / "few.txt", ["TraitID\tSpecies"]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        checked_lines(spark, put(tmp_path / "other.txt", [HEADER.replace("ObsID", "Obs"), GOOD[0]]), schema).collect()
    doubles = type(schema)([f if f.name != "ObsID" else type(f)("ObsID", spark.createDataFrame([], "d double").schema[0].dataType) for f in schema])
    with pytest.raises(ValueError, match="text or integers"):
        checked_lines(spark, path, doubles)


def test_both_branches_come_from_one_scan_and_one_match_a_row(spark, tmp_path, capfd):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2e5",)], "v string")
    df.write.parquet(str(tmp_path / "in"))
    tagged = tag_numeric(spark.read.parquet(str(tmp_path / "in")), "v")
    tagged.explain("simple")
    shown = capfd.readouterr().out
    assert shown.count("FileScan") == 1 and shown.count("RLIKE") == 1
    parts = write_branches(tagged, str(tmp_path / "out"), ("text", "number", "other"))
    assert sorted(r["v"] for r in parts["number"].collect()) == ["1", "2e5"]
    assert sorted(str(r["v"]) for r in parts["text"].collect()) == ["None", "x"]
    assert parts["other"].count() == 0 and parts["text"].columns == ["v"]
    parts["number"].explain("simple")
    assert "PartitionFilters: [isnotnull(branch" in capfd.readouterr().out
