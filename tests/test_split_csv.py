"""CSV with line breaks in quoted text: the rows of a file read in many ranges are those of the file read whole."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from traitloom.sources import split_csv
from traitloom.sources.readers import CSV_FORMAT, read_csv, read_csv_inferred
from traitloom.sources.writers import write_csv_blank

SCHEMA = "id int, text string, more string, x double"


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def whole(spark, path, schema):
    return spark.read.options(**CSV_FORMAT).schema(schema).csv(path)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def odd_file(path, seed, end="\n"):
    rnd = random.Random(seed)
    pieces = ["word", "\n", "\n\n", '"', '""', ",", "é", " ", "\r", "日本", 'a"b', "x" * 40, "\n,"]
    lines = ["id,text,more,x"]
    for i in range(120):
        n = 400 if i % 37 == 5 else rnd.randrange(0, 12)
        text = "".join(rnd.choice(pieces) for _ in range(n))
        more = rnd.choice(["", 'say "x"', "plain", '5" pipe', quoted("b\nc"), quoted(""), "NA"])
        lines.append(f"{i},{quoted(text)},{more},{rnd.choice(['', '1.5', '2'])}")
        if i % 11 == 0:
            lines.append("")
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode())
    return str(path)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_rows_as_the_whole_file(spark, rows, tmp_path, small_ranges, seed):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = odd_file(tmp_path / "odd.csv", seed)
    want = rows(whole(spark, path, schema))
    got = split_csv.read_csv_split(spark, path, schema)
    assert rows(got) == want and len(want) == 120
    # Many ranges, and records that span several of them.
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20
    parts = got.sparkSession.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0]).filter("owner >= 0")
    assert parts.groupBy("owner").count().filter("count > 2").count() > 0
    assert rows(read_csv(spark, path, schema, split=True)) == rows(read_csv(spark, path, schema))


def test_line_ends_of_two_characters(spark, rows, tmp_path, small_ranges):
    path = tmp_path / "crlf.csv"
    body = "".join(f'{i},"a\r\nb {"z" * (i % 50)}",c,\r\n' for i in range(60))
    path.write_bytes(b"id,text,more,x\r\n" + body.encode())
    got = split_csv.read_csv_split(spark, str(path), spark.createDataFrame([], SCHEMA).schema)
    want = sorted((i, f'a\r\nb {"z" * (i % 50)}', "c", None) for i in range(60))
    assert rows(got) == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])


def test_several_files_each_with_its_header(spark, rows, tmp_path, small_ranges):
    schema = spark.createDataFrame([], SCHEMA).schema
    data = [(i, f'line {i}\n"quoted", {"w " * (i % 60)}', None if i % 3 else " x ", i / 2) for i in range(90)]
    df = spark.createDataFrame(data, schema).repartition(4)
    path = write_csv_blank(df, str(tmp_path / "many"))
    assert rows(split_csv.read_csv_split(spark, path, schema)) == rows(df)


def test_headers_are_compared_also_when_they_span_ranges(spark, tmp_path, small_ranges):
    schema = spark.createDataFrame([], "id int, text string").schema
    path = tmp_path / "h.csv"
    path.write_text("id,other\n1,a\n")
    with pytest.raises(Exception, match="the header names"):
        split_csv.read_csv_split(spark, str(path), schema)
    name = "long " * 200 + "\n" + "name " * 200
    path.write_text(f'id,{quoted(name)}\n1,a\n')
    spanning = spark.createDataFrame([], "id int").schema.add(name, StringType())
    assert [tuple(r) for r in split_csv.read_csv_split(spark, str(path), spanning).collect()] == [(1, "a")]
    with pytest.raises(Exception, match="the header names"):
        split_csv.read_csv_split(spark, str(path), schema)


def test_a_header_alone_and_an_empty_file(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    for content in ("id,text,more,x\n", "id,text,more,x", ""):
        path = tmp_path / "e.csv"
        path.write_text(content)
        assert split_csv.read_csv_split(spark, str(path), schema).count() == 0


def test_other_encodings_and_separators(spark, tmp_path, small_ranges):
    path = tmp_path / "l.csv"
    path.write_bytes("id;text\n1;\"é\nü;ß\"\n".encode("latin-1") * 1)
    schema = spark.createDataFrame([], "id int, text string").schema
    got = split_csv.read_csv_split(spark, str(path), schema, separator=";", encoding="ISO-8859-1")
    assert [tuple(r) for r in got.collect()] == [(1, "é\nü;ß")]


def test_ranges_that_changed_are_an_error():
    places = split_csv.Places([("f", 0, True, False, False), ("f", 100, False, False, True)])
    assert (places.owner("f", 0), places.owner("f", 50), places.owner("f", 100), places.owner("f", 150)) == (-1, 0, 0, -1)
    places.agree("f", 0, True, True)
    for wrong in ((0, False, True), (50, True, True), (100, False, False)):
        with pytest.raises(RuntimeError, match="other ranges"):
            places.agree("f", *wrong)


def test_owner_of_a_record_over_many_ranges():
    rows = [("f", 0, True, False, False), ("f", 10, False, True, False), ("f", 30, False, True, True), ("f", 40, True, False, False)]
    places = split_csv.Places(rows)
    # It begins in the first range, comes through the second, ends in the third, where another begins and ends in the fourth.
    assert [places.owner("f", s) for s in (10, 20, 30, 40, 50)] == [0, 0, 0, 30, -1]


def test_inferred_types_of_a_split_file(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    head = "code,n,big,x,flag,day,at,none,text\n"
    line = '0{0},{0},99999999999{0},{0}.5,true,2022-11-0{0},2022-11-0{0} 10:00:00,NA,"a\nb{0}"\n'
    path.write_text(head + "".join(line.format(i) for i in range(1, 10)) + "NA,,NA,1e3,FALSE,,,,\n")
    got = read_csv_inferred(spark, str(path), {"code": StringType()}, split=True)
    kinds = ["string", "int", "bigint", "double", "boolean", "date", "timestamp", "string", "string"]
    assert [t for _, t in got.dtypes] == kinds
    assert got.filter("code = '07'").select("n", "text").first() == (7, "a\nb7")
    assert got.filter("code is null and n is null and x = 1000 and not flag and text is null").count() == 1
    with pytest.raises(ValueError, match="nope"):
        read_csv_inferred(spark, str(path), {"nope": StringType()}, split=True)


def test_only_lines_with_quotes_are_looked_at_in_the_first_pass(spark, tmp_path, capfd):
    path = tmp_path / "p.csv"
    path.write_text("a,b\n" + "1,2\n" * 50)
    assert split_csv.range_states(spark, str(path)).count() == 0
    split_csv.range_states(spark, str(path)).explain("simple")
    shown = capfd.readouterr().out
    assert "Filter" in shown and "MapInArrow" in shown and "Exchange" not in shown
