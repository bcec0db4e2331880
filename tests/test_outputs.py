"""Snapshots that survive a failing rerun, and CSV that comes back as it went out."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from traitloom.sources import folders
from traitloom.sources.lossless_csv import read_csv_lossless, write_csv_lossless
from traitloom.sources.published import current, drop_superseded, publish, read_published
from traitloom.sources.writers import write_snapshot


def failing(spark):
    """Rows whose last task fails while the others are written."""
    rows = spark.range(0, 1000, 1, 8).withColumnRenamed("id", "n")
    return rows.select(F.when(F.col("n") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("n")).cast("long").alias("n"))


def test_a_failing_rerun_leaves_the_day(spark, rows, tmp_path):
    path = str(tmp_path / "snap")
    write_snapshot(spark.createDataFrame([(1,)], "n long"), path, "2022-11-09")
    with pytest.raises(Exception, match="broken"):
        write_snapshot(failing(spark), path, "2022-11-09")
    assert rows(spark.read.parquet(path).select("n")) == [(1,)]
    assert [f for f in (tmp_path / "snap").iterdir() if f.name.startswith("_")] == []


def test_a_move_that_fails_puts_the_old_folder_back(spark, tmp_path):
    for name in ("old", "new"):
        spark.createDataFrame([(name,)], "v string").write.parquet(str(tmp_path / name))
    with pytest.raises(OSError):
        folders.replace(spark, str(tmp_path / "missing"), str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).first()["v"] == "old"
    folders.replace(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).first()["v"] == "new" and not (tmp_path / "new").exists()


def test_published_days_are_seen_whole_or_not_at_all(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    one, two = spark.createDataFrame([(1, "a")], "n long, t string"), spark.createDataFrame([], "n long, t string")
    publish(one, path, datetime.date(2022, 11, 9))
    publish(one, path, "2022-11-10")
    before = read_published(spark, path)
    with pytest.raises(Exception, match="broken"):
        publish(failing(spark), path, "2022-11-10")
    assert rows(read_published(spark, path)) == [(1, "a", "2022-11-09"), (1, "a", "2022-11-10")]
    publish(two, path, "2022-11-10")
    assert rows(read_published(spark, path)) == [(1, "a", "2022-11-09")]
    assert read_published(spark, path, "2022-11-10").count() == 0
    # A reader that began before still has its files, until they are dropped.
    assert before.count() == 2 and len(current(spark, path)) == 2
    assert drop_superseded(spark, path) == 1 and drop_superseded(spark, path) == 0
    assert rows(read_published(spark, path)) == [(1, "a", "2022-11-09")]
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, "2022-11-11")
    with pytest.raises(ValueError):
        publish(one, path, "yesterday")


def test_lossless_csv(spark, tmp_path):
    texts = [None, "", "NA", "\\N", "\\", "\\\\", "a\nb", "\\n", "\\\n", "\r\n", ' "q", ', "é日", "x\\", "\t", "\\r\\\r"]
    now = datetime.datetime(2022, 11, 9, 1, 2, 3, 456789)
    data = [(i, t, 0.1 * i if i else float("nan"), now, now.date(), decimal.Decimal("1.20"), i % 2 == 0, (t or "").encode()) for i, t in enumerate(texts)]
    data.append((None,) * 8)
    schema = "i int, `t.x` string, d double, at timestamp, day date, m decimal(10,2), b boolean, raw binary"
    df = spark.createDataFrame(data, schema)
    path = write_csv_lossless(df.repartition(3), str(tmp_path / "c"))
    back = read_csv_lossless(spark, path)
    assert back.schema == df.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert spark.read.text(path).filter("value like '%\n%'").count() == 0
    with pytest.raises(ValueError, match="array"):
        write_csv_lossless(spark.createDataFrame([([1],)], "a array<int>"), str(tmp_path / "a"))


def test_lossless_csv_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    back = read_csv_lossless(spark, write_csv_lossless(df, str(tmp_path / "e")))
    assert back.schema == df.schema and back.count() == 0


def test_intermediate_tables_can_be_dropped(spark, monkeypatch):
    from traitloom.sources import scratch

    monkeypatch.setattr(scratch, "_made", [])  # those of other tests stay
    kept, unused = scratch.scratch_folder(spark, "kept"), scratch.scratch_folder(spark, "unused")
    spark.range(5).write.parquet(kept)
    assert spark.read.parquet(kept).count() == 5
    assert scratch.drop_scratch(spark) == 1 and not folders.exists(spark, kept) and not folders.exists(spark, unused)
    assert scratch.drop_scratch(spark) == 0
