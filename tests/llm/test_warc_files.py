"""Archives are bounded in bytes, and come back whole from many small files."""

from __future__ import annotations

import gzip

from tests.llm import brute
from traitloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, date int")


def test_records_per_file_follow_their_bytes(spark):
    sizes = spark.createDataFrame([(100,)] * 99 + [(5_000,)], "payload_bytes long")
    head = warc.HEAD_BYTES
    assert warc.records_per_file(sizes, typical=20 * (149 + head), most=1 << 30) == 20
    # One large record may be followed by others as large.
    assert warc.records_per_file(sizes, typical=1 << 30, most=3 * (5_000 + head)) == 3
    assert warc.records_per_file(sizes, typical=1, most=1) == 1
    assert warc.records_per_file(sizes.limit(0)) == warc.RECORDS == warc.records_per_file(sizes.limit(5))


def test_files_stay_below_their_bound_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", "x" * (3_000 if i % 10 == 0 else 40) + str(i % 30), "clash", 1) for i in range(120)]
    rows += [(500, None, None, None, None), (501, "u", "", "c", 2)] + [(3, "u3", "x" * 40 + "3", "clash", 1)] * 2
    df = pages(spark, rows)
    most = 3 * (3_100 + warc.HEAD_BYTES)
    real = warc.records_per_file
    monkeypatch.setattr(warc, "records_per_file", lambda sizes: real(sizes, typical=1 << 30, most=most))
    read = warc.deduplicate(df, str(tmp_path / "warc")).collect()
    files = list((tmp_path / "warc").glob("*.gz"))
    assert len(files) > 30 and max(len(gzip.decompress(f.read_bytes())) for f in files) <= most
    got = sorted((int(r["record_id"]), r["payload_bytes"], r["payload_digest"]) for r in read)
    want = sorted((p, n, d) for p, n, d, *_ in brute.revisits([(r[0], r[2]) for r in rows]))
    assert got == want


def test_a_very_long_page(spark, tmp_path):
    rows = [(1, "u", "é" * 3_000_000, "", 0), (2, "v", "é" * 3_000_000, "", 0), (3, "w", "short", "", 0)]
    read = {int(r["record_id"]): r for r in warc.deduplicate(pages(spark, rows), str(tmp_path / "warc")).collect()}
    assert [read[i]["payload_bytes"] for i in (1, 2, 3)] == [6_000_000, 6_000_000, 5]
    assert (read[1]["record_type"], read[2]["record_type"], read[2]["refers_to"]) == ("response", "revisit", "1")
