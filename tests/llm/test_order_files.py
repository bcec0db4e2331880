"""Shard files: a folder holds the shards of one run."""

from __future__ import annotations

import numpy as np
import pytest

from traitloom.llm import order


def sequences(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, tokens binary")


def test_a_folder_that_was_used_is_refused(spark, tmp_path):
    first = sequences(spark, [(i, bytes([i] * 10)) for i in range(20)])
    second = sequences(spark, [(i, bytes([100 + i] * 10)) for i in range(8)])
    settings = dict(row_tokens=4, shard_rows=4, waves=2)
    folder = str(tmp_path / "order")
    order.materialise(first, folder, 1, **settings)
    with pytest.raises(FileExistsError):
        order.materialise(second, folder, 1, **settings)
    rows = order.read_shards(spark, folder, shard_rows=4, row_tokens=4).collect()
    assert len(rows) == 60 and {r["tokens"][0] for r in rows} == set(range(20))

    fresh = tmp_path / "fresh"
    fresh.mkdir()
    assert order.materialise(second, str(fresh), 1, **settings).count() == 6
    assert order.read_shards(spark, str(fresh), shard_rows=4, row_tokens=4).count() == 24


@pytest.mark.parametrize("token_bytes", [2, 4])
def test_wide_ids_are_written_and_read_whole(spark, tmp_path, token_bytes):
    kind = f"<u{token_bytes}"
    ids = {i: (np.arange(3 * i) * 997 + i) % 32_000 for i in range(12)}
    folder = str(tmp_path / "order")
    sizes = dict(token_bytes=token_bytes, row_tokens=5, shard_rows=4)
    order.materialise(sequences(spark, [(i, v.astype(kind).tobytes()) for i, v in ids.items()]), folder, 3, waves=2, **sizes)
    rows = sorted(order.read_shards(spark, folder, **sizes).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    for i, want in ids.items():
        parts = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["part"])
        assert np.frombuffer(b"".join(r["tokens"] for r in parts), kind).tolist() == want.tolist()
        assert sum(r["n_tokens"] for r in parts) == len(want)
    for slot in (0, 1, 4, 7, len(rows) - 1):
        got = [(at, i, part, bytes(tokens)) for at, i, part, tokens in order.read_from(folder, slot, 4, token_bytes, 5)]
        assert got == [(r["slot"], r["doc_id"], r["part"], bytes(r["tokens"])) for r in rows[slot:]]


@pytest.fixture
def finished(spark, tmp_path):
    folder = str(tmp_path / "order")
    order.materialise(sequences(spark, [(i, bytes([i] * 10)) for i in range(20)]), folder, 1, row_tokens=4, shard_rows=4, waves=2)
    return tmp_path / "order"


def read_all(spark, folder):
    return order.read_shards(spark, str(folder), shard_rows=4, row_tokens=4).count()


def test_a_missing_shard_is_an_error(spark, finished):
    (finished / "shard-00000003.bin").rename(finished / "other")
    with pytest.raises(FileNotFoundError, match="shard 3"):
        read_all(spark, finished)
    with pytest.raises(FileNotFoundError, match="shard-00000003"):
        list(order.read_from(str(finished), 0, 4, 1, 4))
    # What lies behind the gap can be read.
    assert [r[0] for r in order.read_from(str(finished), 16, 4, 1, 4)] == list(range(16, 60))


def test_a_cut_or_surplus_shard_is_an_error(spark, finished):
    whole = (finished / "shard-00000005.bin").read_bytes()
    (finished / "shard-00000005.bin").write_bytes(whole[:-1])
    with pytest.raises(FileNotFoundError, match="shard 5"):
        read_all(spark, finished)
    with pytest.raises(FileNotFoundError, match="shard-00000005"):
        list(order.read_from(str(finished), 0, 4, 1, 4))
    (finished / "shard-00000005.bin").write_bytes(whole)
    (finished / "shard-00000015.bin").write_bytes(whole)
    with pytest.raises(FileNotFoundError, match="15"):
        read_all(spark, finished)


def test_a_run_that_did_not_finish_is_an_error(spark, finished):
    (finished / "manifest").rename(finished / "unfinished")
    for read in (lambda: read_all(spark, finished), lambda: list(order.read_from(str(finished), 0, 4, 1, 4))):
        with pytest.raises(FileNotFoundError, match="no manifest"):
            read()


def test_reading_goes_on_from_every_slot(spark, finished):
    whole = list(order.read_from(str(finished), 0, 4, 1, 4))
    assert [r[0] for r in whole] == list(range(60))
    for slot in range(0, 61, 7):
        assert list(order.read_from(str(finished), slot, 4, 1, 4)) == whole[slot:]


def test_the_query_against_the_permutation_itself(spark, tmp_path):
    """Each sequence is where the permutation puts its number, and byte offsets lead to it."""
    data = {i: bytes([i] * (i % 9)) for i in range(40)}
    folder = str(tmp_path / "order")
    order.materialise(sequences(spark, list(data.items())).coalesce(1), folder, 9, row_tokens=4, shard_rows=8, waves=3)
    rows = order.read_shards(spark, folder, shard_rows=8, row_tokens=4).collect()
    cut = [(i, p, data[i][4 * p : 4 * p + 4]) for i in data for p in range(-(-len(data[i]) // 4))]
    slots = order.Permutation(len(cut), 9).slots(np.arange(len(cut)))
    want = sorted((int(s), *piece) for s, piece in zip(slots, cut))
    assert sorted((r["slot"], r["doc_id"], r["part"], bytes(r["tokens"])) for r in rows) == want
    for r in rows:
        with open(order.shard_path(folder, r["shard"]), "rb") as file:
            file.seek(r["byte_offset"])
            head = np.frombuffer(file.read(order.HEAD.itemsize), dtype=order.HEAD)[0]
            assert (head["doc_id"], head["part"]) == (r["doc_id"], r["part"])
