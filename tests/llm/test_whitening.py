"""Whitening against the same numbers computed on one matrix."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.conftest import SF
from traitloom.llm import whitening
from traitloom.llm.common import table
from traitloom.llm.queries import QUERIES


def brute(vectors, components=32):
    good = [(i, v) for i, v in vectors if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    x = np.stack([np.floor(64 * np.array(v, dtype=np.float64)).astype(np.int64) + 1_000_000 for _, v in good])
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviation = [sum(int(d) ** 2 for d in row) for row in n * x - s]
    return [i for i, _ in good], deviation, values[order], values.sum(), centred @ axes[:, order] / np.sqrt(values[order])


def compare(rows, vectors):
    ids, deviation, values, trace, whitened = brute(vectors)
    width = whitened.shape[1]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], deviation[i]))
    assert len(rows) == len(ids) * width
    for c in range(width):
        got = sorted((r["vec_id"], r["deviation"], r["whitened"], r["explained"]) for r in rows if r["component"] == c + 1)
        want = whitened[order, c]
        mine = np.array([g[2] for g in got])
        assert np.allclose(mine, want * np.sign(mine @ want), atol=1e-7)
        assert [g[:2] for g in got] == [(ids[i], deviation[i]) for i in order]
        assert np.allclose([g[3] for g in got], values[c] / trace, rtol=1e-9)
    assert {r["n"] for r in rows} == {len(ids)}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-9


def test_whitening_of_the_driver_table(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    compare(QUERIES["op13_embedding_whitening"](spark, SF).collect(), vectors)


def schema():
    return "vec_id long, embedding array<double>, key string, part int, n long"


@pytest.fixture
def folder(spark, tmp_path):
    def put(vectors):
        rows = [(i, v, "k", 3, 9) for i, v in vectors]
        spark.createDataFrame(rows, schema()).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
        return str(tmp_path)

    return put


def test_frequent_null_and_repeated_vectors(spark, folder):
    rnd = np.random.default_rng(1)
    vectors = [(i, rnd.normal(size=5).tolist()) for i in range(60)]
    vectors += [(i % 7, vectors[0][1]) for i in range(300)] + [vectors[5]] * 4
    odd = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("inf")] * 5), (904, [float("nan")] * 5)]
    where = folder(vectors + odd)
    compare(QUERIES["op13_embedding_whitening"](spark, where).collect(), vectors)
    small = whitening.whiten(table(spark, where, "embeddings"), part_rows=10)
    assert small.count() == len(vectors)


def test_rows_without_an_id_stay(spark):
    rnd = np.random.default_rng(2)
    df = spark.createDataFrame([(None, rnd.normal(size=3).tolist()) for _ in range(9)], "vec_id long, embedding array<double>")
    assert [r["id"] for r in whitening.whiten(df).collect()] == [None] * 9


def test_other_lengths_and_too_large_entries_take_no_part(spark, folder):
    rnd = np.random.default_rng(3)
    vectors = [(i, rnd.normal(size=4).tolist()) for i in range(30)]
    where = folder([*vectors, (100, [1.0] * 3), (101, [1.0] * 6), (102, [1e200] * 4), (103, [2.0**46] * 4)])
    compare(QUERIES["op13_embedding_whitening"](spark, where).collect(), vectors)


def test_equal_vectors_have_no_component(spark, folder):
    assert QUERIES["op13_embedding_whitening"](spark, folder([(i, [0.5, 0.25]) for i in range(5)])).count() == 0


def test_fewer_vectors_than_dimensions_give_fewer_components(spark, folder):
    rnd = np.random.default_rng(4)
    rows = QUERIES["op13_embedding_whitening"](spark, folder([(i, rnd.normal(size=40).tolist()) for i in range(6)])).collect()
    assert max(r["component"] for r in rows) == 5 and rows[0]["identity_error"] < 1e-9


def test_packing_is_exact_and_the_same_for_equal_numbers():
    for numbers in ([0, -1, 127], [-129, 5], [1 << 31, 3], [-(1 << 52), 7], [0]):
        units = np.array(numbers, dtype=np.int64)
        assert whitening.unpack(whitening.pack(units)).tolist() == numbers
        assert whitening.pack(units) == whitening.pack(units.copy())


def test_large_deviations_are_exact_or_null():
    model = whitening.Whitener(10**9, [10**9 * 5 + 3, 10**9 * 7 + 1], np.eye(2), np.ones(2), 2.0)
    keys = [whitening.pack(np.array([u, 7 - whitening.SHIFT])) for u in (6 - whitening.SHIFT, 5 - whitening.SHIFT + 10**6)]
    want = [(10**9 - 3) ** 2 + 1, (10**15 - 3) ** 2 + 1]
    assert model.deviations(keys) == [want[0], None]
    assert model.deviations(keys[:1]) == [want[0]]
