"""Near-duplicate groups with regions cut small, so that Voronoi recursion and tiles are reached."""

from __future__ import annotations

import pytest

from tests.llm import brute
from traitloom.llm import jaccard


def rows_of():
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(36):
        words = list(base)
        for k in range(i % 4):
            words[(7 * i + 13 * k) % 60] = f"x{i}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("depth", [0, 1])
def test_small_regions_give_the_same_groups(spark, monkeypatch, depth):
    used = []
    for name in ("_voronoi", "_tiles"):
        whole = getattr(jaccard, name)
        monkeypatch.setattr(jaccard, name, lambda *a, _n=name, _f=whole, **k: used.append(_n) or _f(*a, **k))
    for name, value in (("LEAF", 2), ("TILE", 3), ("DEPTH", depth)):
        monkeypatch.setattr(jaccard, name, value)
    rows = rows_of()
    got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect())
    assert got == sorted(brute.near_groups(rows))
    assert "_tiles" in used and ("_voronoi" in used) == (depth > 0)


def members_of(sets, label=None):
    import numpy as np
    import pyarrow as pa

    rows = {
        "rid": pa.array(range(len(sets)), pa.int64()),
        "n": pa.array([len(s) for s in sets], pa.int64()),
        "label": pa.array(label or range(len(sets)), pa.int64()),
        "d": pa.array(np.full(len(sets), 0.3)),
        "sketch": pa.array([jaccard.sketch(s) for s in sets], pa.binary()),
        "elements": pa.array([s.tobytes() for s in sets], pa.binary()),
    }
    return jaccard.Members(pa.table(rows), jaccard.size_class(len(sets[0])))


def cloud(n, lost, seed):
    """``n`` sets, each the same 200 elements but for ``lost`` that are its own."""
    import numpy as np

    rnd = np.random.default_rng(seed)
    base = rnd.integers(0, 1 << 64, 200, dtype=np.uint64)
    sets = []
    for _ in range(n):
        mine = base.copy()
        mine[rnd.choice(200, lost, replace=False)] = rnd.integers(0, 1 << 64, lost, dtype=np.uint64)
        sets.append(np.unique(mine))
    return sets


@pytest.mark.parametrize("lost", [5, 10])
def test_comparisons_and_links_of_near_copies_grow_with_their_number(lost):
    """Copies that are all near to each other: every one is compared a few times, not with every other."""
    made = {}
    for n in (500, 3_000):
        tally = []
        links = jaccard._connect(members_of(cloud(n, lost, n)), tally=tally)
        assert links.num_rows == n - 1
        made[n] = tally[0]
    assert made[3_000] <= 7 * made[500] and made[3_000] <= 40 * 3_000


def test_connected_members_are_not_compared():
    tally = []
    assert jaccard._connect(members_of(cloud(50, 5, 1), [7] * 50), tally=tally).num_rows == 0 and tally == [0]


def test_links_are_near_by_their_exact_sets():
    """At the edge of nearness the sketch lets pairs pass that are not near; none of them is linked, none that is near is lost."""
    import numpy as np

    sets = cloud(120, 21, 4)
    links = jaccard._connect(members_of(sets))
    near = [
        (i, j)
        for i in range(120)
        for j in range(i)
        if 100 * (m := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - m)
    ]
    groups = list(range(120))

    def merged(pairs):
        label = list(groups)
        for a, b in pairs:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        return {frozenset(i for i in groups if label[i] == x) for x in label}

    pairs = list(zip(links["a"].to_pylist(), links["b"].to_pylist()))
    assert set(pairs) <= {(min(p), max(p)) for p in near} and merged(pairs) == merged(near)


def test_large_group_of_near_copies_through_tiles(spark, monkeypatch):
    """Chains of edits: neighbours are near, most pairs are not; tiles, the largest component and strays are all used."""
    for name, value in (("LEAF", 20), ("TILE", 16)):
        monkeypatch.setattr(jaccard, name, value)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in range(i % 30 // 2):
            words[(11 * k + i // 30) % 80] = f"x{i // 30}_{k}"
        rows.append((i, " ".join(words)))
    for i in range(150, 170):
        words = list(base)
        words[i % 10 :: 20] = [f"y{i}_{k}" for k in range(4)]
        rows.append((i, " ".join(words)))
    got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect())
    assert got == sorted(brute.near_groups(rows)) and len({g[2] for g in got}) > 1
