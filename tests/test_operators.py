import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from traitloom.operators import columns as c
from traitloom.operators.aggregates import collapse_text, count_by, mean_by, unique_projected
from traitloom.operators.filters import drop_equal, drop_in, drop_in_table, keep_flagged, keep_in, keep_nonblank, split_numeric
from traitloom.operators.joins import left_enrich, left_enrich_all
from traitloom.operators.profile import (
    flag_numbers,
    frequency_profile,
    frequency_profile_by_flag,
    numeric_profile,
    numeric_profile_by_flag,
    numeric_states,
    overall_numbers,
)
from traitloom.operators.reshape import (
    collapse_wider,
    mean_wider,
    pivot_longer,
    pivot_wider,
    relabel_columns,
    separate,
)
from traitloom.operators.setops import union_by_name, union_tagged


@pytest.fixture
def wide(spark):
    return spark.createDataFrame([(1, "x", 2.0, "p")], "`a` int, `b.c` string, Orig1 double, orig2 string")


def test_column_surgery(wide):
    assert c.keep(wide, ["b.c", "a"]).columns == ["b.c", "a"]
    assert c.drop_strict(wide, ["a", "a"]).columns == ["b.c", "Orig1", "orig2"]
    assert c.drop_prefix(wide, "Orig").columns == ["a", "b.c"]
    assert c.rename_strict(wide, {"b.c": "d"}).columns == ["a", "d", "Orig1", "orig2"]
    assert c.prefix_names(wide, "p_", "a", {"Orig1": "o"}).columns == ["a", "p_b.c", "p_o", "p_orig2"]
    assert c.insert_at(wide, "n", F.lit(1)).columns == ["n", "a", "b.c", "Orig1", "orig2"]
    assert c.insert_at(wide, "n", F.lit(1), after="a").columns == ["a", "n", "b.c", "Orig1", "orig2"]
    assert c.insert_at(wide, "a", F.lit(1), before="orig2").columns == ["b.c", "Orig1", "a", "orig2"]
    moved = c.relocate(wide, [("a", "orig2"), ("b.c", "a")])
    assert moved.columns == ["Orig1", "orig2", "a", "b.c"]
    assert tuple(moved.first()) == (2.0, "p", 1, "x")


@pytest.mark.parametrize(
    "action",
    [
        lambda df: c.keep(df, ["nope"]),
        lambda df: c.drop_strict(df, ["nope"]),
        lambda df: c.rename_strict(df, {"nope": "x"}),
        lambda df: c.rename_strict(df, {"a": "b.c"}),
        lambda df: c.relocate(df, [("nope", "a")]),
        lambda df: c.relocate(df, [("a", "nope")]),
        lambda df: c.insert_at(df, "n", F.lit(1), after="nope"),
        lambda df: c.prefix_names(df, "p", "nope"),
    ],
)
def test_unknown_names_are_errors(wide, action):
    with pytest.raises(ValueError):
        action(wide)


def test_filters(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,), ("5",)], "v string")
    assert rows(keep_in(df, "v", ["a"])) == [("a",)]
    assert rows(drop_in(df, "v", ["a"])) == [(None,), ("",), ("5",), ("b",)]
    listed = spark.createDataFrame([("a",), (None,)], "x string")
    assert rows(drop_in_table(df, "v", listed, "x")) == rows(drop_in(df, "v", ["a"]))
    assert rows(keep_nonblank(df, "v")) == [("5",), ("a",), ("b",)]
    assert rows(drop_equal(df, "v", "a")) == [("",), ("5",), ("b",)]
    text, number = split_numeric(df, "v")
    assert rows(number) == [("5",)] and text.count() == 4
    flags = spark.createDataFrame([(1,), (0,), (None,)], "f int")
    assert rows(keep_flagged(flags, "f")) == [(1,)]


def test_left_enrich_keeps_left_rows_and_marks_shared_names(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "species string, n int")
    right = spark.createDataFrame([("a", 9), ("z", 8)], "species string, n int")
    out = left_enrich(left, right)
    assert out.columns == ["species", "n.x", "n.y"]
    assert rows(out) == [(None, 4, None), ("a", 1, 9), ("a", 2, 9), ("b", 3, None)]


def test_left_enrich_all_equals_two_joins(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "n int, species string")
    one = spark.createDataFrame([("a", "x"), ("b", None), ("q", "y")], "species string, t string")
    two = spark.createDataFrame([("a", 1.5), ("c", 2.5)], "species string, v double")
    out = left_enrich_all(left, [one, two])
    assert out.columns == ["n", "species", "t", "v"]
    assert rows(out) == rows(left_enrich(left_enrich(left, one), two))


def test_left_enrich_all_rejects_a_repeated_key(spark):
    left = spark.createDataFrame([("a",)], "species string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "species string, v int")
    other = spark.createDataFrame([("a", 1)], "species string, w int")
    with pytest.raises(Exception, match="more than one row for species a"):
        left_enrich_all(left, [twice, other]).collect()
    with pytest.raises(ValueError):
        left_enrich_all(left, [twice, twice])


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_collapse_of_a_hot_group_equals_python(spark, adaptive):
    """One group holds most rows; runs of it end up in several partitions and must still come out in order."""
    rng = random.Random(1)
    data = [("hot", f"v{rng.randrange(10**6):06d}", i) for i in range(20000)]
    data += [(f"g{i % 500}", f"v{rng.randrange(10**6)}", i) for i in range(5000)] + [(None, "x", 1), ("n", None, 2)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v string, o int").repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        by_value = {r.k: r.value_entry for r in collapse_text(df, ["k"], "v").collect()}
        by_order = {r.k: r.value_entry for r in collapse_text(df, ["k"], "v", order_by=["o"], sep="|").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    groups = {}
    for k, v, o in data:
        groups.setdefault(k, []).append((v or "NA", o))
    assert by_value == {k: "; ".join(sorted(v for v, _ in g)) for k, g in groups.items()}
    assert by_order == {k: "|".join(v for v, _ in sorted(g, key=lambda x: (x[1], x[0]))) for k, g in groups.items()}


def test_wide_forms_agree(spark, rows):
    data = [("s1", "a", "x", 1.0), ("s1", "a", "y", 2.0), ("s1", "b", "z", None), ("s2", None, "q", 4.0), ("s3", "c", "w", 5.0)]
    df = spark.createDataFrame(data, "s string, n string, t string, v double")
    names = ["a", "b", "zzz"]
    collapsed = pivot_wider(collapse_text(df, ["s", "n"], "t"), "s", "n", "value_entry", names, unlisted="drop")
    direct = collapse_wider(df, "s", "n", "t", names, unlisted="drop")
    assert direct.columns == collapsed.columns == ["s", *names]
    assert rows(direct) == rows(collapsed)
    assert rows(direct) == [("s1", "x; y", "z", None), ("s2", None, None, None), ("s3", None, None, None)]
    means = pivot_wider(mean_by(df, ["s", "n"], "v"), "s", "n", "value_entry", names, unlisted="drop")
    assert rows(mean_wider(df, "s", "n", "v", names, unlisted="drop")) == rows(means)
    assert rows(means)[0] == ("s1", 1.5, None, None)
    assert rows(pivot_wider(df, "s", "n", "v", ["NA"], unlisted="drop")) == [("s1", None), ("s2", 4.0), ("s3", None)]


def test_relabel_equals_the_round_trip_through_the_long_form(spark, rows):
    df = spark.createDataFrame(
        [("a", "1", None), ("b", None, "2"), (None, "3", "4"), ("drop", "5", "6")], "species string, x string, y_ string"
    )
    long = pivot_longer(drop_in(df, "species", ["drop"]), "species")
    long = long.withColumn("columns", F.when(F.col("columns") == "y_", "y").otherwise(F.col("columns")))
    long = long.withColumn("columns", F.concat(F.lit("p_"), "columns"))
    trip = pivot_wider(long, "species", "columns", "entries", ["p_x", "p_y"])
    out = relabel_columns(df, "p_", drop_keys=["drop"], fixes={"y_": "y"})
    assert out.columns == trip.columns
    assert rows(out) == rows(trip)


def test_longer_keeps_empty_cells_and_mixes_types(spark, rows):
    df = spark.createDataFrame([("a", 1, None)], "k string, x int, `y.z` string")
    assert rows(pivot_longer(df, "k")) == [("a", "x", "1"), ("a", "y.z", None)]


def test_separate(spark):
    df = spark.createDataFrame([("a",), ("a b",), ("a b c",), ("a b c d",), ("",), (None,)], "v string").coalesce(1)
    got = [tuple(r) for r in separate(df, "v", ["x", "y", "z"]).collect()]
    assert got == [("a", None, None), ("a", "b", None), ("a", "b", "c"), ("a", "b", "c d"), ("", None, None), (None,) * 3]


def test_counts_and_unique(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, n int")
    assert rows(count_by(df, ["k"])) == [(None, 2), ("a", 2)]
    assert rows(unique_projected(df, ["k"])) == [(None,), ("a",)]


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2.5)], "t string, v double")
    assert rows(union_by_name([a, b])) == [(None, "y", 2.5), (1, "x", None)]
    assert union_tagged({"one": a, "two": b}).columns == ["site", "n", "t", "v"]
    with pytest.raises(TypeError):
        union_by_name([a, spark.createDataFrame([("q",)], "n string")])


@pytest.fixture
def members(spark):
    data = [
        (1, 1, None, 2.0, 10.0, "a", "u"),
        (1, 0, None, 4.0, None, "a", None),
        (0, 1, 1, 9.0, None, None, "u"),
        (None, 1, 0, float("nan"), None, "b", "u"),
    ]
    return spark.createDataFrame(data, "S1 int, S2 int, S3 int, x double, y double, p string, q string")


def test_numeric_profiles(members, rows):
    assert rows(numeric_profile(members, ["x", "y"])) == [("x", 3, 2.0, 9.0, 5.0, 3.606), ("y", 1, 10.0, 10.0, 10.0, None)]
    by_site = numeric_profile_by_flag(members, ["x", "y"], ["S1", "S2", "S3"])
    assert by_site.columns == ["site", "variable", "n", "min", "max", "mean", "sd"]
    looped = union_tagged({s: numeric_profile(members.filter(f"{s} = 1"), ["x", "y"]) for s in ("S1", "S2", "S3")})
    assert rows(by_site) == rows(looped)
    assert ("S3", "x", 1, 9.0, 9.0, 9.0, None) in rows(by_site)
    assert all(r[:2] != ("S3", "y") for r in rows(by_site))


def looped_frequencies(df, columns):
    """The obvious form: one grouping per column, stacked."""
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            df.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("count")).select(
                F.lit(name).alias("variable"), "value", "count"
            )
            for name in columns
        ],
    )


def test_frequency_profiles(members, rows):
    columns, sites = ["p", "q"], ["S1", "S2", "S3"]
    overall = frequency_profile(members, columns)
    assert rows(overall) == rows(looped_frequencies(members, columns))
    assert ("p", None, 1) in rows(overall)
    by_site = frequency_profile_by_flag(members, columns, sites)
    looped = union_tagged({s: looped_frequencies(members.filter(f"{s} = 1"), columns) for s in sites})
    assert by_site.columns == looped.columns
    assert rows(by_site) == rows(looped)


def test_states_of_masks_merge_to_the_statistics_of_the_rows(spark):
    """Overlapping memberships, more than one mask holds, far-off groups with tiny spread, missing values and NaN."""
    import statistics

    rnd = random.Random(11)
    flags = [f"F{i}" for i in range(30)]
    data = []
    for i in range(400):
        member = [rnd.choice([0, 1, None]) for _ in flags]
        member[3], member[29], member[7] = int(i % 5 == 0), 1, 0
        x = 1e9 + i * 1e-3 if i % 5 == 0 else rnd.choice([None, float("nan"), rnd.gauss(0, 1)])
        data.append((x, float(i) if i == 17 else None, *member))
    df = spark.createDataFrame(data, "x double, `a.b` double, " + ", ".join(f"{f} int" for f in flags)).repartition(6)
    states = numeric_states(df, ["x", "a.b"], flags)
    got = {(r["site"], r["variable"]): r for r in flag_numbers(states, flags, 9).collect()}
    for i, flag in enumerate(flags):
        for j, name in enumerate(["x", "a.b"]):
            values = [row[j] for row in data if row[2 + i] == 1 and row[j] is not None and row[j] == row[j]]
            if not values:
                assert (flag, name) not in got
                continue
            r = got[flag, name]
            assert (r["n"], r["min"], r["max"]) == (len(values), round(min(values), 9), round(max(values), 9))
            assert abs(r["mean"] - statistics.fmean(values)) <= 1e-9 * max(1, abs(r["mean"]))
            if len(values) == 1:
                assert r["sd"] is None
            else:
                assert abs(r["sd"] - statistics.stdev(values)) <= 1e-6 * max(1, r["sd"])
    assert got["F3", "x"]["sd"] > 0.1 and ("F7", "x") not in got
    whole = {r["variable"]: r["n"] for r in overall_numbers(states).collect()}
    assert whole == {r["variable"]: r["n"] for r in numeric_profile(df, ["x", "a.b"]).collect()}


def test_profile_by_flag_of_an_empty_table(spark):
    assert numeric_profile_by_flag(spark.createDataFrame([], "x double, S int"), ["x"], ["S"]).count() == 0


def test_names_outside_the_list_go_to_a_map(spark):
    data = [("a", "x", "1"), ("a", "y", "2"), ("a", None, "3"), ("b", "x", "4"), ("c", "z", None), (None, "y", "5")]
    df = spark.createDataFrame(data, "k string, n string, v string")

    def found(wide):
        return {r["k"]: (r["x"], r["other"]) for r in wide.collect()}

    want = {"a": ("1", {"y": "2", "NA": "3"}), "b": ("4", {}), "c": (None, {"z": None}), None: (None, {"y": "5"})}
    assert found(pivot_wider(df, "k", "n", "v", ["x"], unlisted="map")) == want
    texts = {**want, "c": (None, {"z": "NA"})}
    assert found(collapse_wider(df, "k", "n", "v", ["x"], unlisted="map")) == texts
    twice = df.unionByName(df).unionByName(df.filter("n = 'y'").withColumn("v", F.lit("0")))
    collapsed = found(collapse_wider(twice, "k", "n", "v", ["x"], unlisted="map", distinct=True))
    assert collapsed["a"] == ("1", {"y": "0; 2", "NA": "3"})
    numbers = df.withColumn("v", F.col("v").cast("double"))
    more = numbers.unionByName(numbers.withColumn("v", F.col("v") + 1))
    means = found(mean_wider(more, "k", "n", "v", ["x"], unlisted="map"))
    assert means["a"] == (1.5, {"y": 2.5, "NA": 3.5}) and means["c"] == (None, {"z": None})
    with pytest.raises(Exception, match="several entries"):
        pivot_wider(twice, "k", "n", "v", ["x"], unlisted="map").collect()
    with pytest.raises(ValueError, match="already"):
        pivot_wider(df, "k", "n", "v", ["other"], unlisted="map")
    with pytest.raises(ValueError, match="neither"):
        pivot_wider(df, "k", "n", "v", ["x"], unlisted="keep")
