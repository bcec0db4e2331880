from pyspark.sql import functions as F

from traitloom.functions.nulls import blank_to_null, has_text, if_else, is_in, not_in, paste
from traitloom.functions.numeric import UnitRule, convert_unit, convert_value, is_number, to_number
from traitloom.functions.recode import (
    decode_month,
    label,
    override_equal,
    override_in,
    recode,
    recode_from_table,
)
from traitloom.functions.sources import prefer, prefer_with_source
from traitloom.functions.text import (
    always_with_unit,
    detect_first,
    detect_or_else,
    source_label,
    title_case,
    with_unit,
)
from traitloom.plans.records import species_name
from traitloom.plans.spec import UNIT_RULES, VALUE_FIXES


def evaluate(spark, values, expression, schema="v string"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in df.select(expression).collect()]


def test_missing_value_rules(spark):
    v = F.col("v")
    assert evaluate(spark, ["a", "b", None], if_else(v == "a", F.lit(1), F.lit(2))) == [1, 2, None]
    assert evaluate(spark, ["a", "b", None], is_in(v, ["a"])) == [True, False, False]
    assert evaluate(spark, ["a", "b", None], not_in(v, ["a"])) == [False, True, True]
    assert evaluate(spark, ["a", "", None], has_text(v)) == [True, False, None]
    assert evaluate(spark, ["a", "", None], blank_to_null(v)) == ["a", None, None]
    assert evaluate(spark, ["a", None], paste(v, F.lit("x"))) == ["a x", "NA x"]


def test_only_plain_decimal_spellings_are_numbers(spark):
    numbers = ["5", " 5 ", "1e3", ".5", "5.", "-2.5E-3", "+7"]
    texts = ["1d", "0x1F", "1_0", "Inf", "NaN", "1,5", "", ".", "e3", "5 6"]
    v = F.col("v")
    assert evaluate(spark, numbers, is_number(v)) == [True] * len(numbers)
    assert evaluate(spark, texts + [None], is_number(v)) == [False] * (len(texts) + 1)
    assert evaluate(spark, numbers, to_number(v)) == [5.0, 5.0, 1000.0, 0.5, 5.0, -0.0025, 7.0]
    assert evaluate(spark, texts + [None], to_number(v)) == [None] * (len(texts) + 1)


def test_whatever_the_pattern_accepts_can_be_cast(spark):
    odd = ["\t5\n", "\x0b5\x0c", "1e999", "00000000000000000001", "1E+05", "9" * 400, "-.0e-0"]
    assert None not in evaluate(spark, odd, to_number(F.col("v")))


def test_units(spark):
    cases = [("5", "mg"), ("5", "gr"), ("5", "g / 1000 seeds"), ("10", "1/lb"), ("10", "1/pound"), ("10", "1/kg"),
             ("5", "MG"), ("3", "yrs"), ("200", "doy"), ("1", ""), ("1", None)]
    value = convert_value(to_number(F.col("v")), F.col("u"), UNIT_RULES)
    got = evaluate(spark, cases, value, "v string, u string")
    assert got == [0.005, 5.0, 0.005, 22.0, 22.0, 10.0, 5.0, 3.0, 200.0, 1.0, 1.0]
    unit = convert_unit(F.col("u"), UNIT_RULES)
    assert evaluate(spark, cases, unit, "v string, u string") == [
        "g", "g", "g", "1_per_kg", "1_per_kg", "1_per_kg", "MG", "year", "day_of_year", "", None]
    assert evaluate(spark, [("7", "x")], convert_value(F.col("v").cast("double"), F.col("u"), [UnitRule("x", "y")]),
                    "v string, u string") == [7.0]


def test_recodes(spark):
    v = F.col("v")
    assert evaluate(spark, ["a", "b", None], recode(v, {"a": "z"})) == ["z", "b", None]
    assert evaluate(spark, ["a", None], recode(v, {})) == ["a", None]
    assert evaluate(spark, ["a", "b", "c", None], label(v, {"x": ["a", "b"]})) == ["x", "x", None, None]
    fixed = evaluate(spark, list(VALUE_FIXES), recode(v, VALUE_FIXES))
    assert fixed == list(VALUE_FIXES.values())


def test_months(spark):
    cases = [("1", "month"), ("12", "month"), ("01", "month"), ("5.5", "month"), ("13", "month"), ("1", "day"), ("1", None),
             (None, "month")]
    decoded = decode_month(F.col("v"), F.col("u"))
    assert evaluate(spark, cases, decoded, "v string, u string") == ["Jan", "Dec", "01", "5.5", "13", "1", "1", None]


def test_fixing_and_decoding_at_once_equals_one_after_the_other(spark):
    fixes = {"one": "1", "2": "two", "x": "y"}
    cases = [(v, u) for v in ("1", "2", "3", "one", "x", "q", None) for u in ("month", "", None)]
    at_once = decode_month(F.col("v"), F.col("u"), fixes)
    after = decode_month(recode(F.col("v"), fixes), F.col("u"))
    schema = "v string, u string"
    assert evaluate(spark, cases, at_once, schema) == evaluate(spark, cases, after, schema)


def test_overrides_differ_on_a_missing_key(spark):
    v = F.col("v")
    assert evaluate(spark, ["a", "b", None], override_in(v, ["a"], "yes", F.lit("no"))) == ["yes", "no", "no"]
    assert evaluate(spark, ["a", "b", None], override_equal(v, ["a", "c"], "yes", F.lit("no"))) == ["yes", "no", None]


def test_recode_from_a_table(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "v string, n int")
    table = spark.createDataFrame([("a", "z"), ("q", "w")], "old string, new string")
    out = recode_from_table(df, "v", table, "old", "new")
    assert out.columns == ["v", "n"]
    assert rows(out) == [(None, 3), ("b", 2), ("z", 1)]


def test_names_with_units(spark):
    cases = [("t", "", "v"), ("t", "mg", "v"), (None, "mg", "v"), (None, "", "v"), ("t", None, "v"), ("t", "mg", None)]
    schema = "t string, u string, v string"
    t, u, v = F.col("t"), F.col("u"), F.col("v")
    assert evaluate(spark, cases, with_unit(t, u, v), schema) == ["t", "t_mg", "NA_mg", None, None, "t"]
    assert evaluate(spark, cases, always_with_unit(t, u), schema) == ["t_", "t_mg", "NA_mg", "NA_", "t_NA", "t_mg"]


def test_text_detection_and_labels(spark):
    v = F.col("v")
    assert evaluate(spark, ["wind, bees", "bees", "", None], detect_or_else(v, "wind", "animal")) == [
        "wind", "animal", "animal", None]
    ternary = detect_first(v, "wind", "water", "animal")
    assert evaluate(spark, ["wind", "water", "salt water", None], ternary) == ["wind", "water", "animal", "animal"]
    assert evaluate(spark, ["x", "", None], source_label(v, "s")) == ["s", None, None]
    assert evaluate(spark, [(1.5,), (None,)], source_label(v, "s"), "v double") == ["s", None]


def test_title_case(spark):
    given = ["semi-tolerant", "INTOLERANT", "in_tol OAK'S", "été/x 2nd", "", None]
    assert evaluate(spark, given, title_case(F.col("v"))) == [
        "Semi-Tolerant", "Intolerant", "In_tol Oak's", "Été/X 2nd", "", None]


def test_species_name(spark):
    names = ["Abies", "Abies alba", "Abies alba var.", "Abies alba var. x", "", None]
    assert evaluate(spark, names, species_name(F.col("v"))) == [
        "Abies NA", "Abies alba", "Abies alba", "Abies alba", " NA", "NA NA"]


def test_source_precedence(spark):
    cases = [(None, None, "b", "B"), ("a", None, "b", "B"), (None, "A", None, "B")]
    schema = "a string, ar string, b string, br string"
    a, ar, b, br = (F.col(c) for c in ("a", "ar", "b", "br"))
    assert evaluate(spark, cases, prefer(a, b, "string"), schema) == ["b", "a", None]
    assert evaluate(spark, cases, prefer(ar, br, "string"), schema) == ["B", "B", "A"]
    value, source = prefer_with_source(a, ar, b, br, "string")
    assert evaluate(spark, cases, value, schema) == ["b", "a", None]
    assert evaluate(spark, cases, source, schema) == ["B", None, None]
