"""The two wrangling jobs and the number test against plain Python on random input."""

import random
import re

import pytest
from pyspark.sql import functions as F

from traitloom.functions.numeric import NUMBER_PATTERN, is_number, to_number
from traitloom.plans.numbers import unmapped_numbers, wide_numbers
from traitloom.plans.spec import DEFAULT_SPEC as S
from traitloom.plans.text import unmapped_text, wide_text

from test_jobs import RAW

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def random_records(rng, n):
    names = ["Abies", "Abies alba", "Abies alba Mill.", "Pinus nigra", "Pinus  nigra", "", None, "Hot one"]
    labels = [d for t in (S.text_traits, S.number_traits) for members in t.values() for d in members]
    labels += [*S.excluded_text_names, S.excluded_number_name, "Unknown", None]
    values = [*S.value_fixes, "Not available", "NOT APPLICABLE", "", None, "tree", "Tree", "1", "12", "01", "5.5", " 7 ", "1e2",
              "0x1F", "Inf", "NaN", "13", "-3"]
    units = [*{r.from_unit for r in S.unit_rules}, "MG", "month", "Month", "", "", "", None, "g"]
    out = []
    for i in range(n):
        species = "Hot one" if i % 3 == 0 else rng.choice(names)
        out.append((rng.choice([59, 26, 335, 1, None]), species, rng.choice(["t", "u"]), rng.choice(labels), rng.choice(values),
                    rng.choice(units), rng.choice(["1", "2", "3"])))
    return out


def brute_force(records):
    """Both jobs, record by record, in the order the rules are stated."""
    text, numbers = set(), []
    for trait_id, full, _, name, value, unit, _ in set(records):
        if trait_id not in S.trait_ids:
            continue
        value = S.value_fixes.get(value, value)
        if not value:
            continue
        words = (full.split(" ", 2) if full is not None else []) + [None, None]
        species = " ".join("NA" if w is None else w for w in words[:2])
        if unit == "month" and value in [str(m) for m in range(1, 13)]:
            value = MONTHS[int(value) - 1]
        if not re.search(NUMBER_PATTERN, value):
            value = value.lower()
            if value in S.excluded_values or name in S.excluded_text_names:
                continue
            trait = next((t for t, members in S.text_traits.items() if name in members), None)
            unit = unit.lower() if unit is not None else None
            column = None if unit is None else trait if unit == "" else f"{trait or 'NA'}_{unit}"
            text.add((species, column or "NA", name, value))
        elif name is not None and name != S.excluded_number_name:
            trait = next((t for t, members in S.number_traits.items() if name in members), None)
            number = float(value)
            if unit in ("mg", "g / 1000 seeds"):
                number, unit = number / 1000, "g"
            elif unit in ("1/lb", "1/pound"):
                number, unit = number * 2.2, "1_per_kg"
            unit = {"gr": "g", "1/kg": "1_per_kg", "years": "year", "yr": "year", "yrs": "year", "doy": "day_of_year"}.get(unit, unit)
            numbers.append((species, f"{trait or 'NA'}_{'NA' if unit is None else unit}", number))
    return text, numbers


@pytest.mark.parametrize("seed", [1, 2])
def test_jobs(spark, seed):
    records = random_records(random.Random(seed), 6000)
    df = spark.createDataFrame(records, RAW).repartition(5)
    text, numbers = brute_force(records)

    cells = {}
    for species, column, _, value in text:
        cells.setdefault(species, {})
        if column in S.text_columns:
            cells[species].setdefault(column, set()).add(value)
    want = {s: {c: "; ".join(sorted(v)) for c, v in row.items()} for s, row in cells.items()}
    got = {r.species: {c: r[c] for c in S.text_columns if r[c] is not None} for r in wide_text(df).collect()}
    assert got == want
    assert {tuple(r) for r in unmapped_text(df).collect()} == {
        (s, c, d, v) for s, c, d, v in text if c not in S.text_columns
    }

    sums = {}
    for species, column, number in numbers:
        sums.setdefault((species, column), []).append(number)
    means = {key: sum(v) / len(v) for key, v in sums.items()}
    want = {s: {c: pytest.approx(m) for (t, c), m in means.items() if t == s and c in S.number_columns} for s, _ in means}
    got = {r.species: {c: r[c] for c in S.number_columns if r[c] is not None} for r in wide_numbers(df).collect()}
    assert got == want
    got = {(r.species, r.trait_units): r.value_entry for r in unmapped_numbers(df).collect()}
    assert got == {key: pytest.approx(m) for key, m in means.items() if key[1] not in S.number_columns}


def test_numbers_as_text(spark):
    rng = random.Random(3)
    strings = ["".join(rng.choice("0159.+-eE xdf_") for _ in range(rng.randrange(1, 8))) for _ in range(20000)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    wrong = [
        r
        for r in df.select("s", is_number(F.col("s")), to_number(F.col("s"))).collect()
        if r[1] != bool(re.search(NUMBER_PATTERN, r[0])) or (r[2] != float(r[0]) if r[1] else r[2] is not None)
    ]
    assert not wrong
