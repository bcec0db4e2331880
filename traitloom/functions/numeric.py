"""Numbers written as text, and units."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitloom.functions.recode import lookup, recode

# A value is a number exactly when it matches this pattern. Casting alone is not enough: engines disagree on spellings
# such as 1d, 0x1F and 1_0.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_number(column: Column) -> Column:
    """TRUE or FALSE for text, FALSE for a missing value: the switch between the text and the number branch.

    Whatever matches the pattern can be cast, so the cast need not be tried as well (failing casts are slow).
    """
    return F.coalesce(column.rlike(NUMBER_PATTERN), F.lit(False))


def to_number(column: Column) -> Column:
    """The text as a double, NULL when it is not a number. Never raises, also under ANSI mode."""
    return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))


class UnitRule(NamedTuple):
    """``value * multiply / divide`` expressed in ``to_unit``."""

    from_unit: str
    to_unit: str
    multiply: float = 1.0
    divide: float = 1.0


def convert_value(value: Column, unit: Column, rules: Sequence[UnitRule]) -> Column:
    """Value in its target unit; case-sensitive, unchanged for a unit without a rule or a missing unit."""
    times = lookup(unit, {rule.from_unit: rule.multiply for rule in rules if rule.multiply != 1.0})
    over = lookup(unit, {rule.from_unit: rule.divide for rule in rules if rule.divide != 1.0})
    return value * F.coalesce(times, F.lit(1.0)) / F.coalesce(over, F.lit(1.0))


def convert_unit(unit: Column, rules: Sequence[UnitRule]) -> Column:
    """Name of the target unit; a unit without a rule keeps its name."""
    return recode(unit, {rule.from_unit: rule.to_unit for rule in rules})
