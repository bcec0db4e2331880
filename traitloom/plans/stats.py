"""Job 4: profile of the integrated table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from traitloom.operators.profile import (
    flag_frequencies,
    flag_numbers,
    frequency_table,
    numeric_states,
    overall_frequencies,
    overall_numbers,
)
from traitloom.plans.spec import DEFAULT_SPEC, TraitSpec
from traitloom.sources.writers import write_snapshot


def _profiles(states: DataFrame, frequencies: DataFrame, spec: TraitSpec, digits: int) -> dict[str, DataFrame]:
    return {
        "overall_stats_for_quant_atts": overall_numbers(states, digits),
        "site_stats_for_quant_atts": flag_numbers(states, spec.sites, digits),
        "overall_stats_for_qual_atts": overall_frequencies(frequencies),
        "site_stats_for_qual_atts": flag_frequencies(frequencies, spec.sites),
    }


def _bases(traits: DataFrame, spec: TraitSpec) -> dict[str, DataFrame]:
    """The two small tables all profiles are made of; each takes one pass over the traits."""
    return {
        "states": numeric_states(traits, spec.numeric_profile, spec.sites),
        "frequencies": frequency_table(traits, spec.categorical_profile, spec.sites),
    }


def profiles(traits: DataFrame, spec: TraitSpec = DEFAULT_SPEC, digits: int = 3) -> dict[str, DataFrame]:
    """The four profile tables by name."""
    return _profiles(**_bases(traits, spec), spec=spec, digits=digits)


def write_profiles(
    traits: DataFrame, folder: str, run_date: datetime.date | str, spec: TraitSpec = DEFAULT_SPEC, digits: int = 3
) -> dict[str, str]:
    """Write the four tables as CSV snapshots of the day, a missing value as ``NA``.

    They come from two small tables, which are written next to them and read back: the large table is gone through twice, not
    four times, whatever happens to the executors in between.
    """
    day = {}
    for name, table in _bases(traits, spec).items():
        path = write_snapshot(table, f"{folder}/{name}", run_date)
        day[name] = traits.sparkSession.read.schema(table.schema).parquet(f"{path}/run_date={run_date}")
    return {
        name: write_snapshot(table, f"{folder}/{name}", run_date, "csv", na_text="NA")
        for name, table in _profiles(**day, spec=spec, digits=digits).items()
    }
