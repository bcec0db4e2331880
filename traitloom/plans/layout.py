"""Cleaned entries stored by species, so that everything behind them is local to a bucket.

The wide tables, the lists of what has no column and the join of the wide tables all work by species. Stored in buckets of the
species, the entries are shuffled once, when they are written; pivots, lists and the join then read buckets side by side, without
an exchange. Each raw record is cleaned once. Buckets are a property of a catalog table; a species lies in one bucket, as
its row in the wide tables lies in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.functions.nulls import not_in
from traitloom.operators.aggregates import mean_by
from traitloom.operators.columns import ref
from traitloom.plans.numbers import distinct_measurements
from traitloom.plans.spec import DEFAULT_SPEC, TraitSpec
from traitloom.plans.text import text_entries


def _store(rows: DataFrame, folder: str, buckets: int) -> DataFrame:
    """The rows as a catalog table of this session, in ``buckets`` buckets by species, below ``folder``."""
    name = f"entries_{uuid.uuid4().hex}"
    written = rows.repartition(buckets, "species").write.bucketBy(buckets, "species").sortBy("species")
    written.option("path", folder).mode("overwrite").saveAsTable(name)
    return rows.sparkSession.table(name)


def store_text(records: DataFrame, folder: str, buckets: int, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``species, name, value, DataName``: the different text entries. ``DataName`` is kept where the name has no column."""
    entries = text_entries(records, spec).select("species", F.coalesce("trait_units", F.lit("NA")).alias("name"), "value", "DataName")
    unlisted = not_in(F.col("name"), spec.text_columns)
    return _store(entries.withColumn("DataName", F.when(unlisted, F.col("DataName"))).distinct(), folder, buckets)


def store_numbers(records: DataFrame, folder: str, buckets: int, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``species, name, value``: the mean of every measured trait and unit, equal measurements in different raw rows each counted."""
    means = mean_by(distinct_measurements(records, spec), ["species", "trait_units"], "value", "value")
    return _store(means.withColumnRenamed("trait_units", "name"), folder, buckets)


def _cells(columns: Sequence[str], cell) -> list:
    return [cell(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in columns]


def stored_wide_text(stored: DataFrame, spec: TraitSpec = DEFAULT_SPEC, sep: str = "; ") -> DataFrame:
    """``wide_text`` from stored entries."""
    wide = stored.groupBy("species").agg(*_cells(spec.text_columns, F.collect_set))
    texts = [F.when(F.size(ref(c)) > 0, F.array_join(F.sort_array(ref(c)), sep)).alias(c) for c in spec.text_columns]
    return wide.select("species", *texts)


def stored_wide_numbers(stored: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``wide_numbers`` from stored means."""
    return stored.groupBy("species").agg(*_cells(spec.number_columns, F.max))


def stored_unmapped_text(stored: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``unmapped_text`` from stored entries."""
    rows = stored.filter(not_in(F.col("name"), spec.text_columns))
    return rows.select("species", F.col("name").alias("trait_units"), "DataName", "value")


def stored_unmapped_numbers(stored: DataFrame, spec: TraitSpec = DEFAULT_SPEC) -> DataFrame:
    """``unmapped_numbers`` from stored means."""
    rows = stored.filter(~F.col("name").isin(list(spec.number_columns)))
    return rows.select("species", F.col("name").alias("trait_units"), F.col("value").alias("value_entry"))
