"""Descriptive statistics and frequencies, overall and per membership.

Memberships are 0/1 columns that overlap: a row counts in each group it belongs to. The table is read once, however
many groups and variables there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.operators.columns import keep, ref

STATISTICS = ("n", "min", "max", "mean", "sd")


#: Memberships that share one mask. Rows are repeated once for each further mask, so nine memberships repeat none.
MASK_BITS = 12
_STATE = ("n", "mean", "m2", "min", "max")


def numeric_states(df: DataFrame, columns: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Mergeable statistics: ``part, mask, variable, n, mean, m2, min, max``, ``m2`` the sum of squared differences from the mean.

    The memberships of a row are one bit mask, and rows are folded by mask: whatever the number of memberships, a row is read
    and added once, and a task sends at most a row per mask that occurs. A missing value and a NaN are no values. Bit ``i`` of
    part ``p`` is membership ``p * MASK_BITS + i``.
    """
    groups = [flags[i : i + MASK_BITS] for i in range(0, len(flags), MASK_BITS)] or [()]
    bits = [[F.when(ref(flag) == 1, 1 << i).otherwise(0) for i, flag in enumerate(group)] for group in groups]
    masks = [sum(b, F.lit(0)).cast("int") for b in bits]
    values = [ref(name).cast("double") for name in columns]
    values = [F.when(~F.isnan(value), value).alias(f"v{i}") for i, value in enumerate(values)]
    if len(masks) == 1:
        rows = df.select(F.lit(0).alias("part"), masks[0].alias("mask"), *values)
    else:
        rows = df.select(F.posexplode(F.array(*masks)).alias("part", "mask"), *values)
    folds = []
    for i in range(len(columns)):
        value = F.col(f"v{i}")
        results = (F.count(value), F.avg(value), F.var_pop(value) * F.count(value), F.min(value), F.max(value))
        folds.append(F.struct(F.lit(columns[i]).alias("variable"), *[r.alias(s) for r, s in zip(results, _STATE)]))
    folded = rows.groupBy("part", "mask").agg(F.array(*folds).alias("states"))
    return folded.select("part", "mask", F.explode("states").alias("s")).select("part", "mask", "s.*").filter("n > 0")


def _merged(states: DataFrame, digits: int, keys: Sequence[str] = ()) -> DataFrame:
    """The statistics of states put together: squared differences from the common mean, so no large sums are subtracted.

    A group has at most one state per mask, 2 ** MASK_BITS of them.
    """
    parts, n, mean = F.col("parts"), F.col("n"), F.col("mean")
    total = F.aggregate(parts, F.lit(0.0), lambda a, s: a + s["n"] * s["mean"])
    m2 = F.aggregate(parts, F.lit(0.0), lambda a, s: a + s["m2"] + s["n"] * (s["mean"] - mean) * (s["mean"] - mean))
    grouped = states.groupBy(*keys, "variable").agg(
        F.collect_list(F.struct("n", "mean", "m2")).alias("parts"),
        F.sum("n").alias("n"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    # One state is its own mean; the detour over the sum would cost a digit.
    grouped = grouped.withColumn("mean", F.when(F.size(parts) == 1, parts[0]["mean"]).otherwise(total / n))
    results = {"min": F.col("min"), "max": F.col("max"), "mean": mean, "sd": F.when(n > 1, F.sqrt(m2 / (n - 1)))}
    return grouped.select(*keys, "variable", "n", *[F.round(results[s], digits).alias(s) for s in STATISTICS[1:]])


def overall_numbers(states: DataFrame, digits: int = 3) -> DataFrame:
    """n, min, max, mean and sample standard deviation of each variable; one without values has no row."""
    return _merged(states.filter("part = 0"), digits)


def flag_numbers(states: DataFrame, flags: Sequence[str], digits: int = 3, tag: str = "site") -> DataFrame:
    """The same per membership, its name in the first column. Only the states are repeated, never the rows behind them."""
    names = F.array(*[F.lit(flag) for flag in flags])
    places = F.sequence(F.lit(0), F.lit(MASK_BITS - 1))
    held = F.filter(places, lambda i: F.get(F.split(F.reverse(F.bin("mask")), ""), i) == "1")
    at = F.explode(F.transform(held, lambda i: F.col("part") * MASK_BITS + i))
    return _merged(states.select(at.alias("at"), "*").withColumn(tag, F.get(names, F.col("at"))), digits, [tag])


def numeric_profile(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """n, min, max, mean and sample standard deviation of each column.

    One aggregation without a key: every task sends a single row.
    """
    folds, rows = [], []
    for i, name in enumerate(columns):
        number = ref(name).cast("double")
        value = F.when(~F.isnan(number), number)
        results = (F.count(value), F.min(value), F.max(value), F.avg(value), F.stddev_samp(value))
        folds += [result.alias(f"v{i}_{statistic}") for result, statistic in zip(results, STATISTICS)]
        rounded = [F.round(f"v{i}_{statistic}", digits).alias(statistic) for statistic in STATISTICS[1:]]
        rows.append(F.struct(F.lit(name).alias("variable"), F.col(f"v{i}_n").alias("n"), *rounded))
    return df.agg(*folds).select(F.explode(F.array(*rows)).alias("row")).select("row.*").filter("n > 0")


def numeric_profile_by_flag(
    df: DataFrame, columns: Sequence[str], flags: Sequence[str], digits: int = 3, tag: str = "site"
) -> DataFrame:
    """The same per membership, its name in the first column: one scan, no row repeated (up to ``MASK_BITS`` memberships)."""
    return flag_numbers(numeric_states(df, columns, flags), flags, digits, tag)


def frequency_table(df: DataFrame, columns: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """(variable, value, count) plus one count column per membership, in one pass.

    The rows are repeated once per variable, not once per variable and membership, and summed before the shuffle, so a
    value held by a third of the rows is one row per task.
    """
    return (
        df.select(*[ref(name).cast("string").alias(name) for name in columns], *[ref(flag) for flag in flags])
        .unpivot([ref(flag) for flag in flags], [ref(name) for name in columns], "variable", "value")
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("count"), *[F.count_if(ref(flag) == 1).alias(flag) for flag in flags])
    )


def overall_frequencies(table: DataFrame) -> DataFrame:
    return keep(table, ["variable", "value", "count"])


def flag_frequencies(table: DataFrame, flags: Sequence[str], tag: str = "site") -> DataFrame:
    """One row per membership, variable and value that occurs there."""
    return (
        table.drop("count")
        .unpivot(["variable", "value"], [ref(flag) for flag in flags], tag, "count")
        .filter("count > 0")
        .select(tag, "variable", "value", "count")
    )


def frequency_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column; a missing value is listed as such."""
    return overall_frequencies(frequency_table(df, columns))


def frequency_profile_by_flag(
    df: DataFrame, columns: Sequence[str], flags: Sequence[str], tag: str = "site"
) -> DataFrame:
    return flag_frequencies(frequency_table(df, columns, flags), flags, tag)
