"""Left-join enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.operators.columns import project, ref, rename_strict, require


def left_enrich(left: DataFrame, right: DataFrame, on: str = "species") -> DataFrame:
    """Keep every left row and attach the matching right columns.

    The key appears once; other names both sides share get ``.x`` and ``.y``. Spark chooses between broadcast and shuffle
    from the size of the right side, and adaptive execution splits a hot key of the left side if the right side comes
    from storage (one just grouped by the key belongs in ``left_enrich_all``). Right keys are never missing here, so
    plain equality treats a missing left key as unmatched.
    """
    require(left, [on])
    require(right, [on])
    shared = [name for name in left.columns if name != on and name in right.columns]
    if shared:
        left = rename_strict(left, {name: f"{name}.x" for name in shared})
        right = rename_strict(right, {name: f"{name}.y" for name in shared})
    order = [*left.columns, *[name for name in right.columns if name != on]]
    return project(left.join(right, on, "left"), order)


def left_enrich_all(left: DataFrame, rights: Sequence[DataFrame], on: str = "species") -> DataFrame:
    """Attach several one-row-per-key tables with a single join of the left side.

    The right tables are merged first (a union and one grouping by key). The left table, the one that may be large and
    have hot keys, is then shuffled at most once: Spark may broadcast the merged table if it is small, and otherwise
    adaptive execution splits a hot key, which it refuses to do inside a chain of joins on the same key. It also needs
    a shuffle directly below the join on either side; grouping by key *and* its hash keeps the merge from passing for
    one. A right table with two rows for a key breaks the merge and is reported as an error, not resolved by chance.
    """
    require(left, [on])
    columns: list[str] = []
    for right in rights:
        require(right, [on])
        columns += [name for name in right.columns if name != on]
    repeated = {name for name in columns if columns.count(name) > 1 or name in left.columns}
    if repeated:
        raise ValueError(f"columns in more than one table: {', '.join(sorted(repeated))}")

    marked = [
        right.filter(ref(on).isNotNull()).withColumn(f"__side_{i}", F.lit(1)) for i, right in enumerate(rights)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    once = F.lit(True)
    for i in range(len(rights)):
        once = once & (F.coalesce(F.sum(f"__side_{i}"), F.lit(0)) <= 1)
    merged = (
        stacked.groupBy(ref(on), F.xxhash64(ref(on)).alias("__hash"))
        .agg(once.alias("__once"), *[F.max(ref(name)).alias(name) for name in columns])
        .filter(F.when(F.col("__once"), True).otherwise(
            F.raise_error(F.concat(F.lit(f"more than one row for {on} "), ref(on).cast("string"))).cast("boolean")
        ))
        .drop("__once", "__hash")
    )
    return left_enrich(left, merged, on)
