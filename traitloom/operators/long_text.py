"""Text collapse for groups of any size: every group in pieces of a bounded length, cut where the lengths say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitloom.operators.aggregates import collapse_entries, join_entries
from traitloom.operators.columns import ref
from traitloom.sources.scratch import scratch_folder

#: Bytes of a piece, about; a cell of Spark holds 2 GB at most.
PIECE_BYTES = 64 << 20


def collapse_long(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order_by: Sequence[str] = (),
    sep: str = "; ",
    piece_bytes: int = PIECE_BYTES,
    distinct: bool = False,
) -> DataFrame:
    """``keys``, ``piece`` (from 0) and ``text``: the pieces of a group in line, with ``sep`` between them, are its collapsed text.

    The result of ``collapse_text`` without its limit. Equal entries are counted first, on both sides of a shuffle, with the
    bytes they take; the bytes of a group say whether it is one piece. Only groups that are more go through an ordering over
    tasks: their counted entries, not the input, are range-partitioned, lengths are added up within the tasks and then over
    them, and entry ``e`` is in piece ``floor((bytes up to its end - 1) / piece_bytes)``. A group with a third of all rows, or an
    entry that occurs very often, is spread over tasks. A piece has at most twice ``piece_bytes``, unless one entry is longer.
    """
    spark = df.sparkSession
    names = [ref(k) for k in keys]
    entries = collapse_entries(df, keys, value, order_by, distinct)
    shown = F.coalesce(F.col("__entry")["__v"], F.lit("NA"))
    entries = entries.withColumn("__len", (F.octet_length(shown) + F.octet_length(F.lit(sep))).cast("long"))
    folder = scratch_folder(spark, "entries")
    entries.write.parquet(folder)
    entries = spark.read.schema(entries.schema).parquet(folder)

    same = [ref(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    sizes = entries.groupBy(*names).agg(F.sum(F.col("__n") * F.col("__len")).alias("__bytes"))
    large = sizes.filter(F.col("__bytes") > piece_bytes).select(*[ref(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    pair = F.collect_list(F.struct("__entry", "__n"))
    small = entries.join(large, condition, "left_anti").groupBy(*names).agg(join_entries(pair, sep=sep).alias("text"))
    small = small.select(*names, F.lit(0).cast("long").alias("piece"), "text")
    if large.isEmpty():
        return small

    # An entry that alone fills more than a piece is cut in parts of whole repetitions.
    most = F.greatest(F.lit(1), F.floor(F.lit(piece_bytes) / F.col("__len")).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.ceil(F.col("__n") / most).cast("int") - 1)).alias("__at")
    cut = entries.join(large, condition, "left_semi").select(*names, "__entry", "__n", "__len", most.alias("__most"), parts)
    cut = cut.withColumn("__n", F.least("__most", F.col("__n") - F.col("__at") * F.col("__most")))
    ordered = cut.repartitionByRange(*names, "__entry", "__at").withColumn("__task", F.spark_partition_id())
    dealt = scratch_folder(spark, "dealt")
    ordered.write.parquet(dealt)
    ordered = spark.read.schema(ordered.schema).parquet(dealt)

    length = F.col("__n") * F.col("__len")
    within = Window.partitionBy(*names, "__task").orderBy("__entry", "__at")
    over = Window.partitionBy(*names).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy(*names, "__task").agg(F.sum(length).alias("__sum"))
    before = totals.select(
        *[ref(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__task").alias("__t"),
        F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"),
    )
    placed = ordered.withColumn("__end", F.sum(length).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(before, condition & (F.col("__task") == F.col("__t")))
    piece = F.floor((F.col("__before") + F.col("__end") - 1) / piece_bytes).cast("long")
    # Sorted by entry; parts of one entry that share a piece are the same text.
    pieces = placed.groupBy(*names, piece.alias("piece")).agg(join_entries(pair, sep=sep).alias("text"))
    return small.unionByName(pieces.select(*names, "piece", "text"))
