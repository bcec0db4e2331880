"""What several operators share: reading tables, shared folders, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.sources.scratch import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ref(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, limit: int) -> bool:
    """Whether a table has at most ``limit`` rows. Decides how a join is done, never what it returns."""
    return df.limit(limit + 1).count() <= limit


#: Rows of a batch that are worked on and handed back together.
ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``rows``. The memory of a batch goes back to the system before the next one is read: a
    worker lives on after its task, and would keep the most it ever had.

    That takes a caller that holds on to no batch when it asks for the next.
    """
    pool = pa.default_memory_pool()
    for whole in batches:
        for first in range(0, whole.num_rows, rows):
            yield whole.slice(first, rows)
            pool.release_unused()
        del whole
    pool.release_unused()


def with_columns(
    docs: DataFrame,
    inputs: Sequence[str],
    new: StructType,
    make: Callable[[], Callable[..., Sequence[pa.Array]]],
) -> DataFrame:
    """The rows with new columns computed from some of theirs, in Arrow batches.

    ``make()`` is called once per task and returns a function that takes the input columns of a batch and returns the new
    ones. All other columns stay; a column that has the name of a new one (in any case) is replaced. An input that is
    replaced is read first.
    """
    taken = {f.name.lower() for f in new.fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in kept]
    # An input that stays is sent to the worker once, under its own name.
    hidden = {name: f"__in{i}" for i, name in enumerate(inputs) if names.count(name) != 1}
    sent = [*names, *hidden.values()]
    places = [sent.index(hidden.get(name, name)) for name in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches, ROWS):
            columns = batch.columns
            made = work(*[columns[at] for at in places])
            yield pa.RecordBatch.from_arrays([*columns[: len(names)], *made], names=[*names, *new.names])
            del batch, columns, made

    given = [ref(name).alias(h) for name, h in hidden.items()]
    return docs.select(*[ref(n) for n in names], *given).mapInArrow(run, StructType([*kept, *new.fields]))


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write go at once instead of when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
