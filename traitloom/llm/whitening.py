"""Whitening of embeddings with a covariance weighted by how often each vector occurs.

Entries become whole numbers ``floor(64 * c) + 1000000``; vectors whose numbers agree are one vector with a multiplicity.
Each such vector is packed into the fewest bytes that hold it, so equal vectors have equal bytes and the grouping moves a
byte an entry for ordinary embeddings. The multiplicities are the weights of the fit: sums are exact whole numbers, the
covariance is a weighted matrix product of centred blocks, one small matrix a task, added up in Spark. Only that matrix, its
size set by the dimension, reaches the driver. Every distinct vector is whitened once and joined back to its rows.

A vector may occur any number of times. Its rows carry a part number dealt out row by row when they are packed, counts are
taken per vector and part, and the way back is by vector and part, so that no task gets all rows of a frequent vector.

Vectors that are null, or hold null or non-finite entries, take no part. Neither do vectors with another length than the most
frequent one (the longer among equals), vectors without entries, and those with an entry of 2**46 or more, which has no exact
number. Rows with an equal or null id are rows like any other. Components whose eigenvalue is zero to double precision (fewer
different vectors than dimensions) cannot be whitened and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.llm.common import ref, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows of one vector that go the same way, about; a vector with more is dealt over several tasks.
PART_ROWS = 50_000
#: Vectors that are worked on together.
_BLOCK = 2_048
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_LIMIT = 2.0**52


def pack(units: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of four widths that holds them all, after a byte that names it."""
    low, high = int(units.min()), int(units.max())
    for code, kind in enumerate(_WIDTHS):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return bytes([code]) + units.astype(kind).tobytes()
    raise AssertionError


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=_WIDTHS[data[0]], offset=1).astype(np.int64)


def packed_rows(vectors: DataFrame, id_column: str, vector: str, parts: int) -> DataFrame:
    """``id, part, dims, key`` of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at, keys, dims = [], [], []
            for i, entries in enumerate(batch["vector"]):
                if not entries.is_valid or not len(entries.values) or entries.values.null_count:
                    continue
                numbers = np.floor(SCALE * entries.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(numbers).all() and np.abs(numbers).max() < _LIMIT:
                    at.append(i)
                    keys.append(pack(numbers.astype(np.int64)))
                    dims.append(len(numbers))
            part = (seen + np.arange(len(at))) % parts
            seen += len(at)
            columns = [batch["id"].take(pa.array(at, pa.int64())), pa.array(part, pa.int32()), pa.array(dims, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary())], ["id", "part", "dims", "key"])

    given = vectors.select(ref(id_column).alias("id"), ref(vector).cast("array<double>").alias("vector"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, part int, dims int, key binary")


def _blocks(batches, *columns: str) -> Iterator[tuple]:
    for whole in batches:
        for first in range(0, whole.num_rows, _BLOCK):
            batch = whole.slice(first, _BLOCK)
            if batch.num_rows:
                yield tuple(batch[c] for c in columns)


def _added(sums: DataFrame, width: int) -> np.ndarray:
    """Rows ``at, values`` with the same ``at`` added up, in Spark; the driver gets one row for each."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, values in zip(batch["at"].to_pylist(), batch["values"]):
                row = values.values.to_numpy()
                total[at] = total[at] + row if at in total else row.copy()
        rows = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array([total[r] for r in rows], pa.list_(pa.float64()))], ["at", "values"]
        )

    found = sums.repartition("at").mapInArrow(add, sums.schema).collect()
    out = np.zeros((width, width))
    for row in found:
        out[row["at"]] = row["values"]
    return out


def weighted_products(distinct: DataFrame, width: int, centred: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """The sum over ``key, weight`` of weight times the outer product of the centred vector with itself."""

    def run(batches):
        total = np.zeros((width, width))
        for keys, weights in _blocks(batches, "key", "weight"):
            block = centred(keys.to_pylist())
            total += (block * weights.to_numpy()[:, None]).T @ block
        if total.any():
            columns = [pa.array(np.arange(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["at", "values"])

    return _added(distinct.select("key", "weight").mapInArrow(run, "at int, values array<double>"), width)


def exact_sums(distinct: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every dimension, as whole numbers of any size."""

    def run(batches):
        # High and low halves are added apart: neither can leave 64 bits.
        high, low, n = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64), 0
        for keys, weights in _blocks(batches, "key", "weight"):
            units, w = np.stack([unpack(k) for k in keys.to_pylist()]), weights.to_numpy()
            high += ((units >> 26) * w[:, None]).sum(axis=0)
            low += ((units & ((1 << 26) - 1)) * w[:, None]).sum(axis=0)
            n += int(w.sum())
        counts = pa.array([n] * width, pa.int64())
        columns = [pa.array(np.arange(width), pa.int32()), pa.array(high), pa.array(low), counts]
        yield pa.RecordBatch.from_arrays(columns, ["at", "high", "low", "n"])

    made = distinct.select("key", "weight").mapInArrow(run, "at int, high long, low long, n long")
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
    found = {r["at"]: r for r in made.groupBy("at").agg(*sums).collect()}
    n = int(found[0]["n"])
    return n, [(int(found[i]["high"]) << 26) + int(found[i]["low"]) + n * SHIFT for i in range(width)]


@dataclass(frozen=True)
class Whitener:
    """The fit: count, exact sums, unit eigenvectors as columns by falling eigenvalue, and their shares of the variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and remainder (below ``n``) of the mean."""
        whole, rest = zip(*[divmod(s, self.n) for s in self.sums])
        return np.array(whole, dtype=np.int64), np.array(rest, dtype=np.int64)

    def centred(self, keys: list[bytes]) -> np.ndarray:
        whole, rest = self.parts()
        units = np.stack([unpack(k) for k in keys])
        return (units + SHIFT - whole).astype(np.float64) - rest / self.n

    def deviations(self, keys: list[bytes]) -> list[int | None]:
        """The sum of ``(n * x - S) ** 2``, exactly; null where a long cannot hold it."""
        whole, rest = self.parts()
        units = np.stack([unpack(k) for k in keys]) + SHIFT - whole
        most = float(self.n) * (float(np.abs(units).max()) + 1)
        if most * most * units.shape[1] < 2.0**62:
            return ((units * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((int(u) * self.n - int(r)) ** 2 for u, r in zip(row, rest)) for row in units]
        return [e if e < 1 << 63 else None for e in exact]

    def whitened(self, keys: list[bytes]) -> np.ndarray:
        return self.centred(keys) @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitener:
    """The whitener of a table of distinct vectors ``key, weight``."""
    n, sums = exact_sums(distinct, width)
    bare = Whitener(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    covariance = weighted_products(distinct, width, bare.centred) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > width * np.finfo(np.float64).eps * max(values.max(), 0.0)]
    return Whitener(n, sums, vectors[:, order], values[order], float(np.trace(covariance)))


def identity_error(distinct: DataFrame, model: Whitener) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity; centred by its own mean first."""
    width = len(model.values)

    def mean(batches):
        total = np.zeros(width)
        for keys, weights in _blocks(batches, "key", "weight"):
            total += weights.to_numpy() @ model.whitened(keys.to_pylist())
        columns = [pa.array(np.arange(width), pa.int32()), pa.array(total)]
        yield pa.RecordBatch.from_arrays(columns, ["at", "value"])

    made = distinct.select("key", "weight").mapInArrow(mean, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    centre = np.zeros(width)
    for row in made.collect():
        centre[row["at"]] = row["value"] / model.n
    products = weighted_products(distinct, width, lambda keys: model.whitened(keys) - centre)
    return float(np.abs(products / model.n - np.eye(width)).max())


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``id, n, deviation, whitened array, explained array, identity_error``: one row per row that takes part.

    The arrays hold components 1, 2, ... in order. Nothing comes back where no vector takes part or all are equal.
    """
    spark = vectors.sparkSession
    parts = max(1, -(-vectors.count() // part_rows))
    packed = written(packed_rows(vectors, id_column, vector, parts), "packed")
    kind = packed.schema["id"].dataType.simpleString()
    lengths = packed.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    schema = f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    width = lengths["dims"]
    rows = packed.filter(F.col("dims") == width).select("id", "part", "key")
    counted = written(rows.groupBy("key", "part").agg(F.count("*").alias("rows")), "counted")
    distinct = written(counted.groupBy("key").agg(F.sum("rows").alias("weight")), "distinct")
    model = fit(distinct, width, components)
    if not len(model.values):
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, model)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for (keys,) in _blocks(batches, "key"):
            data = keys.to_pylist()
            columns = [keys, pa.array(model.deviations(data), pa.int64())]
            columns.append(pa.array(list(model.whitened(data)), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, ["key", "deviation", "whitened"])

    done = distinct.select("key").mapInArrow(run, "key binary, deviation long, whitened array<double>")
    by_part = counted.select("key", "part").join(done, "key")
    found = rows.join(by_part, ["key", "part"])
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return found.select(
        "id",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
