"""For every 64-bit key found in some text, the smallest owner of that key in the whole corpus.

Texts are dealt into groups of a few megabytes by a hash of id and text. A group sends each of its distinct keys once,
with the smallest owner it has itself, so a key that a third of the texts hold is one entry per group, not one per text.
Keys travel as blocks: sorted, byte by byte, which Spark's block compression packs well. A bucket is a range of the key
space; buckets and groups both follow the size of the corpus, so no task grows with it. What comes back to a group is only
the keys that another group has too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitloom.llm.common import ref

#: UTF-8 bytes of text in a group, about; a longer text is a group of its own size.
GROUP_BYTES = 8 << 20
#: Bytes of text whose keys make up one bucket, about.
BUCKET_BYTES = 16 << 20
NO_OWNER = np.iinfo(np.int64).max

Extract = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]

_BLOCK = "group int, keys binary, owners binary"


def pack(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def deal(docs: DataFrame, id_column: str, text: str, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int, int]:
    """``(group, id, text)`` with null texts as empty ones, the number of groups, the number of buckets."""
    texts = docs.select(ref(id_column).cast("long").alias("id"), F.coalesce(ref(text).cast("string"), F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n"), F.count("*").alias("rows")).first()
    size = (total["n"] or 0) + 64 * total["rows"]
    groups = max(1, -(-size // group_bytes))
    buckets = max(1, -(-size // BUCKET_BYTES))
    return texts.select(F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int").alias("group"), "id", "text"), groups, buckets


def in_order(table: pa.Table) -> pa.Table:
    """Rows of a group in an order that does not depend on how they arrived: by id, nulls last, then by text."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def distinct_keys(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest owner of each, and where each given key is among them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.cumsum(first) - 1
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = at
    starts = np.flatnonzero(first)
    least = np.minimum.reduceat(owners[order], starts) if len(keys) else owners[:0]
    return ordered[starts], least, place


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def shared_keys(groups: DataFrame, buckets: int, extract: Extract) -> DataFrame:
    """``group, keys, owners``: per group the keys that other groups have too, with the smallest owner anywhere."""

    # No annotations here: Spark would read the kind of function off them.
    def send(key, table):
        keys, least, _ = distinct_keys(*extract(in_order(table)))
        bounds = _bounds(keys, buckets)
        rows = [
            (b, key[0].as_py(), pack(keys[lo:hi]), pack(least[lo:hi]))
            for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:]))
            if hi > lo
        ]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.table(
            {
                "bucket": pa.array(columns[0], pa.int32()),
                "group": pa.array(columns[1], pa.int32()),
                "keys": pa.array(columns[2], pa.binary()),
                "owners": pa.array(columns[3], pa.binary()),
            }
        )

    def meet(key, table):
        blocks = [unpack(data, np.uint64) for data in table["keys"].to_pylist()]
        keys = np.concatenate(blocks)
        owners = np.concatenate([unpack(data, np.int64) for data in table["owners"].to_pylist()])
        group = np.repeat(table["group"].to_numpy(), [len(b) for b in blocks])
        del blocks
        _, least, place = distinct_keys(keys, owners)
        live = np.bincount(place, minlength=len(least))[place] > 1
        keys, least, group = keys[live], least[place[live]], group[live]
        order = np.argsort(group, kind="stable")
        keys, least, group = keys[order], least[order], group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
        ends = [*starts[1:], len(group)]
        return pa.table(
            {
                "group": pa.array([group[lo] for lo in starts], pa.int32()),
                "keys": pa.array([pack(keys[lo:hi]) for lo, hi in zip(starts, ends)], pa.binary()),
                "owners": pa.array([pack(least[lo:hi]) for lo, hi in zip(starts, ends)], pa.binary()),
            }
        )

    sent = groups.groupBy("group").applyInArrow(send, f"bucket int, {_BLOCK}")
    return sent.groupBy("bucket").applyInArrow(meet, _BLOCK)


def returned(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The blocks that came back to a group, sorted by key."""
    if not table.num_rows:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    keys = np.concatenate([unpack(data, np.uint64) for data in table["keys"].to_pylist()])
    owners = np.concatenate([unpack(data, np.int64) for data in table["owners"].to_pylist()])
    order = np.argsort(keys, kind="stable")
    return keys[order], owners[order]


def finish(groups: DataFrame, shared: DataFrame, work: Callable[[int, pa.Table, tuple], pa.Table], schema) -> DataFrame:
    """``work(group, rows in order, (shared keys, owners))`` for every group."""

    def run(key, table, back):
        return work(key[0].as_py(), in_order(table), returned(back))

    return groups.groupBy("group").cogroup(shared.groupBy("group")).applyInArrow(run, schema)
