"""Training order: a keyed permutation gives every sequence a global slot, slot ranges become shards of fixed-size records."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm.common import ref, shuffles_released
from traitloom.llm.tokens import mix

#: Bytes of a record: document id, number of the sequence in it, tokens in use; then the tokens, padded with zeros.
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("tokens", "<u4")])
ROW_TOKENS = 496
#: Records of a shard (32 MB with one-byte tokens), and how many parts the slots are shuffled in, one after the other.
SHARD_ROWS, WAVES = 1 << 16, 4
#: Records that are read from a shard at once.
READ_RECORDS = 4096
ROUNDS = 6
NO_ID = np.iinfo(np.int64).min


class Permutation:
    """A keyed bijection on ``range(size)``.

    A Feistel network on pairs (left, right), left below ``a`` and right below ``b``, both about the square root of the
    size; each round adds a keyed hash of one half to the other. The domain is at most ``a`` larger than the size: values that
    land beyond it are sent through again until they do not (cycle walking), which ends because the network is a bijection.
    """

    def __init__(self, size: int, key: int):
        self.size = size
        self.a = math.isqrt(max(size - 1, 0)) + 1
        self.b = -(-size // self.a) if size else 1
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key % (1 << 64)))

    def _once(self, value: np.ndarray) -> np.ndarray:
        a, b = np.uint64(self.a), np.uint64(self.b)
        left, right = value // b, value % b
        for i, key in enumerate(self.keys):
            if i % 2 == 0:
                left = (left + mix(right ^ key) % a) % a
            else:
                right = (right + mix(left ^ key) % b) % b
        return left * b + right

    def slots(self, index: np.ndarray) -> np.ndarray:
        value = self._once(index.astype(np.uint64))
        out = np.flatnonzero(value >= np.uint64(self.size))
        while len(out):
            value[out] = self._once(value[out])
            out = out[value[out] >= np.uint64(self.size)]
        return value.astype(np.int64)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(folder: str, shard: int, data: bytes) -> str:
    """Writes a shard under its final name in one step.

    The folder was empty when the run began, so a shard that is there is from another attempt, which wrote the same bytes.
    """
    files, base = _open(folder)
    path = shard_path(base, shard)
    there = files.get_file_info(path)
    if there.type != pa.fs.FileType.File or there.size != len(data):
        files.create_dir(base, recursive=True)
        draft = f"{base}/_draft-{shard:08d}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as stream:
            stream.write(data)
        files.move(draft, path)
    return shard_path(folder, shard)


def _require_empty(folder: str) -> None:
    files, base = _open(folder)
    if files.get_file_info(pa.fs.FileSelector(base, allow_not_found=True)):
        raise FileExistsError(f"{folder} is not empty: shards of another run would be read with the new ones")


def materialise(
    sequences: DataFrame,
    folder: str,
    key: int,
    id_column: str = "doc_id",
    tokens: str = "tokens",
    token_bytes: int = 1,
    row_tokens: int = ROW_TOKENS,
    shard_rows: int = SHARD_ROWS,
    waves: int = WAVES,
) -> DataFrame:
    """Writes all token sequences in permuted order; returns ``shard, first_slot, rows, path`` of every shard.

    ``tokens`` is a binary column of little-endian ids, ``token_bytes`` each. Every document is cut into sequences of
    ``row_tokens``, the last one shorter; a null or empty one has none. Sequences are numbered in the order in which the
    input is read (partition by partition, counted first), and ``Permutation`` makes slots of the numbers. Should the second
    reading be split differently, as when the cluster changed in between, the counts do not agree and the job fails instead
    of giving a slot twice. The slots are taken in ``waves`` ranges, each shuffled by shard and written before the next.
    A null id is kept as null; repeated rows are sequences of their own. Other columns are not carried. ``folder`` must be
    new or empty. A path without a scheme is one of Spark's default file system, on the executors as well. The manifest is
    written last, when all shards are there; the readers go by it.
    """
    spark = sequences.sparkSession
    folder = qualified(spark, folder)
    _require_empty(folder)
    step = row_tokens * token_bytes
    source = sequences.select(ref(id_column).cast("long").alias("id"), ref(tokens).cast("binary").alias("tokens"))
    size = F.ceil(F.coalesce(F.octet_length("tokens"), F.lit(0)) / step).cast("long")
    counted = source.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(size).alias("n")).collect()
    counts = {row["part"]: row["n"] for row in counted}
    offsets, total = {}, 0
    for part in sorted(counts):
        offsets[part] = total
        total += counts[part]
    order = Permutation(total, key)
    shards = -(-total // shard_rows)

    def cut(first_shard: int, last_shard: int):
        low, high = first_shard * shard_rows, last_shard * shard_rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            at, seen = offsets.get(part, 0), 0
            for batch in batches:
                ids, values = batch.column(0).fill_null(NO_ID).to_numpy(), batch.column(1)
                lengths = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in values], dtype=np.int64)
                n = -(-lengths // step)
                rows = np.repeat(np.arange(len(n)), n)
                parts = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
                slots = order.slots(at + seen + np.arange(len(rows)))
                seen += len(rows)
                mine = np.flatnonzero((slots >= low) & (slots < high))
                rows, parts, slots = rows[mine], parts[mine], slots[mine]
                used = np.minimum(lengths[rows] - parts * step, step)
                head = np.zeros(len(rows), dtype=HEAD)
                head["doc_id"], head["part"], head["tokens"] = ids[rows], parts, used // token_bytes
                heads = head.tobytes()
                records = []
                for k, (row, p) in enumerate(zip(rows.tolist(), parts.tolist())):
                    body = values[row].as_buffer().slice(p * step, int(used[k]))
                    records.append(heads[k * HEAD.itemsize : (k + 1) * HEAD.itemsize] + body.to_pybytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots // shard_rows), pa.array(slots), pa.array(records, pa.binary())], names=["shard", "slot", "record"]
                )
            if seen != counts.get(part, 0):
                raise RuntimeError(f"partition {part} has {seen} sequences, {counts.get(part, 0)} were counted: read again")

        return run

    stride = HEAD.itemsize + step

    def write(key, table):
        shard = key[0].as_py()
        slots = table["slot"].to_numpy()
        rows = min(shard_rows, total - shard * shard_rows)
        data = np.zeros(rows * stride, dtype=np.uint8)
        place = (slots - shard * shard_rows) * stride
        for at, record in zip(place.tolist(), table["record"]):
            piece = np.frombuffer(record.as_buffer(), dtype=np.uint8)
            data[at : at + len(piece)] = piece
        if len(slots) != rows:
            raise RuntimeError(f"shard {shard} has {len(slots)} of {rows} sequences")
        path = _put(folder, shard, data.tobytes())
        return pa.table(
            {
                "shard": pa.array([shard], pa.int64()),
                "first_slot": pa.array([shard * shard_rows], pa.int64()),
                "rows": pa.array([rows], pa.int64()),
                "path": pa.array([path], pa.string()),
            }
        )

    schema = "shard long, first_slot long, rows long, path string"
    bounds = sorted({shards * w // waves for w in range(waves + 1)})
    done = f"{folder}/done"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(done)
    with shuffles_released(spark):
        for first, last in zip(bounds[:-1], bounds[1:]):
            rows = source.mapInArrow(cut(first, last), "shard long, slot long, record binary")
            rows.groupBy("shard").applyInArrow(write, schema).write.mode("append").parquet(done)
    listed = spark.read.schema(schema).parquet(done)
    if (found := listed.count()) != shards:
        raise RuntimeError(f"{found} of {shards} shards were written")
    listed.write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the file system Spark takes it to be on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


def _listed(folder: str) -> dict[int, int]:
    """Records of every shard of a finished run."""
    files, base = _open(folder)
    if files.get_file_info(f"{base}/manifest").type != pa.fs.FileType.Directory:
        raise FileNotFoundError(f"{folder} has no manifest: the run that writes it has not finished")
    rows = pq.read_table(f"{base}/manifest", filesystem=files, columns=["shard", "rows"])
    return dict(zip(rows["shard"].to_pylist(), rows["rows"].to_pylist()))


def records_of(data: memoryview, first_slot: int, token_bytes: int, row_tokens: int, skip: int = 0) -> Iterator[tuple]:
    """``(slot, document id, part, tokens as bytes)`` of a shard's records in order, from record ``skip`` on."""
    stride = HEAD.itemsize + row_tokens * token_bytes
    for at in range(skip * stride, len(data), stride):
        head = np.frombuffer(data[at : at + HEAD.itemsize], dtype=HEAD)[0]
        start = at + HEAD.itemsize
        yield first_slot + at // stride, int(head["doc_id"]), int(head["part"]), bytes(data[start : start + int(head["tokens"]) * token_bytes])


def read_from(folder: str, slot: int, shard_rows: int = SHARD_ROWS, token_bytes: int = 1, row_tokens: int = ROW_TOKENS):
    """Records from ``slot`` to the end, shard after shard: where to go on after a stop follows from the slot alone.

    The manifest says which shards there are; one that is missing, or has another size, is an error. Reading begins at the
    slot's own place in its shard. A path without a scheme is a local one here.
    """
    files, base = _open(folder)
    listed = _listed(folder)
    stride = HEAD.itemsize + row_tokens * token_bytes
    first, skip = divmod(slot, shard_rows)
    for shard in range(first, len(listed)):
        path = shard_path(base, shard)
        found = files.get_file_info(path)
        if found.type != pa.fs.FileType.File or found.size != listed.get(shard, -1) * stride:
            raise FileNotFoundError(f"{path} is missing or has not the {listed.get(shard, 0)} records the manifest names")
        with files.open_input_file(path) as stream:
            stream.seek(skip * stride)
            at = shard * shard_rows + skip
            while data := stream.read(READ_RECORDS * stride):
                yield from records_of(memoryview(data), at, token_bytes, row_tokens)
                at += len(data) // stride
        skip = 0


READ = "slot long, shard long, byte_offset long, doc_id long, part long, n_tokens long, tokens binary"


def read_shards(
    spark: SparkSession, folder: str, shard_rows: int = SHARD_ROWS, token_bytes: int = 1, row_tokens: int = ROW_TOKENS
) -> DataFrame:
    """Every record of every shard of ``folder``, a shard per task. The files must be those of the manifest, neither fewer nor
    more, each with the size its records make."""
    stride = HEAD.itemsize + row_tokens * token_bytes
    folder = qualified(spark, folder)
    shards = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder)
    number = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    there = shards.select(number.alias("found"), "length")
    if "manifest" not in _names(folder):
        raise FileNotFoundError(f"{folder} has no manifest: the run that writes it has not finished")
    listed = spark.read.parquet(f"{folder}/manifest").select("shard", (F.col("rows") * stride).alias("bytes"))
    wrong = listed.join(there, F.col("shard") == F.col("found"), "full").filter("not (bytes <=> length)").first()
    if wrong is not None:
        raise FileNotFoundError(f"{folder}: shard {wrong['shard']} of {wrong['bytes']} bytes expected, {wrong['found']} of {wrong['length']} found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = int(path.rsplit("-", 1)[1].removesuffix(".bin"))
                rows = []
                for row in records_of(memoryview(content.as_buffer()), shard * shard_rows, token_bytes, row_tokens):
                    rows.append(row)
                    if len(rows) == 4096:
                        yield _batch(rows, shard, shard_rows, stride, token_bytes)
                        rows = []
                if rows:
                    yield _batch(rows, shard, shard_rows, stride, token_bytes)

    return shards.select("path", "content").mapInArrow(run, READ)


def _names(folder: str) -> set[str]:
    files, base = _open(folder)
    return {f.base_name for f in files.get_file_info(pa.fs.FileSelector(base, allow_not_found=True))}


def _batch(rows: list, shard: int, shard_rows: int, stride: int, token_bytes: int) -> pa.RecordBatch:
    slots, ids, parts, tokens = zip(*rows)
    slots = np.array(slots, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(slots),
            pa.array(np.full(len(slots), shard, dtype=np.int64)),
            pa.array((slots - shard * shard_rows) * stride),
            pa.array([None if i == NO_ID else i for i in ids], pa.int64()),
            pa.array(parts, pa.int64()),
            pa.array([len(t) // token_bytes for t in tokens], pa.int64()),
            pa.array(tokens, pa.binary()),
        ],
        names=["slot", "shard", "byte_offset", "doc_id", "part", "n_tokens", "tokens"],
    )
