"""CSV with line breaks in quoted text, read by many tasks.

Whether a line break ends a record depends on all quotes before it, so Spark reads such a file as a whole, in one task. Here a
file is cut into Spark's ordinary byte ranges, twice:

1. Every range is gone through for both states it may begin in, outside a quoted field and inside one, and says in which state
   it then ends. Only lines with a quote are looked at. One row a range goes to the driver, which links the ranges of a file up:
   from then on the state at the beginning of every range is known.
2. Every range is cut into records. What a range holds of a record that began before it, or goes on behind it, is put together
   by the key of the range in which the record began.

The records are then parsed by Spark's own CSV parser. A file may have any size; a task holds a line, and a record that spans
ranges, never a range.

A quote opens a field only where a field begins, as in the parser; anywhere else in an unquoted field it is an ordinary
character. Files must be in an encoding that has ASCII bytes for ASCII characters. Ranges are Spark's input splits (see
``spark.sql.files.maxPartitionBytes``); a compressed file is one range.
"""

from __future__ import annotations

import bisect
import csv
import io
import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from traitloom.functions.numeric import is_number
from traitloom.operators.columns import ref, require
from traitloom.sources.scratch import scratch_folder

_CLOSING = re.compile(rb'(?:[^"]|"")*+"(?!")')


def _opening(separator: str) -> re.Pattern:
    """What a line begins with, up to a quoted field that does not end on it: whole fields, quoted or not."""
    s = re.escape(separator.encode())
    return re.compile(rb'(?:(?:"(?:[^"]|"")*+"(?!")[^' + s + rb']*+|(?!")[^' + s + rb"]*+)" + s + rb')*+"(?:[^"]|"")*+\Z')


class Quotes:
    """Whether a line ends inside a quoted field, given whether it begins inside one."""

    def __init__(self, separator: str = ","):
        self.separator, self.opening = separator.encode(), _opening(separator)

    def inside_after(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        if inside:
            closed = _CLOSING.match(line)
            if closed is None:
                return True
            # The rest of the field up to the next separator is ordinary text.
            rest = line[closed.end() :]
            after = rest.find(self.separator)
            return after >= 0 and self.inside_after(rest[after + len(self.separator) :], False)
        return self.opening.match(line) is not None


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for batch in batches:
        for file, start, line in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), batch["line"].to_pylist()):
            yield (file, start), line


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # Only a line feed ends a line here; what else is in the text stays as it is.
    raw = spark.read.option("lineSep", "\n").text(path)
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    return raw.select(*place, F.col("value").cast("binary").alias("line"))


def range_states(spark: SparkSession, path: str | list[str], separator: str = ",") -> DataFrame:
    """``file, start, outside, inside, breaks``: per range with a quote, whether it ends inside a quoted field if it begins
    outside or inside one, and whether, beginning inside, a record ends in it."""

    def run(batches):
        quotes = Quotes(separator)
        state: dict[tuple[str, int], list[bool]] = {}
        for key, line in _ranges(batches):
            now = state.setdefault(key, [False, True, False])
            before = now[1]
            now[0], now[1] = quotes.inside_after(line, now[0]), quotes.inside_after(line, now[1])
            now[2] = now[2] or (before and not now[1])
        rows = list(state.items())
        columns = [[k[0] for k, _ in rows], [k[1] for k, _ in rows], *[[s[i] for _, s in rows] for i in range(3)]]
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        names = ["file", "start", "outside", "inside", "breaks"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    quoted = _lines(spark, path).filter(F.contains("line", F.lit(b'"')))
    return quoted.mapInArrow(run, "file string, start long, outside boolean, inside boolean, breaks boolean")


class Places:
    """The state at the borders of the ranges of every file, and where a record that is open there began.

    Made of one row for each range that holds a quote, less than Spark itself keeps for the range as a task.
    """

    def __init__(self, rows):
        self.files: dict[str, tuple[list[int], list[int]]] = {}
        for file, start, outside, inside, breaks in sorted(rows):
            starts, owners = self.files.setdefault(file, ([], []))
            owner = owners[-1] if owners else -1
            open_after = inside if owner >= 0 else outside
            starts.append(start)
            # A record that is open behind this range began here, unless it came in and did not end here.
            owners.append((start if owner < 0 or breaks else owner) if open_after else -1)

    def owner(self, file: str, start: int) -> int:
        """Start of the range in which the record began that is open where this range begins; -1 if none is."""
        starts, owners = self.files.get(file, ([], []))
        before = bisect.bisect_left(starts, start)
        return owners[before - 1] if before else -1

    def agree(self, file: str, start: int, inside: bool, quoted: bool) -> None:
        """An error if a range is not one of those that were gone through before."""
        starts, owners = self.files.get(file, ([], []))
        at = bisect.bisect_left(starts, start)
        known = at < len(starts) and starts[at] == start
        if quoted != known or quoted and (owners[at] >= 0) != inside:
            raise RuntimeError(f"{file} was cut into other ranges the second time: its content or the session's settings have changed")


_PIECE = "file string, owner long, start long, first boolean, piece binary"


def _pieces(spark: SparkSession, path: str | list[str], names: list[str], separator: str) -> DataFrame:
    """Whole records (``owner`` -1) and parts of records that span ranges, with the start of the range they began in.

    ``first`` marks the first record of a file, which must be the header. Empty lines are no records.
    """
    shared = spark.sparkContext.broadcast(Places([tuple(r) for r in range_states(spark, path, separator).collect()]))
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())

    def run(batches):
        quotes, places = Quotes(separator), shared.value
        out, size = [], 0
        current, owner, lines, inside, quoted, first = None, -1, [], False, False, False

        def leave():
            if current is not None:
                places.agree(*current, inside, quoted)
                if lines:
                    out.append((current[0], owner if owner >= 0 else current[1], current[1], first, b"\n".join(lines)))

        def batch():
            columns = list(zip(*out)) if out else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "owner", "start", "first", "piece"]
            )

        for key, line in _ranges(batches):
            if key != current:
                leave()
                owner = places.owner(*key)
                current, lines, inside, quoted, first = key, [], owner >= 0, False, key[1] == 0
            lines.append(line)
            size += len(line)
            quoted = quoted or b'"' in line
            inside = quotes.inside_after(line, inside)
            if inside:
                continue
            text = b"\n".join(lines).removesuffix(b"\r")
            if owner >= 0 or text:
                if first:
                    check_header(text, names, separator)
                out.append((key[0], owner, key[1], first, text))
                first = False
            lines, owner = [], -1
            if len(out) >= 1024 or size >= 1 << 20:
                yield batch()
                out, size = [], 0
        leave()
        yield batch()

    return _lines(spark, path).mapInArrow(run, _PIECE)


def check_header(record: bytes, names: list[str], separator: str) -> None:
    found = next(csv.reader(io.StringIO(record.decode("utf-8", "replace").removeprefix("\ufeff")), delimiter=separator), [])
    if [n.lower() for n in found] != [n.lower() for n in names]:
        raise ValueError(f"the header names {found}, expected {names}")


@contextmanager
def _same_ranges(spark: SparkSession) -> Iterator[None]:
    """The size of a range would otherwise follow the number of executors there are at the moment."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def land_split_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, folder: str, separator: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """The rows of CSV files with a header, parsed by many tasks a file and written to ``folder`` as Parquet.

    The rows are those that Spark's reader gives for the whole files (``multiLine``, quotes in quoted text doubled), as it
    gives them: a blank field is NULL.
    """
    options = {"sep": separator, "escape": '"'}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)

    def parsed(piece: Column) -> Column:
        text = piece.cast("string") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(piece, encoding)
        return F.from_csv(text, ddl, options)

    whole = F.col("owner") < 0
    with _same_ranges(spark):
        pieces = _pieces(spark, path, [f.name for f in schema], separator)
        landed = pieces.filter(~(whole & F.col("first"))).select(
            "file", "owner", "start", "first", F.when(~whole, F.col("piece")).alias("piece"), F.when(whole, parsed(F.col("piece"))).alias("row")
        )
        landed.write.mode("overwrite").parquet(folder)
    back = spark.read.schema(landed.schema).parquet(folder)
    parts = back.filter(~whole).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("parts"), F.max("first").alias("first")
    )
    line_feed = F.lit(b"\n")
    join = F.aggregate("parts", F.lit(None).cast("binary"), lambda a, p: F.when(a.isNull(), p["piece"]).otherwise(F.concat(a, line_feed, p["piece"])))
    joined = parts.select("first", join.alias("piece"))
    for row in joined.filter("first").select("piece").collect():
        check_header(bytes(row["piece"]), [f.name for f in schema], separator)
    spanning = joined.filter(~F.col("first")).select(parsed(F.col("piece")).alias("row"))
    return back.filter(whole).select("row").unionByName(spanning).select("row.*")


def read_csv_split(spark: SparkSession, path: str | list[str], schema: StructType, **options: str) -> DataFrame:
    """``land_split_csv`` into the shared scratch folder."""
    return land_split_csv(spark, path, schema, scratch_folder(spark, "csv"), **options)


def infer_types(texts: DataFrame) -> StructType:
    """The narrowest of int, bigint, double, boolean, date, timestamp and string for each text column, in one pass.

    Numbers are plain decimals, as everywhere in this library. A column without values is text.
    """
    kinds = {
        "int": lambda c: c.rlike(r"^[+-]?\d{1,10}$") & c.try_cast("int").isNotNull(),
        "bigint": lambda c: c.rlike(r"^[+-]?\d{1,19}$") & c.try_cast("bigint").isNotNull(),
        "double": is_number,
        "boolean": lambda c: F.lower(c).isin("true", "false"),
        "date": lambda c: c.rlike(r"^\d{4}-\d\d-\d\d$") & c.try_cast("date").isNotNull(),
        "timestamp": lambda c: c.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d") & c.try_cast("timestamp").isNotNull(),
    }
    checks = [F.min(fits(ref(n)) | ref(n).isNull()).alias(f"{i}_{kind}") for i, n in enumerate(texts.columns) for kind, fits in kinds.items()]
    found = texts.agg(*checks, *[F.count(ref(n)).alias(f"{i}_n") for i, n in enumerate(texts.columns)]).first()
    chosen = [
        next((kind for kind in kinds if found[f"{i}_{kind}"]), "string") if found[f"{i}_n"] else "string"
        for i in range(len(texts.columns))
    ]
    return StructType([StructField(n, StructType.fromDDL(f"x {kind}")[0].dataType) for n, kind in zip(texts.columns, chosen)])


def read_csv_split_inferred(spark: SparkSession, path: str, types: Mapping[str, DataType] | None = None, separator: str = ",") -> DataFrame:
    """CSV with types inferred from all its values, some of them overridden; blank and ``NA`` are NULL. Parsed once, as text."""
    types = types or {}
    header = spark.read.options(header=True, sep=separator, escape='"', multiLine=False).csv(path).columns
    texts = read_csv_split(spark, path, StructType([StructField(n, StringType()) for n in header]), separator=separator)
    require(texts, types)
    texts = texts.select(*[F.when(F.trim(ref(n)) != "", F.nullif(ref(n), F.lit("NA"))).alias(n) for n in header])
    schema = infer_types(texts.select(*[ref(n) for n in header if n not in types])) if set(header) - set(types) else StructType([])
    kinds = {f.name: f.dataType for f in schema} | dict(types)
    return texts.select(*[ref(n).try_cast(kinds[n]).alias(n) for n in header])
