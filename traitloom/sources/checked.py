"""Raw records with an account of every line: what could not be read is kept, with the reason, and the numbers add up.

The plain reader fills short lines with blanks, cuts long ones and makes an unreadable id a missing one. Here each line ends
up in exactly one of two places: a record or a reject. Spark's own parser reads the lines and hands out the text of those that
do not fit the schema; only these are looked at again, in the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from traitloom.operators.columns import ref, require
from traitloom.operators.router import write_branches
from traitloom.sources.readers import EAV_COLUMNS, EAV_FORMAT

#: Reasons, in the order in which they are looked for.
SHORT, LONG, NOT_WHOLE = "too few fields", "too many fields", "id is not a whole number"
_UNREAD = "__unread"

# A whole number, also one written with a decimal point and zeros, as spreadsheets do.
_WHOLE = r"^[+-]?\d+(\.0*)?$"
# Characters around a field that do not belong to it, as in Spark's parser.
_AROUND = "".join(map(chr, range(0x21)))


def checked_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """``file, line, reason`` and the columns of the records; ``line`` and ``reason`` are null for a record.

    Integer columns of the schema are checked, all others are text. Without a schema the header names the columns and the trait
    id is the only integer. Blank ids are missing, not unreadable: the raw table holds rows without a trait; ``59.0`` is 59.
    The first line of every file is its header and must have the names of the schema. Lines of nothing but blanks are no lines.

    As in the plain reader, blanks around a field do not count, blank text is ``""`` and the text ``NA`` is missing.
    """
    reader = spark.read.options(**EAV_FORMAT)
    if schema is None:
        names = reader.csv(path).columns
        schema = StructType([StructField(n, IntegerType() if n == "TraitID" else StringType()) for n in names])
    if any(not isinstance(f.dataType, (IntegerType, LongType, StringType)) for f in schema):
        raise ValueError("columns of raw records are text or integers")
    # Without pruning: whether a line fits must not depend on the columns that are asked for.
    whole = reader.options(columnNameOfCorruptRecord=_UNREAD, columnPruning=False, enforceSchema=False)
    lines = whole.schema(StructType([*schema, StructField(_UNREAD, StringType())])).csv(path)
    require(lines, EAV_COLUMNS)

    # Paid for by every line: no higher-order function, at which generated code would end, and no file name but for a reject.
    lines = lines.select("*", F.split(_UNREAD, "\t", -1).alias("__fields"))
    columns, bad = [], F.lit(False)
    for i, f in enumerate(schema):
        again = F.trim(F.get(F.col("__fields"), F.lit(i)), F.lit(_AROUND))
        if isinstance(f.dataType, StringType):
            # The parser makes a blank field a missing one.
            value = F.coalesce(F.when(F.col(_UNREAD).isNull(), ref(f.name)).otherwise(again), F.lit(""))
            columns.append(F.nullif(value, F.lit("NA")).alias(f.name))
        else:
            number = F.when(again.rlike(_WHOLE), F.regexp_replace(again, r"\.0*$", "").try_cast(f.dataType))
            number = F.coalesce(ref(f.name), number)
            columns.append(number.alias(f.name))
            bad = bad | (number.isNull() & ~again.isin("", "NA"))
    size = F.size("__fields")
    reason = F.when(size < len(schema), SHORT).when(size > len(schema), LONG).when(bad, NOT_WHOLE)
    reason = F.when(F.col(_UNREAD).isNotNull(), reason)
    found = lines.select(_UNREAD, reason.alias("__reason"), *columns)
    names = [ref(f.name) for f in schema]
    rejected = F.col("__reason").isNotNull()
    # As ``_metadata.file_path`` has it: without the empty host of a local file.
    file = F.regexp_replace(F.input_file_name(), r"^([\w+.-]+):///", "$1:/")
    return found.select(
        F.when(rejected, file).alias("file"), F.when(rejected, F.col(_UNREAD)).alias("line"), F.col("__reason").alias("reason"), *names
    )


def records_of(checked: DataFrame) -> DataFrame:
    return checked.filter("reason is null").drop("file", "line", "reason")


def rejects_of(checked: DataFrame) -> DataFrame:
    return checked.filter("reason is not null").select("file", "line", "reason")


def read_eav_tsv_checked(spark: SparkSession, path: str, schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)``, each from a scan of its own. To get both from one scan, land them: ``land_checked``."""
    checked = checked_lines(spark, path, schema)
    return records_of(checked), rejects_of(checked)


@dataclass(frozen=True)
class Landed:
    """What a landing wrote, and how many lines went where. ``lines`` and what was not wanted are counted at the scan, the
    others in what was written."""

    records: DataFrame
    rejects: DataFrame
    branches: dict[str, DataFrame]
    lines: int
    kept: int
    rejected: int
    reasons: dict[str, int]

    @property
    def adds_up(self) -> bool:
        """Lines in = kept + rejected. A task that was run again may count its lines again, so this can fail then."""
        return self.lines == self.kept + self.rejected


def land_checked(
    checked: DataFrame, path: str, keep: Column | None = None, branch: Column | None = None, branches: tuple[str, ...] = ("record",)
) -> Landed:
    """Records and rejects written from one scan of the text, a folder each, and counted.

    ``keep`` limits the records that are landed; the others count as kept lines that were ``not wanted``, and are not written.
    ``branch`` deals the records to the named ``branches``, each a folder of its own.
    """
    spark = checked.sparkSession
    seen = Observation()
    wanted = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    skipped = F.col("reason").isNull() & ~wanted
    watched = checked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(skipped).alias("skipped"))
    name = F.lit(branches[0]) if branch is None else branch
    tagged = watched.filter(~skipped).withColumn("branch", F.when(F.col("reason").isNotNull(), "reject").otherwise(name))
    parts = write_branches(tagged, path, (*branches, "reject"))
    rejects = rejects_of(parts.pop("reject"))
    landed = {name: records_of(rows) for name, rows in parts.items()}
    records = records_of(spark.read.schema(tagged.schema).parquet(path)).drop("branch")
    reasons = {r["reason"]: r["count"] for r in rejects.groupBy("reason").count().collect()}
    rejected = sum(reasons.values())
    if keep is not None:
        reasons["not wanted"] = seen.get["skipped"]
    return Landed(records, rejects, landed, seen.get["lines"], records.count() + seen.get["skipped"], rejected, reasons)
