"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept and returns the columns of ``documents``; the last adds the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm import decontaminate, jaccard, pieces, quality, secrets
from traitloom.llm.common import is_small, table, written
from traitloom.llm.queries import piece_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects. It learns from the labels of the table, never from held-out ones."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), metadata=["n_chars"])
    scored = quality.score(docs.select(*COLUMNS), model, metadata=["n_chars"], column="quality_score")
    return scored.filter(F.col("quality_score") >= quality.ACCEPT).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest id.

    The ids to drop are broadcast while they are few, else joined by a shuffle. Rows that share an id are one document;
    rows without an id cannot be named and stay.
    """
    groups = jaccard.near_groups(docs)
    kept = F.col("doc_id") == F.col("component_id")
    dropped = groups.groupBy("doc_id").agg(F.max(kept).alias("kept")).filter("doc_id is not null and not kept")
    dropped = written(dropped.select(F.col("doc_id").alias("dropped_id")), "dropped")
    if is_small(dropped, jaccard.BROADCAST_IDS):
        dropped = F.broadcast(dropped)
    return docs.select(*COLUMNS).join(dropped, F.col("doc_id") == F.col("dropped_id"), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    scanned = decontaminate.scan(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return scanned.filter("n_hit = 0").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret found; the document stays, with the length its text has then."""
    found = secrets.scan(docs.select(*COLUMNS), secrets.fit_on(docs), column="secret_spans")
    masked = secrets.redact(found, spans="secret_spans")
    changed = F.size("secret_spans") > 0
    length = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.select("doc_id", "text", "lang", "source", length.alias("n_chars"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``ids``, their number, and whether decoding them gives the text back."""
    encoded = pieces.encode(docs.select(*COLUMNS), piece_model())
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return encoded.select(*COLUMNS, "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("sentencepiece_encoding", encoding_stage),
]

#: SQL cannot express a fitted classifier; the tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
