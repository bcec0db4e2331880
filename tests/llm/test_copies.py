"""Bounded samples of a fit are filled whatever is copied or absent in the tables."""

from __future__ import annotations

import base64
import random

from pyspark.sql import functions as F

from tests.llm.conftest import SF
from traitloom.llm import quality, secrets
from traitloom.llm.common import table


def test_secret_model_does_not_depend_on_copies(spark):
    texts = table(spark, SF, "documents").select("text").filter("text is not null").distinct()
    first = [r["text"] for r in texts.orderBy(F.xxhash64("text")).limit(1).collect()]
    copied = texts.unionByName(spark.range(2_500).select(F.lit(first[0]).alias("text")))
    want = {r["text"] for r in secrets.word_samples(texts).collect()}
    assert {r["text"] for r in secrets.word_samples(copied).collect()} == want and len(want) > 1_000

    rnd = random.Random(1)
    keys = [(base64.b64encode(rnd.randbytes(30)).decode(),) for _ in range(200)]
    spans = secrets.scan(spark.createDataFrame(keys, "text string"), secrets.fit_on(copied))
    assert spans.filter(F.exists("secrets", lambda s: s["kind"] == secrets.MARKOV)).count() >= 198


def test_secret_model_takes_at_most_the_given_texts(spark):
    texts = spark.range(50).select(F.concat(F.lit("text"), F.chr(97 + F.col("id") % 25)).alias("text"))
    assert secrets.word_samples(texts, texts=7).count() == 7


def test_training_rows_fill_the_bound_from_the_documents(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(docs).unionByName(spark.range(400).select(F.col("id").alias("doc_id"), F.lit(None).alias("text")))
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    rows = quality.training_rows(docs, labels, limit=100).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == 100
    assert all(r["text"] == f"text {r['doc_id']}" and r["__label"] == r["doc_id"] % 2 for r in rows)
