"""What a Python worker keeps: no batch that is done with, and little for each chunk of text it has met."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql.types import StringType, StructField, StructType

from traitloom.llm.common import with_columns
from traitloom.llm.pieces import SPACE, MergeVocabulary
from traitloom.llm.queries import piece_model


class Table:
    """Hands out the function that the workers would run."""

    schema = StructType([StructField("text", StringType())])

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_no_batch_is_held_while_the_next_is_read(spark):
    held = []

    def batches():
        for _ in range(4):
            held.append(pa.total_allocated_bytes())
            column = pa.array(["x" * 4096] * 1500)
            yield pa.RecordBatch.from_arrays([column], names=["text"])
            del column

    run = with_columns(Table(), ["text"], StructType.fromDDL("n long"), lambda: lambda column: [pa.array([len(t) for t in column.to_pylist()], pa.int64())])
    deque(run(batches()), maxlen=0)
    assert len(held) == 4 and max(held) - held[0] < 1 << 20


def test_an_input_that_stays_is_sent_once(spark, capfd):
    docs = spark.createDataFrame([("a b", 1), (None, 2)], "text string, n int")
    new = StructType.fromDDL("n_chars long, n int")
    made = with_columns(docs, ["text", "n"], new, lambda: lambda t, n: [pa.array([len(x or "") for x in t.to_pylist()]), pa.array([x + 1 for x in n.to_pylist()], pa.int32())])
    # ``n`` is replaced, so what it was is sent under another name.
    assert sorted(tuple(r) for r in made.select("n", "text", "n_chars").collect()) == [(2, "a b", 3), (3, None, 0)]
    made.explain("simple")
    sent = capfd.readouterr().out.split("MapInArrow run(")[1].split(")")[0]
    assert sent.count("text") == 1 and "__in1" in sent and "__in0" not in sent


def test_a_chunk_is_kept_once():
    vocabulary = MergeVocabulary(piece_model())
    vocabulary.encode("the house is here, l'été 日本 the house")
    assert len(vocabulary.cache) > 5
    assert all(type(ids) is bytes and SPACE not in chunk for chunk, ids in vocabulary.cache.items())


def test_chunks_whose_ids_stand_for_another_text():
    vocabulary = MergeVocabulary(piece_model(), check=False)
    vocabulary.bytes_at = {}
    for text in ("日本 and ͸ here", "and ͸", "and"):
        packed, decoded = vocabulary.encode(text)
        ids = memoryview(packed).cast("i").tolist()
        assert (vocabulary.unknown in ids) == ("͸" in text)
        assert decoded == vocabulary.library.decode(ids)
