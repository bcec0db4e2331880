"""Word hashes: structured words, long words, and equal spans at any place."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from traitloom.llm import jaccard, repeats, tokens


def doubled(n):
    """Two different words that are equal for sums of powers modulo 2**64: each step doubles a word and swaps its letters."""
    one, two = "a", "b"
    for _ in range(n):
        one, two = one + two, two + one
    return one, two


def hashes(words):
    raw = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    start, end, _ = tokens.word_spans(raw, np.array([0, len(raw)]), tokens.WHITE_SPACE)
    return tokens.span_hashes(raw, start, end).tolist()


def test_structured_words_of_every_length_differ():
    for n in range(1, 13):
        one, two = doubled(n)
        a, b = hashes([one, two])
        assert a != b


def test_equal_words_are_equal_anywhere_and_others_differ():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 40))) for _ in range(3_000)]
    words += ["x" * n for n in (7, 8, 9, 15, 16, 17, 511, 512, 513, 5_000)] * 2
    found = {}
    for word, value in zip(words, hashes(words)):
        assert found.setdefault(word, value) == value
    assert len(set(found.values())) == len(found)


def test_windows_and_shingles_of_such_words_are_told_apart(spark):
    one, two = doubled(10)
    rest = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([one, *rest])), (2, " ".join([two, *rest])), (3, one), (4, two), (5, " ".join([one, *rest]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(docs).collect()}
    assert got == {r[0]: r[2] for r in brute.repeats(rows)} and got[2] == 0 and got[5] == 13
    groups = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(docs).collect())
    assert groups == sorted(brute.near_groups(rows)) and groups[3][2] == 4


def test_a_null_column_has_no_words():
    assert list(tokens.text_chunks(pa.array([], pa.string()))) == []
