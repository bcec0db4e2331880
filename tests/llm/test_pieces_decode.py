"""The decoded text of query 6 is made from the ids, not from the text that went in."""

from __future__ import annotations

import pytest

from traitloom.llm.pieces import MergeVocabulary
from traitloom.llm.queries import piece_model

TEXT = "the house is here the 12 houses"


def swapped():
    """A vocabulary in which one id of the text stands for another piece."""
    vocabulary = MergeVocabulary(piece_model())
    vocabulary.piece_of[vocabulary.library.encode(TEXT)[1]] = "wrong"
    return vocabulary


def test_decoding_reads_the_ids():
    assert MergeVocabulary(piece_model()).encode(TEXT)[1] == TEXT
    assert "wrong" in swapped().encode(TEXT)[1]


def test_a_decoding_fault_is_found():
    with pytest.raises(ValueError, match="decoded text"):
        swapped().verify(TEXT)
    MergeVocabulary(piece_model()).verify(TEXT)
