"""Substring deduplication: words covered by a window that an earlier document holds too are removed."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from traitloom.llm import keyed, tokens

WINDOW = 13

SCHEMA = (
    "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"
)
_INTERVALS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def group_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the group's texts, one text after the other, and the row of each."""
    hashes, rows = [], []
    for first, _, raw, offsets in tokens.text_chunks(table["text"]):
        start, end, row = tokens.word_spans(raw, offsets, tokens.WHITE_SPACE)
        hashes.append(tokens.span_hashes(raw, start, end))
        rows.append(row + first)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def _windows(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key and first word of every window, the row of each word, and the id of each row (null: no id)."""
    words, rows = group_words(table)
    if len(words) < width:
        at = np.zeros(0, dtype=np.int64)
        keys = np.zeros(0, dtype=np.uint64)
    else:
        at = np.flatnonzero(rows[: len(words) - width + 1] == rows[width - 1 :])
        keys = tokens.window_hashes(words, width)[at]
    ids = table["id"].fill_null(keyed.NO_OWNER).to_numpy()
    return keys, at, rows, ids


def _intervals(covered: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """One row per document (``SCHEMA``): the words kept, joined by one space, and the word intervals removed.

    Words are runs of characters other than ASCII white space. Every window of ``width`` words gets a Rabin-Karp hash
    (a polynomial in mixed word hashes, 64 bits); for each hash the smallest document id is found over the whole corpus. A
    window is removed when that id is smaller than its own document's, overlapping removals merge into maximal intervals.
    Windows are judged on the input, not on what is left.

    A null or empty text has no words. A text shorter than a window keeps everything. Repeated ids are not smaller than
    each other, so rows that repeat an id leave each other alone. A row without an id neither removes nor loses anything.
    Other columns are not carried.
    """
    groups, _, buckets = keyed.deal(docs, id_column, text)

    def extract(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, at, rows, ids = _windows(table, width)
        return keys, ids[rows[at]]

    def work(_: int, table: pa.Table, back: tuple[np.ndarray, np.ndarray]) -> pa.Table:
        keys, at, rows, ids = _windows(table, width)
        own = ids[rows[at]]
        known, least, place = keyed.distinct_keys(keys, own)
        where = np.searchsorted(known, back[0])
        least[where] = np.minimum(least[where], back[1])
        hit = at[(least[place] < own) & (own != keyed.NO_OWNER)]
        change = np.zeros(len(rows) + 1, dtype=np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + width, -1)
        covered = np.cumsum(change[:-1]) > 0
        bounds = np.searchsorted(rows, np.arange(table.num_rows + 1))
        n_words, n_removed, kept, removed = [], [], [], []
        for i, value in enumerate(table["text"].to_pylist()):
            mask = covered[bounds[i] : bounds[i + 1]]
            gone = int(mask.sum())
            words = value.encode().split()
            n_words.append(len(mask))
            n_removed.append(gone)
            kept.append(b" ".join(compress(words, ~mask) if gone else words).decode())
            removed.append(_intervals(mask) if gone else [])
        return pa.table(
            {
                "doc_id": table["id"].cast(pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                "removed": pa.array(removed, _INTERVALS),
            }
        )

    return keyed.finish(groups, keyed.shared_keys(groups, buckets, extract), work, SCHEMA)
