"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, each text scanned once."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.llm import tokens
from traitloom.llm.common import ref, with_columns

WINDOW = 10
#: Patterns of one automaton, in characters. Larger test sets are scanned for in blocks of this size, one after the other.
MAX_PATTERN_CHARS = 64 << 20

_TO_WORDS = bytes(0x20 if tokens.NOT_ALNUM[b] else int(tokens._LOWER[b]) for b in range(256))

#: ``runs`` are word intervals, ``spans`` the same places as code points of the text as it was given.
NEW = "n_words long, n_hit long, items array<string>, runs array<struct<start:int,end:int>>, spans array<struct<start:int,end:int>>"
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: str) -> list[bytes]:
    """Words of a text: ASCII letters made small, runs of letters, digits and all characters beyond ASCII."""
    return text.encode().translate(_TO_WORDS).split()


def windows_of(words: list[bytes], width: int = WINDOW) -> Iterator[str]:
    """Every ``width`` consecutive words, or all of them where there are fewer; nothing for no words."""
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield " ".join(word.decode() for word in words[i : i + width])


def pattern_blocks(benchmark: DataFrame, item: str, text: str, width: int, limit: int) -> Iterator[dict[str, list[str]]]:
    """Window to item ids, in blocks that one automaton holds. Rows arrive one by one, so the driver holds one block."""
    block: dict[str, list[str]] = {}
    size = 0
    rows = benchmark.select(ref(item).cast("string").alias("item"), ref(text).cast("string").alias("text"))
    for row in rows.filter("item is not null and text is not null").toLocalIterator():
        for window in windows_of(words_of(row["text"]), width):
            owners = block.setdefault(window, [])
            if not owners:
                size += len(window)
            if row["item"] not in owners:
                owners.append(row["item"])
        if size > limit:
            yield block
            block, size = {}, 0
    if block:
        yield block


class Scanner:
    def __init__(self, patterns: dict[str, list[str]]):
        self.automaton = ahocorasick.Automaton()
        for window, items in patterns.items():
            # A blank on either side keeps matches on whole words.
            self.automaton.add_word(f" {window} ", (len(window) + 1, window.count(" ") + 1, items))
        self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word intervals of all occurrences, overlapping ones too, and the items they belong to."""
        normal = b" ".join([b"", *words, b""]).decode()
        hits = [(end - back, n, items) for end, (back, n, items) in self.automaton.iter(normal)]
        if not hits:
            return [], set()
        blanks = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), dtype=np.uint32) == 0x20)
        first = np.searchsorted(blanks, [at for at, _, _ in hits])
        found = set()
        for _, _, items in hits:
            found.update(items)
        return [(int(at), int(at) + n) for at, (_, n, _) in zip(first, hits)], found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def code_point_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals as code points of the text itself."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    start, end, _ = tokens.word_spans(raw, np.array([0, len(raw)]), tokens.NOT_ALNUM)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(before[start[a]]), int(before[end[b - 1]])) for a, b in runs]


def _ranges(values: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in row] for row in values], _RANGES)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    max_pattern_chars: int = MAX_PATTERN_CHARS,
) -> DataFrame:
    """The rows with the columns of ``NEW``.

    A word is hit when it lies in an occurrence of a window of ``width`` item words (an item with fewer words is one
    window). ``items`` are the ids, sorted as strings, of the items with an occurring window; an item without words, text
    or id takes no part, and equal ids are one item. A null or empty text has no words. Columns of the new names are replaced.

    The test set goes to the tasks as a broadcast of at most ``max_pattern_chars`` of patterns. A larger one is taken in
    blocks, each scanned for in its own pass over the rows; all passes run in one stage without a shuffle.
    """
    new = StructType.fromDDL(NEW)
    out = docs
    blocks = pattern_blocks(benchmark, item, item_text, width, max_pattern_chars)
    for number, block in enumerate(chain([next(blocks, {})], blocks)):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def make(shared=shared):
            scanner = Scanner(shared.value) if shared.value else None

            def work(column: pa.Array, *earlier: pa.Array) -> list[pa.Array]:
                n_words, n_hit, items, runs, spans = [], [], [], [], []
                before = zip(*[part.to_pylist() for part in earlier]) if earlier else None
                for value in column.to_pylist():
                    words = words_of(value or "")
                    hits, found = scanner.scan(words) if scanner and words else ([], set())
                    if before:
                        old_items, old_runs = next(before)
                        found = found.union(old_items)
                        hits = hits + [(r["start"], r["end"]) for r in old_runs]
                    row = merged(hits)
                    n_words.append(len(words))
                    n_hit.append(sum(b - a for a, b in row))
                    items.append(sorted(found))
                    runs.append(row)
                    spans.append(code_point_spans(value, row) if row else [])
                counts = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
                return [*counts, pa.array(items, pa.list_(pa.string())), _ranges(runs), _ranges(spans)]

            return work

        out = with_columns(out, [text] if number == 0 else [text, "items", "runs"], new, make)
    return out


def items_text(items: str = "items"):
    return F.array_join(ref(items), ",")
