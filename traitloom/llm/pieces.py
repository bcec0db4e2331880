"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, inside Spark tasks over Arrow batches."""

from __future__ import annotations

import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from traitloom.llm.common import ref, with_columns

SPACE = "▁"
#: Chunks up to this length are kept, at most so many at a time; longer ones are encoded each time they occur.
CACHED_CHARS, CACHED_CHUNKS = 48, 300_000
#: Up to this length the agenda is a plain list of scores, above it a heap.
SHORT = 40
NEVER = float("inf")
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_ONE_RUN = re.compile(f"{SPACE}*(?:[{_LETTERS}]*|[^{SPACE}{_LETTERS}]*)")


def _words(mark: str) -> re.Pattern:
    return re.compile(f"{mark}+[^{mark}]*|[^{mark}]+")


def _runs(mark: str) -> re.Pattern:
    return re.compile(f"{mark}*(?:[{_LETTERS}]+|[^{mark}{_LETTERS}]+)|{mark}+")


class MergeVocabulary:
    """Pieces and scores of a model, and the merge procedure over them.

    The text is normalised by the model's own rules first. A model whose pieces never hold a space mark after another
    character cannot merge across such a place, so texts are encoded chunk by chunk there. If moreover no piece holds a
    Latin letter next to another character (but space marks in front), chunks end there as well. For other models the whole
    text is one chunk. In every batch the chunks met for the first time and one whole text are compared with the library
    (``verify``); a chunk inside a word can only be compared as part of a text.
    """

    def __init__(self, model: bytes, check: bool = True):
        sp = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.vocab_size()
        self.check = check
        self.bytes_at = {}
        self.merges: dict[str, tuple[float, int]] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_at[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.merges[piece] = (-sp.get_score(i), i)
        self.scores = {piece: score for piece, (score, _) in self.merges.items()}
        self.unknown = sp.unk_id()
        self.byte_of = {i: b for b, i in self.bytes_at.items()}
        self.piece_of = {i: piece for piece, (_, i) in self.merges.items()}
        self.ids = {piece: i for piece, (_, i) in self.merges.items()}
        # Whether the model leaves text as it is but for the space mark in front and in place of spaces.
        probe = "A  b\téﬁ① \n c "
        self.plain = sp.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        # A chunk has spaces for space marks, unless the model has both: it is then the text that its ids stand for.
        self.mark = SPACE if " " in sp.normalize(probe) else " "
        if any(SPACE in piece.lstrip(SPACE) for piece in self.merges):
            self.cut = lambda text: [text]
        elif all(_ONE_RUN.fullmatch(piece) for piece in self.merges):
            self.cut = _runs(self.mark).findall
        else:
            self.cut = _words(self.mark).findall
        self.cache: dict[str, bytes | tuple[bytes, str]] = {}
        self.fresh: list[tuple[str, list[int]]] = []

    def symbols(self, text: str) -> list[str]:
        """The best-scored adjacent pair of a normalised text, leftmost first, is joined until none is in the vocabulary."""
        return self._merge_short(text) if len(text) <= SHORT else self._merge_long(text)

    def ids_of(self, symbols: list[str]) -> list[int]:
        out = []
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes_at:
                out += [self.bytes_at[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return out

    def _merge_short(self, text: str) -> list[str]:
        scores, symbols = self.scores, list(text)
        agenda = [scores.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            at = agenda.index(best)
            joined = symbols[at] = symbols[at] + symbols[at + 1]
            del symbols[at + 1], agenda[at]
            if at:
                agenda[at - 1] = scores.get(symbols[at - 1] + joined, NEVER)
            if at < len(agenda):
                agenda[at] = scores.get(joined + symbols[at + 1], NEVER)
        return symbols

    def _merge_long(self, text: str) -> list[str]:
        symbols: list[str] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges, agenda = self.merges, []
        for i in range(n - 1):
            found = merges.get(symbols[i] + symbols[i + 1])
            if found:
                agenda.append((found[0], i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != joined:
                continue
            symbols[left], symbols[right] = joined, ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                found = merges.get(joined + symbols[follow])
                if found:
                    heapq.heappush(agenda, (found[0], left, follow, joined + symbols[follow]))
            ahead = before[left]
            if ahead >= 0:
                found = merges.get(symbols[ahead] + joined)
                if found:
                    heapq.heappush(agenda, (found[0], ahead, left, symbols[ahead] + joined))
        return [symbol for symbol in symbols if symbol]

    def plain_text(self, ids) -> str:
        """Pieces put together, runs of byte pieces read as UTF-8, space marks as spaces; nothing is stripped."""
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(self.piece_of.get(i, " ⁇ " if i == self.unknown else ""))
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def chunk(self, text: str) -> bytes | tuple[bytes, str]:
        """Ids as 32-bit numbers; with the text they stand for where that is not the chunk itself."""
        known = self.cache.get(text)
        if known is None:
            marked = text.replace(self.mark, SPACE)
            ids = self.ids_of(self.symbols(marked))
            plain = self.plain_text(ids)
            if self.check and self.plain and marked[0] == SPACE and len(text) > 1:  # the library puts the first mark there itself
                self.fresh.append((marked[1:], ids))
            known = array("i", ids).tobytes()
            if plain != text:
                known = known, plain
            if len(text) <= CACHED_CHARS:
                if len(self.cache) >= CACHED_CHUNKS:
                    self.cache.clear()
                self.cache[text] = known
        return known

    def verify(self, text: str = "") -> None:
        """Compares ``text`` and the chunks merged since the last call with the library."""
        fresh = self.fresh
        self.fresh = []
        if self.check and text:
            packed, plain = self.encode(text)
            fresh.append((text, list(memoryview(packed).cast("i"))))
            if plain != self.library.decode(fresh[-1][1]):
                raise ValueError(f"the decoded text of {text[:60]!r} differs from the library's")
        for (given, ids), want in zip(fresh, self.library.encode([given for given, _ in fresh], num_threads=1)):
            if ids != want:
                raise ValueError(f"ids of {given[:60]!r} differ from the library's")

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as the library gives them (32-bit numbers), and the text that its ``decode`` makes of them.

        The text is made from the ids, chunk by chunk; only the answers for chunks met before are kept.
        """
        if not text:
            return b"", ""
        normal = SPACE + text if self.plain else self.library.normalize(text)
        chunks = self.cut(normal.replace(SPACE, self.mark))
        found = list(map(self.chunk, chunks))
        if tuple in set(map(type, found)):
            chunks = [c if type(f) is bytes else f[1] for c, f in zip(chunks, found)]
            found = [f if type(f) is bytes else f[0] for f in found]
        decoded = "".join(chunks)
        return b"".join(found), decoded[1:] if decoded.startswith(" ") else decoded


@lru_cache(maxsize=1)
def _vocabulary(model: bytes, check: bool) -> MergeVocabulary:
    return MergeVocabulary(model, check)


def encode(
    docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded", check: bool = True
) -> DataFrame:
    """The rows with ``ids array<int>`` and ``decoded string``.

    Equal to the library's ``encode`` (no begin or end ids, no sampling) and ``decode``. A null text is an empty one,
    with no ids. Other columns stay; columns that already have the new names are replaced. ``model`` is the content of
    the vocabulary file, sent to the tasks once as a broadcast: its size does not depend on the data.
    """
    new = StructType([StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        vocabulary = _vocabulary(shared.value, check)

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [value or "" for value in column.to_pylist()]
            found = [vocabulary.encode(text) for text in texts]
            vocabulary.verify(texts[0] if texts else "")
            ends = np.cumsum([0, *[len(part) // 4 for part, _ in found]], dtype=np.int32)
            flat = np.frombuffer(b"".join([part for part, _ in found]), dtype=np.int32)
            return [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array([back for _, back in found], pa.string()),
            ]

        return work

    return with_columns(docs, [text], new, make)


def ids_text(ids: str = "ids"):
    """Decimal ids joined by commas."""
    return F.array_join(ref(ids).cast("array<string>"), ",")
