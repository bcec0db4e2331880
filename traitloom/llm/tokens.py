"""Words of many texts at once: spans and 64-bit hashes from one Arrow buffer, without a Python loop over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd, so that multiplying by it is a bijection modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

#: Texts are taken together up to this many bytes; a longer text is taken alone, whole.
CHUNK_BYTES = 1 << 20


def byte_table(members: bytes | range | list) -> np.ndarray:
    """Truth table over the 256 byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = byte_table([0x20, *range(0x09, 0x0E)])
#: ASCII bytes that are neither a letter nor a digit.
NOT_ALNUM = byte_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole value (a bijection on 64 bits)."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h = h ^ (h >> _S33)
    h = h * _M2
    return h ^ (h >> _S33)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, bytes, offsets)`` for consecutive rows of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        start = offsets[first]
        yield first, last - first, raw[start : offsets[last]], offsets[first : last + 1] - start
        first = last


def word_spans(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of each word: a longest run of bytes that are no separators, within one text."""
    inside = ~separators[raw]
    n = len(raw)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < n)]
    starts[bounds] = inside[bounds]
    start = np.flatnonzero(starts)
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:] = inside
    ends[1:n] &= ~inside[1:]
    ends[bounds] = inside[bounds - 1]
    end = np.flatnonzero(ends)
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


#: Longer spans are hashed one by one.
_LONG = 512


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per span.

    Eight bytes at a time are added to the state by exclusive or and mixed: a bijection of the state for every eight bytes, so
    spans that differ in one place differ in the hash, and no sums of powers that structured texts could make equal. All spans
    advance together; those that have ended drop out.
    """
    length = end - start
    hashes = mix(length.astype(np.uint64) * _BASE)
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(shape=(len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live = np.flatnonzero((length > 0) & (length <= _LONG))
    done = 0
    while len(live):
        left = np.minimum(length[live] - done, 8).astype(np.uint64)
        block = words[start[live] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        hashes[live] = mix((hashes[live] ^ block) * _BASE + _M2)
        done += 8
        live = live[length[live] > done]
    for i in np.flatnonzero(length > _LONG):
        digest = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, dtype="<u8")[0]
    return hashes


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash per ``width`` consecutive word hashes; the order of the words counts."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    weight = 1
    for i in range(width):
        weight = weight * int(_BASE) % (1 << 64)
        total += words[i : i + n] * np.uint64(weight)
    return mix(total)
