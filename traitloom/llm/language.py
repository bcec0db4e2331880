"""Language identification with a bit-sliced Bloom filter over character n-grams.

The filter is a table of rows, one bit per language in each. An n-gram of a language sets that language's bit in the rows
its hashes name; the bitwise and of those rows gives every language that holds the n-gram, all in one lookup. A text is
scored by counting, per language, its n-grams with that bit. A row's bit may be set by other n-grams: the share of rows with
bit ``l`` to the power of the number of hashes is the chance of a false positive, and the counts are corrected by it.

N-grams are runs of 2 to 4 lower-cased letters (Unicode) of a word, a word's start and end counting as a character; they are
counted wherever they occur, over the whole text. A language's list holds the n-grams that at least ``MIN_SHARE`` of its
training texts have, at least ``MIN_RATIO`` times as often as any other language's do (so that quotations in another language
stay out), the ``max_grams`` most frequent of them, so that a language with many texts does not win by the size of its list.

The fit is bounded: ``max_texts`` different texts of each language, those with the smallest hashes, whole. Copies count once.
Counting runs in Spark; the driver gets at most ``max_grams`` numbers a language and makes the filter of them, whose size is
therefore set by the number of languages and the two parameters, never by the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.llm.common import ref, with_columns, written
from traitloom.llm.tokens import mix

#: Different training texts of a language, and n-grams of a language in the filter.
MAX_TEXTS, MAX_GRAMS = 2_000, 10_000
#: Share of a language's training texts that hold a listed n-gram, at least; and that share against the largest of any language.
MIN_SHARE, MIN_RATIO = 0.01, 0.1
SIZES = (2, 3, 4)
#: Chance that an n-gram in no list shows the bit of the language with the longest list.
FALSE_POSITIVES = 0.01
UNKNOWN = "und"

#: N-grams that are looked up together, and texts whose n-grams are counted together.
_STEP, _TEXTS = 1 << 17, 128
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Lower-cased letter of each code point, 0 for what is no letter, -1 where it has not been asked for yet.
_FOLD = np.full(0x110000, -1, dtype=np.int32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 0 modulo 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _letters(codes: np.ndarray) -> np.ndarray:
    out = _FOLD[codes]
    if (out < 0).any():
        for code in np.unique(codes[out < 0]):
            char = chr(code)
            _FOLD[code] = ord(char.lower()[0]) if char.isalpha() else 0
        out = _FOLD[codes]
    return out


def grams_of(texts: Sequence[str | None]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Whether each text has a letter, and its n-grams as pieces ``(text number, 64-bit hash)``; a null text has none."""
    whole = [t or "" for t in texts]
    codes = np.frombuffer("\0".join(whole).encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in whole])[:-1]]).astype(np.int64)
    letters = np.zeros(len(codes) + 1 + max(SIZES), dtype=np.uint64)  # one mark before, enough after
    letters[1 : len(codes) + 1] = _letters(codes)
    at = np.flatnonzero(letters) - 1
    lettered = np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=len(whole)) > 0

    def pieces():
        for first in range(0, len(codes) + 1, _STEP):
            last = min(first + _STEP, len(codes) + 1)
            for size in SIZES:
                part = letters[first : last + size - 1]
                n = last - first
                good = part[1 : n + 1] != 0
                for inner in range(2, size - 1):
                    good &= part[inner : inner + n] != 0
                if size == 2:
                    good = (part[:n] != 0) | (part[1 : n + 1] != 0)
                value = np.full(n, size, dtype=np.uint64)
                for i in range(size):
                    value = value * _BASE + part[i : i + n]
                place = np.flatnonzero(good)
                yield np.searchsorted(starts, place + first, side="right") - 1, mix(value[place])

    return lettered, pieces()


def _distinct(grams: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((owner, grams))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], owner[new]


def texts_with(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of some texts, and in how many of them each is."""
    held = [_distinct(grams, owner) for owner, grams in grams_of(texts)[1]]
    grams, _ = _distinct(np.concatenate([g for g, _ in held]), np.concatenate([o for _, o in held]))
    return np.unique(grams, return_counts=True)


@dataclass(frozen=True)
class LanguageFilter:
    """``slices[row]`` holds one bit per language; ``noise[l]`` is the chance of a false positive of language ``l``."""

    languages: list[str]
    slices: np.ndarray = field(repr=False)
    hashes: int
    noise: np.ndarray = field(repr=False)

    def rows_of(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        step = (grams >> np.uint64(32)) | np.uint64(1)
        place = grams & np.uint64(0xFFFFFFFF)
        for _ in range(self.hashes):
            yield (place % np.uint64(len(self.slices))).astype(np.int64)
            place = place + step

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram as packed bits."""
        found = None
        for rows in self.rows_of(grams):
            found = self.slices[rows] if found is None else found & self.slices[rows]
        return found

    def counts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: has a letter, number of n-grams, and per language how many of them it holds, corrected."""
        n = len(texts)
        total = np.zeros(n, dtype=np.int64)
        hits = np.zeros((n, len(self.languages)), dtype=np.int64)
        lettered, pieces = grams_of(texts)
        for owner, grams in pieces:
            if not len(grams):
                continue
            bits = np.unpackbits(self.lookup(grams), axis=1, count=len(self.languages))
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            hits[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
            total[owner[first]] += np.diff(np.append(first, len(owner)))
        return lettered, total, (hits - total[:, None] * self.noise) / (1 - self.noise)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language of each text (the first in order of value among equals), and the share of its n-grams it holds."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered, total, counts = self.counts(texts)
        best = counts.argmax(axis=1)
        share = np.clip(counts[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.where(lettered, share, 0.0)


def build(grams: dict[str, np.ndarray], false_positives: float = FALSE_POSITIVES) -> LanguageFilter:
    """The filter of the n-gram lists (hashes) of the languages, sized for the longest list."""
    languages = sorted(grams)
    most = max([1, *[len(g) for g in grams.values()]])
    hashes = max(1, round(-np.log2(false_positives)))
    rows = int(np.ceil(most * hashes / np.log(2)))
    slices = np.zeros((rows, max(1, -(-len(languages) // 8))), dtype=np.uint8)
    made = LanguageFilter(languages, slices, hashes, np.zeros(len(languages)))
    for number, language in enumerate(languages):
        for place in made.rows_of(grams[language]):
            slices[place, number // 8] |= np.uint8(0x80 >> (number % 8))
    fill = np.unpackbits(slices, axis=1, count=len(languages)).mean(axis=0)
    # A language whose every bit is set says nothing; the bound keeps its correction finite.
    return LanguageFilter(languages, slices, hashes, np.minimum(fill**hashes, 1 - 1e-9))


def training_texts(docs: DataFrame, text: str, lang: str, id_column: str, max_texts: int) -> DataFrame:
    """``lang, text``: at most ``max_texts`` different texts a language. Held-out ids, null ids and null languages have none.

    The choice is made on hashes, so no text is shuffled for it; the limit is applied before the shuffle as well as after it.
    The chosen hashes are bounded by the number of languages and may be broadcast.
    """
    rows = docs.select(ref(id_column).alias("id"), ref(lang).cast("string").alias("lang"), ref(text).cast("string").alias("text"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("hash"))
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = rows.select("lang", "hash").distinct().withColumn("rank", F.row_number().over(order))
    chosen = chosen.filter(F.col("rank") <= max_texts).drop("rank")
    found = rows.join(F.broadcast(chosen), ["lang", "hash"], "left_semi")
    return found.groupBy("lang", "hash").agg(F.max("text").alias("text")).select("lang", "text")


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id_column: str = "doc_id",
    max_texts: int = MAX_TEXTS,
    max_grams: int = MAX_GRAMS,
    false_positives: float = FALSE_POSITIVES,
) -> LanguageFilter:
    """The filter of a table with texts and known languages. Without such rows it knows no language."""

    def count(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(first, _TEXTS)
                languages, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
                for language in sorted(set(languages)):
                    grams, n = texts_with([t for t, other in zip(texts, languages) if other == language])
                    names = pa.array([language] * len(grams), pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    sample = written(training_texts(docs, text, lang, id_column, max_texts), "language-sample")
    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sizes = sample.groupBy("lang").agg(F.count("*").alias("texts"))
    shares = counted.join(sizes, "lang").withColumn("share", F.col("n") / F.col("texts"))
    most = F.max("share").over(Window.partitionBy("gram"))
    listed = shares.withColumn("most", most).filter((F.col("share") >= MIN_SHARE) & (F.col("share") >= MIN_RATIO * F.col("most")))
    order = Window.partitionBy("lang").orderBy(F.desc("share"), "gram")
    best = listed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_grams)
    rows = best.select("lang", "gram").toArrow()
    languages = np.array(rows["lang"].to_pylist(), dtype=object)
    grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
    return build({value: grams[languages == value] for value in sorted(set(languages))}, false_positives)


def predict(
    docs: DataFrame, model: LanguageFilter, text: str = "text", column: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The rows with the language and the share of the text's n-grams that it holds; columns of those names are replaced.

    ``und`` with score 0 for a null text, one without letters, or a model without languages. Equal counts, also a text of
    which no language holds anything, go to the smallest language value.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            languages, shares = model.predict(texts.to_pylist())
            return [pa.array(languages, pa.string()), pa.array(shares, pa.float64())]

        return work

    return with_columns(docs, [text], StructType.fromDDL(f"`{column}` string, `{score}` double"), make)
