"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.llm import tokens
from traitloom.llm.common import ref, with_columns

#: Labelled rows the model is fitted on, at most: those of the documents whose ids have the smallest hashes.
MAX_TRAIN = 8_000
WORD_BUCKETS = 1 << 15
BINS = 8
#: A metadata or statistics column has its bins, and one more for a missing value.
FACTORS = 8
ACCEPT = 0.7

STATISTICS = (
    "bytes",
    "words",
    "word_length",
    "upper",
    "digit",
    "mark",
    "line_length",
    "distinct_words",
    "same_as_last",
    "word_and_mark",
    "all_upper",
)


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_UPPER = tokens.byte_table(range(0x41, 0x5B))
_LETTER = tokens.byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_DIGIT = tokens.byte_table(range(0x30, 0x3A))
_MARK = tokens.NOT_ALNUM & ~tokens.WHITE_SPACE


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Features:
    """Rows in compressed form: ``bucket[starts[i]:starts[i + 1]]`` with ``value`` are the words of row ``i``."""

    bucket: np.ndarray
    value: np.ndarray
    starts: np.ndarray
    statistics: np.ndarray


def features_of(column: pa.Array) -> Features:
    """Word buckets (log counts, each row of length one) and structure statistics of every text; a null is an empty one."""
    buckets, values, sizes, stats = [], [], [], []
    for _, n, raw, offsets in tokens.text_chunks(column):
        start, end, row = tokens.word_spans(raw, offsets, tokens.WHITE_SPACE)
        hashes = tokens.span_hashes(raw, start, end)
        key, count = np.unique((row << 15) | (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64), return_counts=True)
        weight = np.log1p(count)
        at = key >> 15
        norm = np.sqrt(np.bincount(at, weight * weight, minlength=n))
        buckets.append((key & (WORD_BUCKETS - 1)).astype(np.int32))
        values.append((weight / norm[at]).astype(np.float32))
        distinct = np.bincount(at, minlength=n)
        sizes.append(distinct)

        words = np.bincount(row, minlength=n)
        length = np.diff(offsets)
        some, some_words = np.maximum(length, 1), np.maximum(words, 1)
        mark, upper, letter = _MARK[raw], _UPPER[raw], _LETTER[raw]
        same = np.zeros(len(row), dtype=bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        last_mark = mark[end - 1] & mark[np.maximum(end - 2, start)]
        total_upper = np.concatenate([[0], np.cumsum(upper)])
        total_letter = np.concatenate([[0], np.cumsum(letter)])
        uppers, letters = total_upper[end] - total_upper[start], total_letter[end] - total_letter[start]
        columns = [
            np.log1p(length),
            np.log1p(words),
            np.bincount(row, end - start, minlength=n) / some_words,
            _sums(upper, offsets) / some,
            _sums(_DIGIT[raw], offsets) / some,
            _sums(mark, offsets) / some,
            np.log1p(length / (1 + _sums(raw == 0x0A, offsets))),
            distinct / some_words,
            np.bincount(row, same, minlength=n) / some_words,
            np.bincount(row, last_mark, minlength=n) / some_words,
            np.bincount(row, (uppers == letters) & (letters > 1), minlength=n) / some_words,
        ]
        stats.append(np.stack(columns, axis=1))
    if not stats:
        return Features(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64), np.zeros((0, len(STATISTICS))))
    return Features(
        np.concatenate(buckets),
        np.concatenate(values),
        np.concatenate([[0], np.cumsum(np.concatenate(sizes))]),
        np.concatenate(stats),
    )


@dataclass
class Model:
    """Bias, linear weights and factors; ``edges`` cut every statistics and metadata column into bins."""

    edges: np.ndarray
    bias: float = 0.0
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS), np.float32))

    def indices(self, f: Features, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, values and row starts: word buckets first, then one bin per further column."""
        dense = np.concatenate([f.statistics, metadata], axis=1)
        rows, width = dense.shape
        missing = ~np.isfinite(dense)
        bins = np.stack([np.searchsorted(self.edges[j], dense[:, j], side="right") for j in range(width)], axis=1)
        bins[missing] = BINS
        bins += WORD_BUCKETS + np.arange(width) * (BINS + 1)
        sizes = np.diff(f.starts) + width
        starts = np.concatenate([[0], np.cumsum(sizes)])
        index = np.empty(starts[-1], dtype=np.int64)
        value = np.full(starts[-1], 1 / np.sqrt(width), dtype=np.float32)
        own = np.repeat(np.arange(rows), np.diff(f.starts))
        words_at = np.arange(len(f.bucket)) + own * width
        index[words_at], value[words_at] = f.bucket, f.value
        dense_at = (starts[1:, None] - width + np.arange(width)).reshape(-1)
        index[dense_at] = bins.reshape(-1)
        return index, value, starts

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the factor sums: half of (squared sum - sum of squares), linear in the features."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, starts[:-1], axis=0)
        squares = np.add.reduceat(weighted * weighted, starts[:-1], axis=0)
        plain = np.add.reduceat(self.linear[index] * value, starts[:-1])
        return self.bias + plain + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, f: Features, metadata: np.ndarray) -> np.ndarray:
        if not len(f.statistics):
            return np.zeros(0)
        if not len(self.linear):
            return np.full(len(f.statistics), 1 / (1 + np.exp(-self.bias)))
        z, _ = self.raw(*self.indices(f, metadata))
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def _metadata(columns: Sequence[pa.Array], rows: int) -> np.ndarray:
    if not columns:
        return np.zeros((rows, 0))
    return np.stack([c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in columns], axis=1)


def fit(f: Features, metadata: np.ndarray, labels: np.ndarray, epochs: int = 12, rate: float = 0.05, seed: int = 7) -> Model:
    """Logistic loss, AdaGrad over batches, a little decay. The same rows in the same order give the same model."""
    dense = np.concatenate([f.statistics, metadata], axis=1)
    cuts = np.arange(1, BINS) / BINS
    edges = np.array([
        np.quantile(col[np.isfinite(col)], cuts) if np.isfinite(col).any() else np.zeros(BINS - 1) for col in dense.T
    ])
    positive = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(edges, float(np.log(positive / (1 - positive))))
    if len(set(labels.tolist())) < 2:
        return model
    random = np.random.default_rng(seed)
    size = WORD_BUCKETS + dense.shape[1] * (BINS + 1)
    model.linear = np.zeros(size, np.float32)
    model.factors = random.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    index, value, starts = model.indices(f, metadata)
    past_linear, past_factors, past_bias = np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for begin in range(0, len(order), 256):
            rows = order[begin : begin + 256]
            counts = starts[rows + 1] - starts[rows]
            local = np.concatenate([[0], np.cumsum(counts)])
            pick = np.arange(local[-1]) + np.repeat(starts[rows] - local[:-1], counts)
            idx, val = index[pick], value[pick]
            z, sums = model.raw(idx, val, local)
            slope = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[rows]) / len(rows)).astype(np.float32)
            each = np.repeat(slope, counts) * val
            seen, where = np.unique(idx, return_inverse=True)
            g_linear = np.bincount(where, each, len(seen)).astype(np.float32) + 1e-6 * model.linear[seen]
            per_factor = each[:, None] * (np.repeat(sums, counts, axis=0) - model.factors[idx] * val[:, None])
            g_factors = np.stack([np.bincount(where, per_factor[:, k], len(seen)) for k in range(FACTORS)], axis=1)
            g_factors = g_factors.astype(np.float32) + 1e-6 * model.factors[seen]
            g_bias = float(slope.sum())
            past_linear[seen] += g_linear * g_linear
            past_factors[seen] += g_factors * g_factors
            past_bias += g_bias * g_bias
            model.linear[seen] -= rate * g_linear / np.sqrt(past_linear[seen])
            model.factors[seen] -= rate * g_factors / np.sqrt(past_factors[seen])
            model.bias -= rate * g_bias / np.sqrt(past_bias)
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", limit: int = MAX_TRAIN
) -> DataFrame:
    """``docs`` rows with their label as ``__label``, at most ``limit``, none of a held-out id.

    Null ids and labels other than 0 and 1 are left out, equal rows of the label table count once. The bound is put on the labelled
    ids that ``docs`` holds, so it is filled where there are as many. An id that repeats in ``docs`` gives one row, the one with
    the greatest values. The chosen ids are bounded by the parameter, so they may be broadcast.
    """
    held = docs.select(ref(id_column).alias("__held")).filter("__held is not null").distinct()
    chosen = (
        labels.select(ref(id_column).alias("__id"), ref(label).cast("int").alias("__label"))
        .filter(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id")))
        .distinct()
        .join(held, F.col("__id") == F.col("__held"), "left_semi")
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(limit)
    )
    found = docs.join(F.broadcast(chosen), ref(id_column) == F.col("__id"))
    one = found.groupBy("__id", "__label").agg(F.max(F.struct(*[ref(n) for n in docs.columns])).alias("__row"))
    return one.select("__row.*", "__label")


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    label: str = "quality",
    metadata: Sequence[str] = (),
    limit: int = MAX_TRAIN,
) -> Model:
    """The model. Features are made in the tasks; the driver gets those of at most ``limit`` rows and fits them.

    Inputs are the text and the numeric ``metadata`` columns, never the id or the label table. Without labels of both
    kinds the score is the share of label 1 (one added to either count).
    """
    needed = list(dict.fromkeys([id_column, text, *metadata]))
    rows = training_rows(docs.select(*[ref(n) for n in needed]), labels, id_column, label, limit)
    made = StructType.fromDDL("bucket binary, value binary, statistics binary")

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            f = features_of(column)
            spans = list(zip(f.starts[:-1], f.starts[1:]))
            return [
                pa.array([f.bucket[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([f.value[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([row.tobytes() for row in f.statistics], pa.binary()),
            ]

        return work

    numbers = [ref(m).cast("double").alias(f"m{i}") for i, m in enumerate(metadata)]
    kept = rows.select(ref(id_column).alias("id"), "__label", ref(text).alias("text"), *numbers)
    sample = with_columns(kept, ["text"], made, make).drop("text")
    data = sorted(sample.collect(), key=lambda r: (r["id"], r["__label"], r["bucket"]))
    if not data:
        return Model(np.zeros((len(STATISTICS) + len(metadata), BINS - 1)))
    buckets = [np.frombuffer(r["bucket"], np.int32) for r in data]
    f = Features(
        np.concatenate(buckets),
        np.concatenate([np.frombuffer(r["value"], np.float32) for r in data]),
        np.concatenate([[0], np.cumsum([len(b) for b in buckets])]),
        np.stack([np.frombuffer(r["statistics"], np.float64) for r in data]),
    )
    extra = np.array([[r[f"m{i}"] if r[f"m{i}"] is not None else np.nan for i in range(len(metadata))] for r in data])
    return fit(f, extra.reshape(len(data), len(metadata)), np.array([r["__label"] for r in data], dtype=np.float32))


def score(docs: DataFrame, model: Model, text: str = "text", metadata: Sequence[str] = (), column: str = "score") -> DataFrame:
    """The rows with ``column`` (double, 0 to 1). A null text is an empty one, and scored. A column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def work(text_column: pa.Array, *more: pa.Array) -> list[pa.Array]:
            return [pa.array(model.score(features_of(text_column), _metadata(more, len(text_column))), pa.float64())]

        return work

    return with_columns(docs, [text, *metadata], StructType.fromDDL(f"`{column}` double"), make)
