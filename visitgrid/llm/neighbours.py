"""Quality by votes of labelled neighbours in a latent-semantic space.

A text is a vector of two parts of fixed lengths: its character trigrams (log counts by
inverse document frequency) and its habits, the shares of repeated words, of symbols, of
capitals and of repeated lines, each as one of a few steps.  A truncated singular value
decomposition of the labelled sample gives the space.  Every document is held against
every labelled vector: cosine products in blocks, exact, no index.  The ``NEIGHBOURS``
nearest, with all ties of the last, vote with a power of their similarity.

Labels are those of at most ``SAMPLE_DOCS`` documents, chosen by a hash of the key; this
bound is the only one.  Scoring covers every byte of every text.  Inputs of a score are
texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, materialize, steps
from .words import column_bytes, words_of

#: Labelled documents that vote, at most.  What the driver holds of them is this times TRIGRAMS.
SAMPLE_DOCS = 4096
#: Trigrams in a vector (those in most documents of the sample), dimensions of the space.
TRIGRAMS, DIMENSIONS = 4096, 64
NEIGHBOURS, POWER = 25, 16
#: A document is called good from this score on.
THRESHOLD = 0.7
#: Steps of a habit, and its weight beside the trigrams.
SHARES = np.array([1e-9, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7])
HABITS, HABIT_WEIGHT = 4, 0.5
#: Documents multiplied at once.
BLOCK_DOCS = 256
STEP = 1 << 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>!"]] = True
_CAPITALS, _LETTERS = np.zeros(256, bool), np.zeros(256, bool)
_CAPITALS[0x41:0x5B] = _LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = True
#: For lines: every byte but \n stands inside (U+0000 as U+0001).
_LINES = np.arange(256, dtype=np.uint8)
_LINES[0], _LINES[0x0A] = 1, 0


@dataclass(frozen=True)
class Space:
    trigrams: np.ndarray  # codes, in the order of columns
    weights: np.ndarray  # of trigrams, then of the steps of habits
    axes: np.ndarray  # columns by dimensions


@dataclass(frozen=True)
class Model:
    space: Space
    vectors: np.ndarray  # labelled documents by dimensions, of length 1
    labels: np.ndarray
    share: float  # of label 1


def trigram_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code of each three bytes in a row of one text, and the text."""
    data, bounds = column_bytes(column)
    if len(data) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    wide = data.astype(np.int32)
    codes = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    inside = np.ones(len(data), bool)
    for back in (1, 2):
        inside[np.maximum(bounds[1:][np.diff(bounds) >= back] - back, 0)] = False
    inside = inside[:-2]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:-2]
    return codes[inside], doc[inside]


def _earlier(doc: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """By document, how many values equal an earlier one."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (values[1:] == values[:-1])
    return np.bincount(doc[again], minlength=count)


def habits(column: pa.Array) -> np.ndarray:
    """The step of each habit of each text; texts without what is counted are at step 0."""
    words, lines = words_of(column), words_of(column, _LINES)
    count = len(words.bounds) - 1
    found = words.hashes()
    again = np.zeros(len(found), bool)
    again[1:] = (found[1:] == found[:-1]) & (words.doc[1:] == words.doc[:-1])

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(marks))[words.bounds])

    n_words = words.counts()
    shares = (
        (np.bincount(words.doc[again], minlength=count), n_words),
        (per_text(_SYMBOLS[words.raw]), n_words),
        (per_text(_CAPITALS[words.raw]), per_text(_LETTERS[words.raw])),
        (_earlier(lines.doc, lines.hashes(), count), lines.counts()),
    )
    return np.stack([np.searchsorted(SHARES, part / np.maximum(whole, 1), side="right") for part, whole in shares], axis=1)


def _columns(habit: np.ndarray) -> np.ndarray:
    """Column of each habit's step behind the trigrams."""
    return TRIGRAMS + habit + np.arange(HABITS) * (len(SHARES) + 1)


_WIDTH = TRIGRAMS + HABITS * (len(SHARES) + 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def places_of(trigrams: np.ndarray) -> np.ndarray:
    """Column of each of all trigram codes, -1 for those that have none."""
    out = np.full(1 << 24, -1, np.int16)
    out[trigrams] = np.arange(len(trigrams), dtype=np.int16)
    return out


def vectors_of(column: pa.Array, place: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of texts as weighted rows, and where each block starts."""
    codes, doc = trigram_codes(column)
    at = place[codes]
    known = at >= 0
    at, doc = at[known].astype(np.int64), doc[known]
    habit = habits(column)
    cuts = np.searchsorted(doc, np.arange(0, len(column) + BLOCK_DOCS, BLOCK_DOCS))
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        first = n * BLOCK_DOCS
        size = min(BLOCK_DOCS, len(column) - first)
        counts = np.bincount((doc[low:high] - first) * _WIDTH + at[low:high], minlength=size * _WIDTH).reshape(size, _WIDTH)
        rows = np.log1p(counts).astype(np.float32) * weights
        rows[:, :TRIGRAMS] = _unit(rows[:, :TRIGRAMS])
        one = np.zeros((size, _WIDTH - TRIGRAMS), np.float32)
        np.put_along_axis(one, _columns(habit[first : first + size]) - TRIGRAMS, 1, axis=1)
        rows[:, TRIGRAMS:] = HABIT_WEIGHT * _unit(one * weights[TRIGRAMS:])
        yield first, rows


def sample_of(docs: DataFrame, labels: DataFrame, limit: int, key: str, text: str, label: str) -> DataFrame:
    """At most ``limit`` labelled documents (``text, label``), equal ones once.

    A hash of the key decides who is in.  A key with several labels takes the lowest; rows
    without a key or a label of 0 or 1, and labels of absent documents, take no place.
    """
    ids = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(F.col(label).cast("int")).alias("label"))
    ids = ids.join(docs.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
    ids = ids.orderBy(F.xxhash64("k"), "k").limit(limit)  # so few rows may be sent to every task
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(ids), "k")
    return materialize(rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "label"]).select("text", "label"), "quality-sample")


def _weights(sample: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of the most documents, and log inverse document frequencies of all columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            codes, doc = trigram_codes(batch.column("text"))
            found, n = np.unique(np.unique(doc << 24 | codes) & 0xFFFFFF, return_counts=True)
            habit, n_habit = np.unique(_columns(habits(batch.column("text"))) - TRIGRAMS, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([found, habit + (1 << 24)]).astype(np.int32)), pa.array(np.concatenate([n, n_habit])),
            ], names=["code", "n"])

    counts = sample.mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    best = counts.where(F.col("code") < 1 << 24).orderBy(F.desc("n"), "code").limit(TRIGRAMS).collect()
    habit = counts.where(F.col("code") >= 1 << 24).collect()  # a row for each step of a habit at most
    held = np.zeros(_WIDTH)
    held[: len(best)] = [r["n"] for r in best]
    held[[TRIGRAMS + r["code"] - (1 << 24) for r in habit]] = [r["n"] for r in habit]
    return np.array([r["code"] for r in best], np.int32), np.log((1 + rows) / (1 + held)).astype(np.float32)


def axes_of(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """First right singular vectors, by subspace iteration from a fixed start."""
    wide = min(dimensions + 32, *rows.shape)
    basis = np.random.default_rng(11).standard_normal((rows.shape[1], wide)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr((rows.T @ (rows @ basis)).astype(np.float64))
        basis = basis.astype(np.float32)
    _, _, turned = np.linalg.svd((rows @ basis).astype(np.float64), full_matrices=False)
    return (basis @ turned[:dimensions].T).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The space and the labelled vectors; the caller leaves out rows that are held back.

    The driver takes the sample's rows as sparse vectors, at most ``limit`` of ``TRIGRAMS``
    values each however long the texts.  Without labelled rows there are no vectors, and
    every score is one half.
    """
    sample = sample_of(docs, labels, limit, key, text, label)
    rows = sample.count()
    if not rows:
        return Model(Space(np.zeros(0, np.int32), np.ones(_WIDTH, np.float32), np.zeros((_WIDTH, 1), np.float32)), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    trigrams, weights = _weights(sample, rows)
    shared = docs.sparkSession.sparkContext.broadcast((trigrams, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, weights = shared.value
        place = places_of(trigrams)
        for batch in steps(batches, "text", STEP):
            for first, block in vectors_of(batch.column("text"), place, weights):
                column = [np.flatnonzero(x).astype("<u2") for x in block]
                yield pa.RecordBatch.from_arrays([
                    batch.column("label").slice(first, len(block)), pa.array([x.tobytes() for x in column], pa.binary()),
                    pa.array([x[c].astype("<f4").tobytes() for x, c in zip(block, column)], pa.binary()),
                ], names=["label", "columns", "values"])

    found = sample.mapInArrow(run, "label int, columns binary, values binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["label"], r["columns"], r["values"]))
    matrix = np.zeros((len(found), _WIDTH), np.float32)
    for n, r in enumerate(found):
        matrix[n, np.frombuffer(r["columns"], "<u2")] = np.frombuffer(r["values"], "<f4")
    axes = axes_of(matrix, DIMENSIONS)
    known = np.array([r["label"] for r in found], np.float64)
    return Model(Space(trigrams, weights, axes), _unit(matrix @ axes), known, float(known.mean()))


def vote(similarity: np.ndarray, labels: np.ndarray, share: float) -> np.ndarray:
    """Mean label of the nearest columns of each row, by a power of their similarity; rows
    that nothing is similar to get the share of label 1."""
    if not len(labels):
        return np.full(len(similarity), share)
    nearest = min(NEIGHBOURS, len(labels))
    least = np.partition(similarity, -nearest, axis=1)[:, -nearest, None]
    weight = np.where(similarity >= least, np.maximum(similarity, 0), 0).astype(np.float64) ** POWER
    total = weight.sum(axis=1)
    ones = (weight * labels).sum(axis=1)  # by row, so that equal rows have equal sums
    return np.clip(np.where(total > 0, ones / np.where(total > 0, total, 1), share), 0, 1)


def _votes(rows: np.ndarray, model: Model) -> np.ndarray:
    """Votes on a block of rows, filled up to the size of a whole one: the last digits of a
    product depend on its number of rows."""
    whole = np.zeros((BLOCK_DOCS, rows.shape[1]), rows.dtype)
    whole[: len(rows)] = rows
    return vote((_unit(whole @ model.space.axes) @ model.vectors.T)[: len(rows)], model.labels, model.share)


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the score of each; returns the frame and that column's name.

    Null texts are empty; an empty text has no trigrams and is voted on by its habits.
    Equal texts have equal scores.  The model's size is bounded by the sample, so it is sent
    to every task.
    """
    name = free_name(docs, "score")
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        place = places_of(model.space.trigrams)
        for batch in steps(batches, at, STEP):
            found = [_votes(rows, model) for _, rows in vectors_of(batch.column(at), place, model.space.weights)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found), pa.float64())], names=[f.name for f in schema])

    return docs.mapInArrow(run, schema), name


def held_out(key: str = "doc_id") -> Column:
    """The rows that labels are never learnt from: crc32 of the key as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_open_rows(docs: DataFrame, labels: DataFrame, **options) -> Model:
    return train(docs.where(~held_out()), labels.where(~held_out()), **options)
