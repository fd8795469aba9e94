"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a score p = sigmoid(bias + sum of the
weights of its distinct words and word beginnings); the document's is the noisy-or of them and of a small
leak, 1 - (1 - leak) * prod(1 - p).  Only labels of documents are known: the weights
maximise the likelihood of those.  A sentence's own score then shows which sentences made
the document toxic.

The model is fitted on at most ``SAMPLE_DOCS`` labelled documents, chosen by a hash of
their key: that bound is the only one, and scoring covers every sentence of every text.
Inputs of a score are words alone.
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
from .words import Words, factors, mix, words_of

#: Labelled documents that the model is fitted on, at most.
SAMPLE_DOCS = 10_000
#: A document is called toxic from this score on.
THRESHOLD = 0.7
#: A feature enters the model if it is in so many documents of the sample and its
#: likelihood ratio between the labels is so high; at most so many do, the best first.
LEAST_DOCS, LEAST_RATIO, MOST_FEATURES = 5, 16.0, 20_000
#: Lengths, in bytes, of the word beginnings that are features beside whole words.
PREFIXES = (3, 4, 5, 6)
L2, ROUNDS, RATE = 0.05, 400, 0.1

#: Bytes that end a sentence.
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float
    leak: float


def sentences_of(words: Words) -> np.ndarray:
    """Number of the sentence of each word, counted over all texts; sentences without a
    word have no number."""
    if not len(words.starts):
        return np.zeros(0, np.int64)
    ended = np.concatenate([[0], np.cumsum(_ENDS[words.raw])])[words.starts]
    new = np.ones(len(ended), bool)
    new[1:] = (ended[1:] != ended[:-1]) | (words.doc[1:] != words.doc[:-1])
    return np.cumsum(new) - 1


def distinct_pairs(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, value) pairs, ordered."""
    order = np.lexsort((values, groups))
    groups, values = groups[order], values[order]
    new = np.ones(len(groups), bool)
    new[1:] = (groups[1:] != groups[:-1]) | (values[1:] != values[:-1])
    return groups[new], values[new]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def features_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its first 3 to 6 bytes, and the place of the word.

    The prefixes let inflected forms of one root share a weight.
    """
    sizes = words.ends - words.starts
    found, places = [words.hashes()], [np.arange(len(sizes))]
    terms = np.zeros(len(sizes), np.uint64)
    factor = factors(PREFIXES[-1], 3)
    padded = np.append(words.data, np.zeros(PREFIXES[-1], np.uint8))
    for k in range(PREFIXES[-1]):
        terms += padded[words.starts + k].astype(np.uint64) * factor[k]
        if k + 1 in PREFIXES:
            long = np.flatnonzero(sizes > k + 1)
            found.append(mix(terms[long] + np.uint64(k + 1)))
            places.append(long)
    return np.concatenate(found), np.concatenate(places)


def sample_of(docs: DataFrame, labels: DataFrame, limit: int, key: str, text: str, label: str) -> DataFrame:
    """At most ``limit`` labelled documents (``text, label``), equal ones once.

    A hash of the key decides who is in, so neither order nor partitions matter.  A key
    with several labels takes the highest.  Rows without key or label are left out, and
    labels of documents that ``docs`` does not have: they take no place in the sample.
    """
    ids = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("label"))
    ids = ids.join(docs.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
    ids = ids.orderBy(F.xxhash64("k"), "k").limit(limit)  # so few rows may be sent to every task
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(ids), "k")
    rows = rows.select("text", "label").withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "label"])
    return materialize(rows.select("text", "label"), "toxicity-sample")


def vocabulary_of(sample: DataFrame) -> tuple[np.ndarray, int, int]:
    """Features that tell the labels apart, and the number of toxic and of clean rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words = words_of(batch.column("text"))
            found, places = features_of(words)
            doc, found = distinct_pairs(words.doc[places], found)
            label = np.asarray(batch.column("label"))[doc]
            every, place = np.unique(found, return_inverse=True)
            bad = np.bincount(place, label, minlength=len(every)).astype(np.int64)
            total = np.bincount(place, minlength=len(every))
            yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(bad), pa.array(total)], names=["f", "bad", "total"])

    sizes = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("label")).first()
    toxic, clean = int(sizes[0]), int(sizes[1] - sizes[0])
    if not toxic or not clean:
        return np.zeros(0, np.uint64), toxic, clean

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    bad, total, rows = F.col("bad").cast("double"), F.col("total").cast("double"), float(toxic + clean)
    good = total - bad
    # likelihood ratio of the 2 x 2 table: with and without the feature, toxic and clean
    ratio = 2 * (
        part(bad, total * toxic / rows) + part(good, total * clean / rows)
        + part(toxic - bad, (rows - total) * toxic / rows) + part(clean - good, (rows - total) * clean / rows)
    )
    counts = sample.mapInArrow(run, "f bigint, bad bigint, total bigint").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("total").alias("total"))
    chosen = counts.where((total >= LEAST_DOCS) & (ratio >= LEAST_RATIO)).select("f").orderBy(F.desc(ratio), "f").limit(MOST_FEATURES).collect()
    return np.sort(np.array([r["f"] for r in chosen], np.int64).view(np.uint64)), toxic, clean


def look_up(vocabulary: np.ndarray, words: Words, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sentence, column) pairs of the features that the vocabulary has."""
    if not len(vocabulary) or not len(sentence):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.uint64((1 << 16) - 1)
    maybe = np.zeros(1 << 16, bool)
    maybe[vocabulary & bits] = True
    found, places = features_of(words)
    near = np.flatnonzero(maybe[found & bits])
    found, places = found[near], places[near]
    at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
    known = vocabulary[at] == found
    return distinct_pairs(sentence[places[known]], at[known])


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled documents; the caller leaves out those that are held back.

    Without rows of both labels there is nothing to learn: no features, and the share of
    toxic rows as the leak.  The driver takes 8 bytes for each distinct pair of a sentence
    and a known feature of the sample: rows are bounded by ``limit``, bytes by the length
    of their texts only.
    """
    sample = sample_of(docs, labels, limit, key, text, label)
    vocabulary, toxic, clean = vocabulary_of(sample)
    if not len(vocabulary):
        return Model(vocabulary, np.zeros(0), -20.0, float(np.clip(toxic / max(1, toxic + clean), 0.001, 0.5)))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words = words_of(batch.column("text"))
            sentence = sentences_of(words)
            s, w = look_up(shared.value, words, sentence)
            starts = np.flatnonzero(np.diff(sentence, prepend=-1))
            doc = words.doc[starts]
            total = np.bincount(doc, minlength=batch.num_rows)
            cuts = np.searchsorted(doc[s], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("label"), pa.array(total, pa.int64()),
                pa.array([s[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([w[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ], names=["label", "total", "sentences", "columns"])

    found = sample.mapInArrow(run, "label int, total bigint, sentences binary, columns binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["label"], r["total"], r["columns"], r["sentences"]))
    return fit(vocabulary, found)


def fit(vocabulary: np.ndarray, sample: list[dict]) -> Model:
    """Weights by gradient ascent on the likelihood of the documents' labels.

    Sentences without a known feature share one score, so only the others are kept apart.
    """
    labels = np.array([r["label"] for r in sample], np.float64)
    plain = np.array([r["total"] for r in sample], np.float64)
    doc, sentence, column, count = [], [], [], 0
    for n, r in enumerate(sample):
        active, number = np.unique(np.frombuffer(r["sentences"], "<u4"), return_inverse=True)
        plain[n] -= len(active)
        doc.append(np.full(len(active), n))
        sentence.append(number + count)
        column.append(np.frombuffer(r["columns"], "<u4"))
        count += len(active)
    doc, sentence, column = (np.concatenate(x).astype(np.int64) for x in (doc, sentence, column))

    size = len(vocabulary)
    theta = np.zeros(size + 2)
    theta[size], theta[size + 1] = -6.0, -3.0  # bias of a sentence, leak
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        weights, bias, leak = theta[:size], theta[size], _sigmoid(theta[size + 1])
        p = _sigmoid(bias + np.bincount(sentence, weights[column], minlength=count))
        p_plain = _sigmoid(bias)
        keep = np.log1p(-leak) + plain * np.log1p(-p_plain) + np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(labels))
        toxic_p = np.clip(-np.expm1(keep), 1e-9, 1 - 1e-12)
        # slope of the likelihood by log(1 - P): -(1 - P) / P for toxic rows, 1 for clean ones
        pull = np.where(labels == 1, -(1 - toxic_p) / toxic_p, 1.0)
        by_sentence = -pull[doc] * p
        slope = np.empty_like(theta)
        slope[:size] = np.bincount(column, by_sentence[sentence], minlength=size) - L2 * weights
        slope[size] = by_sentence.sum() - (pull * plain).sum() * p_plain
        slope[size + 1] = -(pull * leak).sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(vocabulary, theta[:size], float(theta[size]), float(_sigmoid(theta[size + 1])))


def sentence_scores(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Score of each sentence, and the text it is in."""
    sentence = sentences_of(words)
    if not len(sentence):
        return np.zeros(0), np.zeros(0, np.int64)
    total = np.full(int(sentence[-1]) + 1, model.bias)
    s, w = look_up(model.features, words, sentence)
    total += np.bincount(s, model.weights[w], minlength=len(total))
    starts = np.flatnonzero(np.diff(sentence, prepend=-1))
    return _sigmoid(total), words.doc[starts]


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the score of each; returns the frame and that column's name.

    Null and empty texts have no sentence, so their score is the leak.  Equal texts have
    equal scores.  The model's size is bounded by the sample, so it is sent to every task.
    """
    name = free_name(docs, "score")
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in steps(batches, at):
            p, doc = sentence_scores(model, words_of(batch.column(at)))
            keep = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=batch.num_rows)
            found = -np.expm1(np.log1p(-model.leak) + keep)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[f.name for f in schema])

    return docs.mapInArrow(run, schema), name


def locate(docs: DataFrame, model: Model, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The sentences whose own score is ``least`` or more: key, ``sentence`` (from 0, of
    those with words), ``score`` and ``words`` (from its first word to its last)."""
    rows = docs.select(key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            words = words_of(batch.column(1))
            p, doc = sentence_scores(shared.value, words)
            bounds = np.append(np.flatnonzero(np.diff(sentences_of(words), prepend=-1)), len(words.starts))
            first = np.searchsorted(doc, np.arange(batch.num_rows))
            bad = np.flatnonzero(p >= least)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(doc[bad], pa.int64())), pa.array(bad - first[doc[bad]], pa.int64()), pa.array(p[bad], pa.float64()),
                pa.array([words.raw[words.starts[bounds[s]] : words.ends[bounds[s + 1] - 1]].tobytes().decode() for s in bad.tolist()], pa.string()),
            ], names=[key, "sentence", "score", "words"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, sentence bigint, score double, words string")


def held_out(key: str = "doc_id"):
    """The rows that labels are never learnt from: crc32 of the key as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on_open_rows(docs: DataFrame, labels: DataFrame, **options) -> Model:
    return train(docs.where(~held_out()), labels.where(~held_out()), **options)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score is below the threshold, with their own columns."""
    scored, name = score(docs, model, text)
    return scored.where(F.col(name) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
