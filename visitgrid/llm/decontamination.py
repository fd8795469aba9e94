"""Benchmark passages in training documents.

The windows of all benchmark items (13 words; a shorter item is one window) go to every
task as a sorted table of hashes.  A task slides over the words of its documents, looks
each window up, and verifies a hit word by word against the item before it counts.

The table is cut into blocks of a bounded size.  One block is the usual case; more are
applied one after the other, each to the documents with the hits found so far, so a
benchmark of any size works with the same memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, materialize, steps
from .words import Words, windows, words_of

WINDOW = 13
#: Text bytes of the items in one block; a block takes about six times that in a task.
BLOCK_BYTES = 16 << 20
#: A document is contaminated if hit words are at least one in so many.
ONE_IN = 20


class Index:
    """Windows of some items: for each length the sorted hashes and where they stand."""

    def __init__(self, names: list[str], texts: list[str], size: int = WINDOW):
        self.names = names
        self.words: Words = words_of(pa.array(texts, pa.string()))
        hashes, doc = self.words.hashes(), self.words.doc
        counts = self.words.counts()
        lengths = np.minimum(counts, size)
        self.tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for length in sorted({int(x) for x in lengths} - {0}):
            found, places = windows(hashes, doc, length)
            own = lengths[doc[places]] == length
            found, places = found[own], places[own]
            order = np.argsort(found, kind="stable")
            seen = np.zeros(1 << max(16, int(len(found) * 8).bit_length()), bool)
            seen[found & np.uint64(len(seen) - 1)] = True
            self.tables.append((length, found[order], places[order], seen))

    def scan(self, words: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words are hit, and the items found in each text."""
        hit = np.zeros(len(words.starts), bool)
        items: dict[int, set[str]] = {}
        hashes = words.hashes()
        for length, table, places, seen in self.tables:
            found, at = windows(hashes, words.doc, length)
            maybe = np.flatnonzero(seen[found & np.uint64(len(seen) - 1)])
            low = np.searchsorted(table, found[maybe], side="left")
            high = np.searchsorted(table, found[maybe], side="right")
            for k in np.flatnonzero(high > low).tolist():
                first = int(at[maybe[k]])
                text = words.text(first, length)
                for place in places[low[k] : high[k]].tolist():
                    if self.words.text(place, length) == text:
                        hit[first : first + length] = True
                        items.setdefault(int(words.doc[first]), set()).add(self.names[self.words.doc[place]])
        return hit, items


def _blocks(benchmark: DataFrame, limit: int, item: str, text: str) -> Iterator[tuple[list[str], list[str]]]:
    """Items in blocks of about ``limit`` text bytes; each is collected by itself."""
    items = benchmark.select(F.col(item).cast("string").alias("name"), F.coalesce(text, F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    count = max(1, -(-2 * size // limit)) if size > limit else 1
    for k in range(count):
        block = items if count == 1 else items.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k)
        rows = block.collect()
        yield [r["name"] or "" for r in rows], [r["text"] for r in rows]


def mark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` and four more; returns the frame and the names of those.

    ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``hits`` (a bit per
    word, packed) and ``items`` (distinct ids of the items found, as text).  Null and
    empty texts have no words; an item without words has no window; an item without id
    goes by the empty text; equal rows are marked alike; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    names = {x: free_name(docs, x) for x in ("n_words", "n_hit", "hits", "items")}
    kinds = {"n_words": T.LongType(), "n_hit": T.LongType(), "hits": T.BinaryType(), "items": T.ArrayType(T.StringType())}
    schema = T.StructType([*docs.schema, *(T.StructField(names[x], kind) for x, kind in kinds.items())])
    at = docs.columns.index(text)
    width = len(docs.columns)

    def scanner(shared, again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value, window)
            for batch in steps(batches, at):
                words = words_of(batch.column(at))
                hit, found = index.scan(words)
                counts = words.counts()
                ends = np.cumsum(counts)
                if again:
                    old = [np.unpackbits(np.frombuffer(b, np.uint8))[:n] for b, n in zip(batch.column(width + 2).to_pylist(), counts.tolist())]
                    hit |= np.concatenate([*old, np.zeros(0, np.uint8)]).astype(bool)
                    for row, known in enumerate(batch.column(width + 3).to_pylist()):
                        if known:
                            found.setdefault(row, set()).update(known)
                hits = [np.packbits(hit[a:b]).tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]
                total = np.bincount(words.doc[hit], minlength=len(counts))
                yield pa.RecordBatch.from_arrays([
                    *batch.columns[:width], pa.array(counts, pa.int64()), pa.array(total, pa.int64()), pa.array(hits, pa.binary()),
                    pa.array([sorted(found.get(row, ())) for row in range(len(counts))], pa.list_(pa.string())),
                ], names=[f.name for f in schema])

        return run

    marked = None
    for block in _blocks(benchmark, block_bytes, item, item_text):
        if marked is None:
            marked = docs.mapInArrow(scanner(spark.sparkContext.broadcast(block), False), schema)
        else:
            before = materialize(marked, "benchmark-block")
            marked = before.mapInArrow(scanner(spark.sparkContext.broadcast(block), True), schema)
    return marked, names


def contaminated(names: dict[str, str], one_in: int = ONE_IN):
    return (F.col(names["n_hit"]) > 0) & (F.lit(one_in) * F.col(names["n_hit"]) >= F.col(names["n_words"]))


def verdicts(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """A row per document: key, ``n_words``, ``n_hit``, ``items`` and ``contaminated``."""
    marked, names = mark(docs.select(F.col(key), F.col(text)), benchmark, text, **options)
    return marked.select(key, *(F.col(names[x]).alias(x) for x in ("n_words", "n_hit", "items")), contaminated(names).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", text: str = "text", **options) -> DataFrame:
    """Documents with their own columns, without benchmark passages.

    ``documents`` drops contaminated documents and leaves the others as they are;
    ``spans`` cuts every run of hit words (with the marks between them) from every text.
    """
    marked, names = mark(docs, benchmark, text, **options)
    if action == "documents":
        return marked.where(~contaminated(names)).select(*[F.col(f"`{c}`") for c in docs.columns])
    if action != "spans":
        raise ValueError(f"unknown action {action}")
    columns = docs.columns
    at, width = columns.index(text), len(columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, at):
            words = words_of(batch.column(at))
            counts = words.counts()
            first = np.cumsum(counts) - counts
            out = []
            for row, (bits, value) in enumerate(zip(batch.column(width + 2).to_pylist(), batch.column(at).to_pylist())):
                hit = np.unpackbits(np.frombuffer(bits, np.uint8))[: counts[row]].astype(np.int8)
                if not hit.any():
                    out.append(value)
                    continue
                edges = np.diff(hit, prepend=0, append=0)
                base, data, kept, last = words.bounds[row], value.encode(), [], 0
                for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1):
                    kept.append(data[last : words.starts[first[row] + a] - base])
                    last = words.ends[first[row] + b] - base
                out.append(b"".join([*kept, data[last:]]).decode())
            values = list(batch.columns[:width])
            values[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(values, names=columns)

    return marked.mapInArrow(cut, docs.schema)
