"""Alignment of two tokenizers: which tokens of one cover which of the other.

Both vocabularies cut the bytes of blank + text into tokens.  Byte offsets where tokens of
both end cut a text into groups.  They are found by divide and conquer: near the middle of
an interval a common end is located by bisecting the ends of the other side, both halves go
on by themselves, and an interval without a common end is a leaf, one group.  What lies
between the middle and the cut is not searched again.

Every pair of tokens of a group is a link.  A pair of ids counts the documents that hold it.
The counts are aggregated over all documents; back to the documents they come in blocks of
bounded size, one scan of the documents' distinct pairs each, so neither a document nor a
pair is ever joined through a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, steps
from .kept import Kept
from .pretokens import by_text, distinct_segments, gather

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of one step; links, pairs and tokens that are held at once.
STEP, LINKS, PAIRS, FORMATTED = 1 << 20, 1 << 21, 1 << 22, 1 << 19
#: Groups with more links than this are first reduced to their distinct ids.
LARGE_GROUP = 1 << 12
#: Bytes of segments and ids that a worker keeps.
KEPT_BYTES = 128 << 20
#: Pairs in a block of counts that is sent to every task.
BLOCK_PAIRS = 2_000_000


class Aligner:
    """Both vocabularies, and the ids of segments seen lately."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.byte_level = Tokenizer.from_file(byte_level)
        self.byte_level.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pieces = SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as source:
            names = json.load(source)["model"]["vocab"]
        visible = _byte_of_character(pre_tokenizers.ByteLevel.alphabet())
        self.size_a = max(self.byte_level.get_vocab_size(), max(names.values()) + 1)
        self.bytes_a = [b""] * self.size_a
        for name, n in names.items():
            self.bytes_a[n] = bytes(visible.get(c, 0x3F) for c in name)
        self.size_b = self.pieces.get_piece_size()
        self.bytes_b = [self._piece_bytes(n) for n in range(self.size_b)]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.spelt_a, self.spelt_b = (np.frombuffer(b"".join(x), np.uint8) for x in (self.bytes_a, self.bytes_b))
        self.kept = Kept(KEPT_BYTES)
        parts = [f"{n}{end}".encode() for size, ends in ((self.size_a, ",|"), (self.size_b, (",", ";", ""))) for n in range(size) for end in ends]
        self.parts, self.part_sizes = np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)), np.int64)
        self.wide = "<u4" if self.size_a * self.size_b < 1 << 32 else "<u8"

    def _piece_bytes(self, n: int) -> bytes:
        name = self.pieces.id_to_piece(n)
        return bytes([int(name[3:5], 16)]) if self.pieces.is_byte(n) else name.replace("▁", " ").encode()

    def _encode(self, segments: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of both sides.  The pieces' library puts a blank before a text by
        itself, but not before an empty one."""
        ours = self.byte_level.encode_batch_fast(segments, add_special_tokens=False)
        theirs = self.pieces.encode([x[1:] for x in segments], num_threads=1)
        blank = [self.pieces.piece_to_id("▁")]
        return [
            (array("I", a.ids).tobytes(), array("I", b if len(x) > 1 else blank).tobytes())
            for x, a, b in zip(segments, ours, theirs)
        ]

    def tokens(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For both sides ids, and the bounds of each text.

        Empty texts, and those whose bytes one side does not spell, have no tokens.  No
        piece has a blank behind another character, so segments are encoded one by one.
        """
        segments, which, counts = distinct_segments([f" {x}" for x in texts])
        found = list(map(self.kept.get, segments))
        new = [n for n, ids in enumerate(found) if ids is None]
        unknown = [segments[n] for n in new]
        encoded = self._encode(unknown)
        for n, ids in zip(new, encoded):
            found[n] = ids
        self.kept.keep(unknown, encoded)
        raw = np.frombuffer("".join(f" {x}" for x in texts).encode(), np.uint8)
        widths = np.fromiter((len(x.encode()) + 1 for x in texts), np.int64, len(texts))
        good, sides = np.array([bool(x) for x in texts], bool), []
        for side, (spelling, sizes) in enumerate(((self.spelt_a, self.sizes_a), (self.spelt_b, self.sizes_b))):
            packed = [x[side] for x in found]
            ids, ends = gather(np.frombuffer(b"".join(packed), np.uint32), np.fromiter(map(len, packed), np.int64, len(packed)) // 4, which)
            ids, bounds = ids.astype(np.int64), np.append(0, by_text(ends, counts))
            sides.append((ids, bounds))
            spelt, ends = gather(spelling, sizes, ids)
            good &= np.diff(np.append(0, ends)[bounds]) == widths
            if len(spelt) != len(raw) or not np.array_equal(spelt, raw):
                good &= _equal_texts(spelt, np.append(0, ends)[bounds], raw, np.append(0, np.cumsum(widths)))
        out = []
        for ids, bounds in sides:
            sizes = np.diff(bounds)
            out.append((ids[np.repeat(good, sizes)], np.append(0, np.cumsum(np.where(good, sizes, 0)))))
        return tuple(out)


def _equal_texts(one: np.ndarray, bounds_one: np.ndarray, two: np.ndarray, bounds_two: np.ndarray) -> np.ndarray:
    spans = zip(bounds_one[:-1].tolist(), bounds_one[1:].tolist(), bounds_two[:-1].tolist(), bounds_two[1:].tolist())
    return np.array([np.array_equal(one[a:b], two[c:d]) for a, b, c, d in spans], bool)


def _byte_of_character(alphabet: list[str]) -> dict[str, int]:
    """Byte-level vocabularies show a byte as itself where that can be printed, and the
    others, in their order, as the characters from U+0100 on."""
    shown = {ord(c): c for c in alphabet if ord(c) < 256}
    shifted = sorted(c for c in alphabet if ord(c) >= 256)
    return {c: b for b, c in shown.items()} | dict(zip(shifted, (b for b in range(256) if b not in shown)))


@functools.cache
def aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``ends_a`` and ``ends_b`` of the common ends, by divide and conquer.

    ``bounds_a`` are the bounds of texts (their ends are common ends).  All intervals of a
    depth are handled together; each is the range of ends that can still hold a cut.
    """
    last = bounds_a[1:][np.diff(bounds_a) > 0] - 1
    cuts = [last]
    low, high = bounds_a[:-1][np.diff(bounds_a) > 0], last
    while len(low):
        open_ = np.flatnonzero(low < high)
        low, high = low[open_], high[open_]
        middle = (low + high) // 2
        cut = np.full(len(low), -1)
        left, right = middle.copy(), middle.copy()  # what the search has passed over
        todo, reach = np.arange(len(low)), 1
        while len(todo):
            # the next ends on both sides, twice as many each time
            sides = ((np.maximum(low[todo], left[todo] - reach), left[todo]), (right[todo], np.minimum(high[todo], right[todo] + reach)))
            nearest = np.full(len(todo), -1)
            for side, (a, b) in enumerate(sides):
                sizes = b - a
                owner = np.repeat(np.arange(len(todo)), sizes)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + a[owner]
                hit = np.flatnonzero(ends_b[np.searchsorted(ends_b, ends_a[at])] == ends_a[at])
                order = hit[::-1] if side else hit  # the one nearest to the middle is written last
                best = np.full(len(todo), -1)
                best[owner[order]] = at[order]
                closer = (best >= 0) & ((nearest < 0) | (np.abs(best - middle[todo]) < np.abs(nearest - middle[todo])))
                nearest[closer] = best[closer]
            left[todo], right[todo] = sides[0][0], sides[1][1]
            cut[todo] = nearest
            todo = todo[(nearest < 0) & ((left[todo] > low[todo]) | (right[todo] < high[todo]))]
            reach *= 2
        found = np.flatnonzero(cut >= 0)
        cuts.append(cut[found])
        # ends passed over on the far side of the cut may still be common: only what lies
        # nearer to the middle than the cut is known to hold none
        near = np.abs(cut[found] - middle[found])
        low, high = (
            np.concatenate([low[found], np.maximum(cut[found] + 1, middle[found] + near)]),
            np.concatenate([np.minimum(cut[found], middle[found] - near + 1), high[found]]),
        )
    cuts = np.sort(np.concatenate(cuts))
    return cuts, np.searchsorted(ends_b, ends_a[cuts])


def document_pairs(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, doc: np.ndarray, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs ``id a * size_b + id b`` by document, and the links of each."""
    first_a, first_b = np.append(0, cuts_a[:-1] + 1), np.append(0, cuts_b[:-1] + 1)
    n_a, n_b = cuts_a + 1 - first_a, cuts_b + 1 - first_b
    links = n_a * n_b
    span = size_a * size_b
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(found: np.ndarray, weight: np.ndarray | None = None) -> None:
        order = None if weight is None else np.argsort(found, kind="stable")
        found = np.sort(found) if order is None else found[order]
        first = np.flatnonzero(np.diff(found, prepend=-1))
        keys.append(found[first])
        times.append(np.diff(np.append(first, len(found))) if weight is None else np.add.reduceat(weight[order], first))

    small = np.flatnonzero(links <= LARGE_GROUP)
    for part in np.array_split(small, max(1, int(links[small].sum()) // LINKS)):
        if not len(part):
            continue
        group = np.repeat(part, links[part])
        place = np.arange(len(group)) - np.repeat(np.cumsum(links[part]) - links[part], links[part])
        add(doc[group] * span + a[first_a[group] + place // n_b[group]] * size_b + b[first_b[group] + place % n_b[group]])
    for group in np.flatnonzero(links > LARGE_GROUP).tolist():
        ids_a, times_a = np.unique(a[first_a[group] : cuts_a[group] + 1], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[group] : cuts_b[group] + 1], return_counts=True)
        rows = max(1, LINKS // len(ids_b))
        for at in range(0, len(ids_a), rows):
            pairs = doc[group] * span + ids_a[at : at + rows, None] * size_b + ids_b
            add(pairs.reshape(-1), (times_a[at : at + rows, None] * times_b).reshape(-1))
    found, weight = np.concatenate(keys), np.concatenate(times)
    if len(keys) > 2:
        add(found, weight)
        found, weight = keys[-1], times[-1]
    return found // span, found % span, weight


def _digests(tools: Aligner, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Digest of the groups of each text; ``bounds`` of the texts in tokens of both sides."""
    group_a, group_b = np.searchsorted(cuts_a, np.arange(len(a))), np.searchsorted(cuts_b, np.arange(len(b)))
    closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    closes_a[cuts_a], closes_b[cuts_b] = 1, 1
    text = np.flatnonzero(np.diff(bounds))
    flat = np.empty(len(a) + len(b), np.int64)
    flat[np.arange(len(a)) + np.append(0, cuts_b + 1)[group_a]] = 2 * a + closes_a
    flat[np.arange(len(b)) + (cuts_a + 1)[group_b]] = 2 * tools.size_a + 3 * b + closes_b
    flat[bounds[text + 1] - 1] += 1  # nothing behind the last token
    out = [hashlib.sha256() if full else None for full in np.diff(bounds)]
    for at in range(0, len(flat), FORMATTED):
        spelt, ends = gather(tools.parts, tools.part_sizes, flat[at : at + FORMATTED])
        ends = np.append(0, ends)
        stop = min(at + FORMATTED, len(flat))
        for n in range(int(np.searchsorted(bounds, at, side="right")) - 1, int(np.searchsorted(bounds, stop))):
            low, high = max(int(bounds[n]), at), min(int(bounds[n + 1]), stop)
            if low < high:
                out[n].update(spelt[ends[low - at] : ends[high - at]])
    return [x.hexdigest() if x else "" for x in out]


_ALIGNED = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string", "pairs": "binary", "times": "binary"}


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, counts of tokens, groups and links, the digest
    of the groups, and the document's distinct pairs with their links, packed.

    Texts that are null or empty, or that one side does not spell, have zeros, '' and no
    pairs.  Equal rows stay; only the two named columns are read.
    """
    paths = byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(*paths)
        for batch in steps(batches, 1, STEP):
            (a, bounds_a), (b, bounds_b) = tools.tokens([x or "" for x in batch.column(1).to_pylist()])
            ends_a, ends_b = np.cumsum(tools.sizes_a[a]), np.cumsum(tools.sizes_b[b])
            cuts_a, cuts_b = shared_cuts(ends_a, ends_b, bounds_a)
            doc = np.searchsorted(bounds_a, cuts_a, side="right") - 1
            n = batch.num_rows
            owner, found, times = document_pairs(a, b, cuts_a, cuts_b, doc, tools.size_a, tools.size_b)
            at = np.searchsorted(owner, np.arange(n + 1))
            found, packed = found.astype(tools.wide), []
            for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
                part = times[x:y]
                packed.append((found[x:y].tobytes(), part.astype(np.min_scalar_type(int(part.max()))).tobytes() if y > x else b""))
            links = np.diff(cuts_a, prepend=-1) * np.diff(cuts_b, prepend=-1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(bounds_a)), pa.array(np.diff(bounds_b)), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.add.reduceat(np.append(links, 0), np.searchsorted(doc, np.arange(n))) * (np.bincount(doc, minlength=n) > 0)),
                pa.array(_digests(tools, a, b, cuts_a, cuts_b, bounds_a + bounds_b), pa.string()),
                pa.array([x for x, _ in packed], pa.binary()), pa.array([x for _, x in packed], pa.binary()),
            ], names=[key, *_ALIGNED])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in _ALIGNED.items()))


def count_pairs(aligned: DataFrame, size_b: int, wide: str) -> DataFrame:
    """How many documents hold each pair, and whether no pair of its first id has more:
    ``pair, docs, best``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            found, docs = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(docs.astype(np.int64))], names=["pair", "docs"])

        for batch in batches:
            for blob in batch.column(0):
                held.append(np.frombuffer(blob.as_buffer(), wide))
                size += len(held[-1])
                if size >= PAIRS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = aligned.select("pairs").mapInArrow(run, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = materialize(counts.withColumn("a", F.expr(f"pair div {size_b}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # a row for each id of the vocabulary at most
    return counts.join(most, "a").select("a", "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def block_bounds(counts: DataFrame, limit: int = BLOCK_PAIRS) -> list[tuple[int, int]]:
    """Ranges of first ids with about ``limit`` pairs each; the vocabulary bounds what is
    read here, and the pairs of a single id."""
    sizes = sorted(counts.groupBy("a").count().collect())
    blocks, held, low = [], 0, 0
    for a, n in sizes:
        if held and held + n > limit:
            blocks.append((low, a))
            low, held = a, 0
        held += n
    return blocks + [(low, sizes[-1][0] + 1)] if sizes else []


def add_counts(aligned: DataFrame, block: pa.Table, wide: str) -> DataFrame:
    """Add to ``n_best`` and ``count_sum`` what a block of counts knows of each document's pairs."""
    order = np.argsort(block["pair"].to_numpy())
    table = tuple(block[c].to_numpy()[order] for c in ("pair", "docs", "best"))
    shared = aligned.sparkSession.sparkContext.broadcast((table[0].astype(wide), table[1], table[2]))
    names = aligned.columns
    at = {c: names.index(c) for c in ("pairs", "times", "n_best", "count_sum")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = shared.value
        for batch in batches:
            n_best, total = [], []
            for blob, times in zip(batch.column(at["pairs"]), batch.column(at["times"])):
                found = np.frombuffer(blob.as_buffer(), wide)
                n_best.append(0)
                total.append(0)
                if not len(found):
                    continue
                low, high = np.searchsorted(found, pair[0]), np.searchsorted(found, pair[-1], side="right")
                links = np.frombuffer(times.as_buffer(), f"<u{len(times.as_buffer()) // len(found)}")[low:high].astype(np.int64)
                place = np.searchsorted(pair, found[low:high])  # every pair of the range is in the block
                n_best[-1], total[-1] = int(links[best[place]].sum()), int((links * docs[place]).sum())
            columns = list(batch.columns)
            for c, more in (("n_best", n_best), ("count_sum", total)):
                columns[at[c]] = pa.array(np.asarray(columns[at[c]]) + np.array(more, np.int64))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return aligned.mapInArrow(run, aligned.schema)


def link_counts(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``align`` with ``n_best`` (links whose pair is in as many documents as any pair of
    its first id) and ``count_sum`` (documents of its pair, summed over links)."""
    tools = aligner(byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES))
    aligned = materialize(align(docs, byte_level, pieces, key, text), "aligned")
    counts = materialize(count_pairs(aligned, tools.size_b, tools.wide), "pair-ranks")
    zero = F.lit(0).cast("bigint")
    rows = aligned.withColumn("n_best", zero).withColumn("count_sum", zero)
    blocks = block_bounds(counts)
    for n, (low, high) in enumerate(blocks):
        block = counts.where((F.col("a") >= low) & (F.col("a") < high)).select("pair", "docs", "best").toArrow()
        rows = add_counts(rows, block, tools.wide)
        if n + 1 < len(blocks):
            rows = materialize(rows, "aligned-counted")
    return rows.select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
