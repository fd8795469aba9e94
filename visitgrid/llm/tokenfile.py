"""Token ids in binary files: frequency ranks, byte-aligned, control bytes apart.

A file holds blocks, each of whole documents in ascending key order:

    header   5 x int64: documents, ids, ids of all documents before, control bytes, data bytes
    keys     int64 per document, then one byte each: 1 where the key is null
    counts   int64 per document
    control  two bits per id: bytes of its rank less one, four ids to a byte, lowest bits first
    data     the ranks, 1 to 4 bytes each, little-endian

``order.bin`` beside the files lists the ids by falling frequency (uint32), so that
frequent ids take one byte.  Ranks come from counts over all documents; that takes two
passes, the first of which writes the same format with the vocabulary's own ids.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, open_store, scratch_path, steps, texts_of
from .kept import Kept
from .pretokens import by_text, distinct_pretokens, gather

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Ids after which a block is closed; memory of a task follows this and the longest document.
BLOCK_IDS = 1 << 19
#: Bytes of pre-tokens and their ids that a worker keeps.
KEPT_BYTES = 160 << 20

#: For each control byte the lengths of its four ids.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    sizes = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    used = np.arange(4, dtype=np.uint8) < sizes[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks back: lengths by table lookup, then each byte to its place."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < sizes[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def write_block(sink, keys: list, counts: list[int], ranks: np.ndarray, start: int) -> None:
    control, data = pack(ranks)
    sink.write(np.array([len(keys), len(ranks), start, len(control), len(data)], "<i8").tobytes())
    sink.write(np.array([k or 0 for k in keys], "<i8").tobytes() + bytes(k is None for k in keys))
    sink.write(np.array(counts, "<i8").tobytes())
    sink.write(control)
    sink.write(data)


def read_blocks(path: str) -> Iterator[tuple[list, np.ndarray, np.ndarray, int]]:
    """Keys, counts, ranks and ids before, block by block."""
    store, at = open_store(path)
    with store.open_input_stream(at) as source:
        while head := source.read(40):
            docs, ids, start, controls, size = np.frombuffer(head, "<i8").tolist()
            keys = np.frombuffer(source.read(8 * docs), "<i8").tolist()
            keys = [None if null else k for k, null in zip(keys, source.read(docs))]
            counts = np.frombuffer(source.read(8 * docs), "<i8")
            yield keys, counts, unpack(source.read(controls), source.read(size), ids), start


@functools.cache
def _tokenizer(path: str):
    """The library's tokenizer, the strings of its added tokens, and ids of pre-tokens seen lately."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # pre-tokens hold none, so they need not be searched
    return found, [x.content for x in found.get_added_tokens_decoder().values()], Kept(KEPT_BYTES)


def _encoded(tokenizer, words: list[str]) -> list[bytes]:
    """Packed ids of pre-tokens.  Those of letters alone, which are most, go through as the
    lines of one text: the library splits it at the line ends, and the id of these tells
    where the next one starts."""
    letters = [n for n, w in enumerate(words) if w.isalpha() or (w[0] == " " and w[1:].isalpha())]
    mark = tokenizer.encode("\n", add_special_tokens=False).ids
    out: list[bytes] = [b""] * len(words)
    rest = range(len(words))
    if letters and len(mark) == 1:
        ids = np.array(tokenizer.encode_batch_fast(["\n".join([words[n] for n in letters])], add_special_tokens=False)[0].ids, "<u4")
        ends = np.append(np.flatnonzero(ids == mark[0]), len(ids))
        if len(ends) == len(letters):
            packed, at = ids.tobytes(), 0
            for n, end in zip(letters, (4 * ends).tolist()):
                out[n] = packed[at:end]
                at = end + 4
            rest = sorted(set(rest).difference(letters))
    for n, got in zip(rest, tokenizer.encode_batch_fast([words[n] for n in rest], add_special_tokens=False)):
        out[n] = array("I", got.ids).tobytes()
    return out


def _ids(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where those of each text end.

    The library splits a text into pre-tokens and encodes each by itself; it is asked once
    for each distinct one that is not kept.  A text with the string of an added token,
    which the library finds before it splits, goes through it whole.
    """
    tokenizer, added, kept = _tokenizer(path)
    whole = [n for n, x in enumerate(texts) if any(a in x for a in added)]
    if whole:
        ids, ends = _ids(path, ["" if n in set(whole) else x for n, x in enumerate(texts)])
        parts = np.split(ids, ends[:-1])
        tokenizer.encode_special_tokens = False
        for n in whole:
            parts[n] = np.array(tokenizer.encode(texts[n], add_special_tokens=False).ids, np.uint32)
        tokenizer.encode_special_tokens = True
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])
    words, which, counts = distinct_pretokens(texts)
    packed = list(map(kept.get, words))
    new = [n for n, ids in enumerate(packed) if ids is None]
    unknown = [words[n] for n in new]
    found = _encoded(tokenizer, unknown)
    for n, ids in zip(new, found):
        packed[n] = ids
    kept.keep(unknown, found)
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    ids, ends = gather(np.frombuffer(b"".join(packed), np.uint32), sizes, which)
    return ids, by_text(ends, counts)


_FILE = "part int, path string, n_docs bigint, n_ids bigint"


def _file_row(part: int, path: str, docs: int, ids: int) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((part, path, docs, ids), kinds)], names=["part", "path", "n_docs", "n_ids"])


def _new_file(folder: str) -> str:
    """A name of its own for each attempt of a task: a rerun never meets a half file."""
    store, at = open_store(folder)
    store.create_dir(at, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}.ids"


def encode_files(docs: DataFrame, folder: str, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass: one file per range of keys, ids as the vocabulary numbers them.

    Returns a row per file.  Rows of one key are ordered by a hash of their text, which
    also lets a key with very many rows go to several ranges.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, file, total, before = TaskContext.get().partitionId(), None, 0, 0
        keys: list = []
        ids: list[bytes] = []
        held = 0

        def close_block():
            nonlocal before, held
            counts = [len(x) // 4 for x in ids]
            write_block(sink, keys, counts, np.frombuffer(b"".join(ids), "<u4"), before)
            before += sum(counts)
            keys.clear()
            ids.clear()
            held = 0

        for batch in steps(batches, 1):
            if file is None:
                file = _new_file(folder)
                store, at = open_store(file)
                sink = store.open_output_stream(at)
            end = np.array([END_ID], "<u4").tobytes()
            found, ends = _ids(path, texts_of(batch, 1))
            for k, a, b in zip(batch.column(0).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
                keys.append(k)
                ids.append(found[a:b].tobytes() + end)
                held += b - a + 1
                total += 1
                if held >= BLOCK_IDS:
                    close_block()
        if file is not None:
            if keys:
                close_block()
            sink.close()
            yield _file_row(part, file, total, before)

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text").mapInArrow(run, _FILE)


def _by_file(files: DataFrame) -> DataFrame:
    """One file per task, in order."""
    return files.repartitionByRange(max(1, files.count()), "part")


def id_counts(files: DataFrame) -> DataFrame:
    """How often each id occurs in the files of the first pass: ``id``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for _, _, ids, _ in read_blocks(path):
                    found = np.bincount(ids, minlength=len(total))
                    found[: len(total)] += total
                    total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return _by_file(files).mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def with_starts(files: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all files before.  One small row per file is ordered."""
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))


def rank_files(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Second pass: the same files with ids replaced by their frequency ranks.

    The order is bounded by the vocabulary, so it is sent to every task.
    """
    counts = id_counts(files).orderBy(F.desc("n"), "id").select("id").collect()
    order = np.array([r["id"] for r in counts], "<u4")
    store, at = open_store(folder)
    store.create_dir(at, recursive=True)
    with store.open_output_stream(f"{at}/order.bin") as sink:
        sink.write(order.tobytes())
    ranks = np.zeros(int(order.max(initial=0)) + 1, "<u4")
    ranks[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = _new_file(folder)
                store, at = open_store(file)
                docs = ids = 0
                with store.open_output_stream(at) as sink:
                    for keys, counts, own, before in read_blocks(row["path"]):
                        write_block(sink, keys, counts.tolist(), shared.value[own], row["start"] + before)
                        docs, ids = docs + len(keys), ids + len(own)
                yield _file_row(row["part"], file, docs, ids)

    return _by_file(with_starts(files)).mapInArrow(run, _FILE)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts, with id 0 after each, into ranked files in ascending key order.

    Returns the list of files (``part, path, n_docs, n_ids``), written already.  Null and
    empty texts hold the end id only; null keys come first; equal rows are written each;
    an empty table gives no file.  Other columns are not read.
    """
    spark = docs.sparkSession
    first = materialize(encode_files(docs, f"{folder}/first", tokenizer, key, text), "token-files")
    return materialize(rank_files(spark, first, f"{folder}/ranked"), "ranked-files")


READ = {"start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "ids_crc32": pa.int64()}


def read_token_files(
    files: DataFrame, folder: str, outputs: tuple[str, ...] = ("start", "n_tokens", "ids"), key: str = "doc_id"
) -> DataFrame:
    """Documents back from the files: the key and the ``outputs`` asked for.

    ``ids`` are little-endian unsigned 32-bit integers, ``ids_crc32`` their checksum.
    """
    order_path = f"{folder}/ranked/order.bin"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = None
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if order is None:
                    store, at = open_store(order_path)
                    with store.open_input_stream(at) as source:
                        order = np.frombuffer(source.read(), "<u4")
                for keys, counts, ranks, start in read_blocks(path):
                    ids = order[ranks]
                    ends = np.cumsum(counts)
                    got = {x: [] for x in outputs}
                    for a, b in zip((ends - counts).tolist(), ends.tolist()):
                        packed = ids[a:b].tobytes()
                        row = {"start": start + a, "n_tokens": b - a, "ids": packed}
                        for x in outputs:
                            got[x].append(row[x] if x in row else zlib.crc32(packed))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), *(pa.array(got[x], READ[x]) for x in outputs)], names=[key, *outputs])

    kinds = ", ".join(f"{x} {'binary' if x == 'ids' else 'bigint'}" for x in outputs)
    return _by_file(files).mapInArrow(run, f"`{key}` bigint, {kinds}")


def token_files(docs: DataFrame, outputs: tuple[str, ...] = ("start", "n_tokens", "ids"), tokenizer: str | None = None) -> DataFrame:
    """Write to a new folder below the shared one and read back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder, outputs)
