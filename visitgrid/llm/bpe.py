"""Byte-level BPE from a rank file: encoding by longest matches, and decoding.

A sequence of tokens is the BPE result of its bytes exactly if no two neighbours would
have merged across their border.  So a pre-token is encoded left to right: take the
longest token that starts here (an Aho-Corasick automaton over bytes written as Latin-1
finds it for all places in one pass), check it against the token before it, fall back to
its next shorter prefix, and step back where none fits.  Places found to have no
continuation are remembered, so the work is linear in the length of the pre-token.

Whether two tokens may stand side by side is worked out from their merge trees and kept.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import steps, texts_of
from .pretokens import by_text, distinct_pretokens, gather

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens and token pairs that a worker keeps; a full table is emptied and filled anew.
KEPT_WORDS, KEPT_PAIRS = 400_000, 1_000_000
NEVER = 1 << 62

OUTPUTS = {
    "n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.binary(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
}
_SQL = {"n_tokens": "bigint", "ids": "binary", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class RankEncoder:
    """Exact BPE over a rank table that holds every single byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.word: dict[int, bytes] = {rank: word for word, rank in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.kept: dict[str, bytes] = {}
        reached = {word for word in ranks if len(word) == 1}
        for word, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for cut in range(1, len(word)):
                a, b = word[:cut], word[cut:]
                if a in reached and b in reached and ranks[a] < rank > ranks[b] and self._fits(ranks[a], ranks[b], rank):
                    self.left[rank], self.right[rank] = ranks[a], ranks[b]
                    reached.add(word)
                    break
        self.reached = reached
        every = [self.word.get(n, b"") for n in range(max(self.word, default=-1) + 1)]
        self.sizes = np.fromiter(map(len, every), np.int64, len(every))
        self.bytes = np.frombuffer(b"".join(every), np.uint8)
        # Matches that end at a place of the reversed bytes start at that place of the bytes.
        self.automaton = ahocorasick.Automaton()
        for word in reached:
            self.automaton.add_word(word[::-1].decode("latin-1"), ranks[word])
        self.automaton.make_automaton()

    def _fits(self, a: int, b: int, now: int = NEVER) -> bool:
        """Whether a and b stay apart under all merges of a rank below ``now``.

        Going back in time from the whole tokens, x is the last piece of a and y the first
        of b.  A piece lives from its own rank to that of the piece it became part of; a
        merge of x and y in that time would have crossed the border.  Of equal ranks the
        left merge comes first.
        """
        ranks, word, left, right = self.ranks, self.word, self.left, self.right
        x, x_until, y, y_until = a, now, b, now
        while True:
            merged = ranks.get(word[x] + word[y], NEVER)
            if merged < x_until and merged <= y_until and merged < now:
                return False
            x_born, y_born = x if x in right else -1, y if y in left else -1
            if x_born > y_born:
                x, x_until = right[x], x
            elif y_born >= 0:
                y, y_until = left[y], y
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._fits(a, b)
        return known

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, -1 if none is."""
        known = self.shorter.get(token)
        if known is None:
            word = self.word[token]
            known = next((self.ranks[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in self.reached), -1)
            self.shorter[token] = known
        return known

    def encode_bytes(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [-1] * size
        for end, token in self.automaton.iter(piece[::-1].decode("latin-1")):
            if longest[size - 1 - end] < 0:  # the longest comes first
                longest[size - 1 - end] = token
        word, fits, next_shorter = self.word, self.fits, self.next_shorter
        blocked = bytearray(size + 1)
        out: list[int] = []
        at, token = 0, longest[0] if size else -1
        while at < size:
            while token >= 0:
                end = at + len(word[token])
                if not blocked[end] and (not out or fits(out[-1], token)):
                    break
                token = next_shorter(token)
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                blocked[at] = 1
                token = out.pop()
                at -= len(word[token])
                token = next_shorter(token)
        return out

    def packed(self, words: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        kept = self.kept
        if len(kept) > KEPT_WORDS:
            kept.clear()
        found = list(map(kept.get, words))
        for n, ids in enumerate(found):
            if ids is None:
                w = words[n]
                found[n] = kept[w] = array("I", self.encode_bytes(w.encode("utf-8", "surrogatepass"))).tobytes()
        return found

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each text end."""
        words, which, counts = distinct_pretokens(texts)
        packed = self.packed(words)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        ids, ends = gather(np.frombuffer(b"".join(packed), np.uint32), sizes, which)
        return ids, by_text(ends, counts)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and where those of each id end.

        An id that the vocabulary lacks is an error.
        """
        if len(ids) and (int(ids.max()) >= len(self.sizes) or not self.sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return gather(self.bytes, self.sizes, ids)


@functools.cache
def encoder(path: str) -> RankEncoder:
    return RankEncoder(read_ranks(path))


def encode(
    docs: DataFrame, vocabulary: str | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids"),
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Encode whole texts and decode the ids again: the key and the ``outputs`` asked for.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` the bytes they stand
    for; the digests are lowercase hex SHA-256 of these two.  Null and empty texts have no
    ids.  Rows are not merged: equal rows and null keys give a row each.  Only the two
    named columns are read, so other columns of any name do no harm.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    decodes = any(x.startswith("decoded") for x in outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in steps(batches, 1):
            ids, ends = bpe.encode_texts(texts_of(batch, 1))
            if decodes:
                plain, plain_ends = bpe.decode(ids)
                plain_ends = np.append(0, plain_ends)[ends]
            else:
                plain, plain_ends = np.zeros(0, np.uint8), np.zeros_like(ends)
            got = {x: [] for x in outputs}
            last = plain_last = 0
            for end, plain_end in zip(ends.tolist(), plain_ends.tolist()):
                row = {"n_tokens": end - last, "ids": ids[last:end].tobytes(), "decoded": plain[plain_last:plain_end].tobytes()}
                last, plain_last = end, plain_end
                for x in outputs:
                    got[x].append(row[x] if x in row else hashlib.sha256(row[x.removesuffix("_sha256")]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(got[x], OUTPUTS[x]) for x in outputs)], names=[key, *outputs])

    rows = docs.select(key, text)
    schema = ", ".join([f"`{key}` {rows.schema[key].dataType.simpleString()}", *(f"{x} {_SQL[x]}" for x in outputs)])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of packed ids: the key and ``text``; bytes that are no UTF-8 become U+FFFD.

    Null ids give a null text, empty ids an empty one.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            packed = [x if x is None else bpe.decode(np.frombuffer(x, "<u4"))[0].tobytes() for x in batch.column(1).to_pylist()]
            out = [x if x is None else x.decode("utf-8", "replace") for x in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[key, "text"])

    rows = encoded.select(key, ids)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, text string")
