"""Token counts under a unigram model, with a trie that shares the dynamic programme.

A pre-token's best segmentation is found left to right: the best score of a prefix is the
best over the pieces that end there of the score of what comes before plus the piece's.
That depends on the prefix alone, so distinct pre-tokens are put in a trie and each node
keeps the best score and its number of tokens; a node is worked out once for all
pre-tokens that pass it, and the node where a pre-token ends has its count.

Pieces come from a public vocabulary.  Its order is by falling use, so the score of the
piece of rank r is -ln(r + 2.7), Zipf's law; a character that no piece covers falls back to
its UTF-8 bytes, each at ``BYTE_SCORE``.  Of equal scores the one with fewer tokens wins.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import steps, texts_of
from .pretokens import by_text, distinct_pretokens

VOCABULARY = "piece_bpe_32k.model"
BYTE_SCORE = -25.0
BLANK = "▁"
#: Trie nodes that a worker keeps; beyond, it starts a new trie.
KEPT_NODES = 500_000
#: Longer pre-tokens are worked out the same way without adding nodes.
LONGEST_KEPT = 200


def read_pieces(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    ordinary = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {piece: -math.log(rank + 2.7) for rank, piece in enumerate(ordinary)}


class Trie:
    """Forward scores by prefix; node 0 is the empty one."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]

    def step(self, word: str, end: int, scores: list[float], tokens: list[int], first: int) -> None:
        """Append best score and number of tokens of ``word[:end]``; the lists hold those of
        its prefixes from length ``first`` on."""
        get = self.pieces.get
        best, count = -math.inf, 0
        for begin in range(max(0, end - self.longest), end):
            piece = get(word[begin:end])
            if piece is not None:
                score = scores[begin - first] + piece
                if score > best or score == best and tokens[begin - first] + 1 < count:
                    best, count = score, tokens[begin - first] + 1
        if piece is None:  # the last character alone is no piece
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            score, n = scores[-1] + size * BYTE_SCORE, tokens[-1] + size
            if score > best or score == best and n < count:
                best, count = score, n
        scores.append(best)
        tokens.append(count)

    def count(self, word: str) -> int:
        """Tokens of a pre-token."""
        scores, tokens = [0.0], [0]
        if len(word) > LONGEST_KEPT:
            for end in range(1, len(word) + 1):
                self.step(word, end, scores, tokens, end - len(scores))
                if len(scores) > 4 * self.longest:  # the last prefixes are enough
                    del scores[: -self.longest], tokens[: -self.longest]
            return tokens[-1]
        child, node = self.child, 0
        for end, char in enumerate(word, 1):
            found = child.get((node, char))
            if found is None:
                self.step(word, end, scores, tokens, 0)
                found = child[node, char] = len(self.score)
                self.score.append(scores[-1])
                self.tokens.append(tokens[-1])
            else:
                scores.append(self.score[found])
                tokens.append(self.tokens[found])
            node = found
        return tokens[-1]


@functools.cache
def _trie(path: str) -> Trie:
    return Trie(read_pieces(path))


def count_tokens(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, ``n_pretokens`` and ``n_tokens`` of every whole text.

    Null and empty texts have none.  Equal rows give a row each, null keys too; other
    columns are not read.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for batch in steps(batches, 1):
            if len(trie.score) > KEPT_NODES:
                trie.clear()
            words, which, counts = distinct_pretokens(texts_of(batch, 1))
            tokens = np.fromiter((trie.count(w.replace(" ", BLANK)) for w in words), np.int64, len(words))
            ends = by_text(np.cumsum(tokens[which]), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(np.diff(ends, prepend=0), pa.int64())],
                names=[key, "n_pretokens", "n_tokens"])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, n_pretokens bigint, n_tokens bigint")
