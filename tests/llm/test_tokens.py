"""Pre-tokens, both encoders, token files and counts against the libraries or brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitgrid.llm import bpe, tokenfile, unigram
from visitgrid.llm.pretokens import distinct_pretokens, pretokens

from ..conftest import SMALL

TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("aAbst'dmrevl  \n\t1²é!.漢😀 \x1c\x85\0\U0010ffff")), max_size=20), max_size=6)
SPLIT = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(tokenfile.TOKENIZER))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_split_is_that_of_the_pattern(texts):
    words, counts = pretokens(texts)
    want = [SPLIT.findall(x) for x in texts]
    assert words == [w for x in want for w in x] and counts.tolist() == list(map(len, want))
    own, which, again = distinct_pretokens(texts)
    assert [own[i] for i in which] == words and again.tolist() == counts.tolist() and len(set(own)) == len(own)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_library(texts):
    own = bpe.encoder(public_tokenizers.path(bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids, ends = own.encode_texts(texts)
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [library.encode_ordinary(x) for x in texts]
    assert own.decode(ids)[0].tobytes() == "".join(texts).encode()


def test_long_pieces_and_unknown_ids(ranks, library):
    own = bpe.encoder(public_tokenizers.path(bpe.VOCABULARY))
    for piece in ("a" * 3001, "ab" * 2000, "=" * 4097, "ÄÖ" * 1500):
        assert own.encode_bytes(piece.encode()) == library.encode_ordinary(piece)
    with pytest.raises(ValueError):
        own.decode(np.array([len(ranks) + 5], "<u4"))


def test_encode_documents(spark, library, edges, nothing):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (docs, edges):
        rows = df.select("doc_id", "text").collect()
        want = sorted((str(r["doc_id"]), tuple(library.encode_ordinary(r["text"] or "")), r["text"] or "") for r in rows)
        encoded = bpe.encode(df, outputs=("n_tokens", "ids", "decoded"))
        got = encoded.collect()
        assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["decoded"].decode()) for r in got) == want
        assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got)
        assert sorted(r["text"] for r in bpe.decode(encoded).collect()) == sorted(x[2] for x in want)
    assert bpe.encode(nothing).count() == 0


def test_pack_round_trip():
    for ranks in ([], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(0, 1 << 20, 37))):
        ranks = np.array(ranks, "<u4")
        control, data = tokenfile.pack(ranks)
        assert tokenfile.unpack(control, data, len(ranks)).tolist() == ranks.tolist()
        assert len(control) == -(-len(ranks) // 4)


def test_token_files(spark, tokenizer, edges, nothing, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in tokenfile.token_files(docs, ("start", "n_tokens", "ids_crc32")).collect()}
    start = 0
    for key in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[key], add_special_tokens=False).ids, 0], "<u4")
        assert (got[key]["start"], got[key]["n_tokens"], got[key]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)

    # added tokens as the library finds them
    texts = ["a<|endoftext|>b", "<|endoftext|>", "", "plain", " <|endoftext|> <|endoftext|>x", "<|endoftext", "a b " * 9]
    rows = tokenfile.token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == [[*tokenizer.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert 50256 in np.frombuffer(rows[0]["ids"], "<u4")

    # nulls first, equal keys and rows each, ids back in order
    rows = tokenfile.token_files(edges.repartition(4)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
    decoded = [tokenizer.decode(np.frombuffer(r["ids"], "<u4")[:-1].tolist()) for r in rows]
    assert decoded[:2] == ["two words"] * 2 and decoded[2:4] == ["", ""] and decoded[9] == "z" * 30_000
    assert tokenfile.token_files(nothing).count() == 0


def test_frequent_ids_take_one_byte(spark, tmp_path):
    docs = spark.createDataFrame([(i, "the cat and the dog " * 50) for i in range(20)], "doc_id bigint, text string")
    files = tokenfile.write_token_files(docs, str(tmp_path))
    for path in [r["path"] for r in files.collect()]:
        for _, _, ranks, _ in tokenfile.read_blocks(path):
            assert ranks.max() < 16
    assert np.frombuffer((tmp_path / "ranked/order.bin").read_bytes(), "<u4").size < 16


def brute_count(pieces, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[b][0] + pieces[word[b:end]], -best[b][1] - 1) for b in range(end) if word[b:end] in pieces]
        if word[end - 1] not in pieces:
            size = len(word[end - 1].encode())
            found.append((best[end - 1][0] + size * unigram.BYTE_SCORE, -best[end - 1][1] - size))
        score, tokens = max(found)
        best.append((score, -tokens))
    return best[-1][1]


def test_unigram_counts(spark, edges, nothing, monkeypatch):
    pieces = unigram.read_pieces(public_tokenizers.path(unigram.VOCABULARY))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    for df in (docs, edges):
        known = {}
        for r in df.select("doc_id", "text").collect():
            words = SPLIT.findall(r["text"] or "")
            counts = [brute_count(pieces, w.replace(" ", "▁")) if len(w) < 500 else None for w in words]
            if None not in counts:
                known[r["doc_id"]] = (len(words), sum(counts))
        got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in unigram.count_tokens(df).collect()}
        assert {k: got[k] for k in known} == known and len(known) > 5
    assert unigram.count_tokens(nothing).count() == 0


def test_long_pre_tokens_count_alike(monkeypatch):
    trie = unigram.Trie(unigram.read_pieces(public_tokenizers.path(unigram.VOCABULARY)))
    words = ["the" * 40, "abcdef" * 30, "漢字" * 60]
    kept = [trie.count(w) for w in words]
    monkeypatch.setattr(unigram, "LONGEST_KEPT", 5)
    assert [trie.count(w) for w in words] == kept
