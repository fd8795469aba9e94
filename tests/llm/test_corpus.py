"""Neighbour votes, phrase growth and token alignment against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitgrid.llm import alignment, collocations, neighbours
from visitgrid.llm.kept import Kept

from ..conftest import SMALL

# phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, least, longest, top):
    counts, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    inside = {(lang, p[i : i + k]) for (lang, p), a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if counts[lang, p[i : i + k]] == a}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in inside:
            cuts = ((1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, n, p.decode(), -a, left, right, total[lang], -score)
        for lang, rows in out.items() for n, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def phrase_rows(seed, docs):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "e", "\0", "a-b"]
    fixed = [" ".join(rng.choices(words, k=7)) for _ in range(6)]
    rows = []
    for n in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words[: rng.choice((3, 10, 34))], k=rng.randint(1, 9))) for _ in range(rng.randint(0, 9))]
        rows.append((rng.choice([". ", "\t", " ", "\n", "; "]).join(parts), rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \t ", "de"), ("X Y x y X Y", ""), *[("Twin twin twin TWIN", "en")] * 12]


@pytest.mark.parametrize(("least", "top", "widen"), [(3, 10_000, 64), (3, 5, 4), (10_000, 5, 64)])
def test_phrases(spark, monkeypatch, least, top, widen):
    """Small places force pruning, ties and asked-for second parts; small blocks split the counts."""
    monkeypatch.setattr(collocations, "WIDEN", widen)
    rows = phrase_rows(least * top, 80)
    df = spark.createDataFrame(rows, "body string, language string").withColumn("text", F.lit(1)).withColumn("lang", F.lit(2)).repartition(3)
    got = collocations.collocations(df, least, 5, top, text="body", lang="language").collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, least, 5, top)
    assert bool(got) == (least < 10_000)


def test_phrases_of_edges(spark, edges, nothing):
    assert collocations.collocations(nothing, 1).collect() == []
    rows = [(r["text"], r["lang"]) for r in edges.where("doc_id IS NULL OR doc_id NOT IN (6, 7)").collect()]
    got = collocations.collocations(edges.where("doc_id IS NULL OR doc_id NOT IN (6, 7)"), 1, 5, 50).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 1, 5, 50)
    long = collocations.collocations(edges.where("doc_id = 6"), 100).where("lang = 'la'").collect()
    assert len(long) == 5 and {r["a"] for r in long} == {3999, 4000}


def test_pruned_prefixes_are_never_counted(spark):
    """With one place taken by a rare pair, pairs of frequent words are not even candidates."""
    rows = [("rare pair",)] * 5 + [("the of",), ("of the",), ("the the",)] * 200
    docs = spark.createDataFrame(rows, "text string").withColumn("lang", F.lit("en"))
    every = collocations.count_words(docs, 1).withColumn("n", F.lit(1210).cast("bigint")).where("a >= 5").persist()
    found = collocations.grow(collocations.frequent_runs(docs, every, 1).persist(), every, 5, 5, 1)
    assert {r["a"] for r in found.collect()} == {5}


# alignment

TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("aAbet'drsl   \n\t1é!.漢😀▁\x1c\x85\0 ")), max_size=25), max_size=6)


@pytest.fixture(scope="module")
def tools():
    return alignment.aligner(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))


def brute_groups(tools, text):
    """Ids of both sides by the libraries on the whole text, cut where both end."""
    if not text:
        return None
    a, b = tools.byte_level.encode(f" {text}", add_special_tokens=False).ids, tools.pieces.encode(text)
    want = f" {text}".encode()
    if b"".join(tools.bytes_a[i] for i in a) != want or b"".join(tools.bytes_b[i] for i in b) != want:
        return None
    ends_a, ends_b = ([0, *np.cumsum([len(table[i]) for i in ids]).tolist()] for ids, table in ((a, tools.bytes_a), (b, tools.bytes_b)))
    cuts = sorted(set(ends_a) & set(ends_b))
    return [(a[ends_a.index(x) : ends_a.index(y)], b[ends_b.index(x) : ends_b.index(y)]) for x, y in zip(cuts, cuts[1:])]


def brute_alignment(tools, texts):
    groups = [brute_groups(tools, x) for x in texts]
    links = [collections.Counter((a, b) for x, y in g or () for a in x for b in y) for g in groups]
    docs, most = collections.Counter(p for x in links for p in x), collections.Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for g, x in zip(groups, links):
        spelt = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or ())
        out.append((
            sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), sum(x.values()),
            sum(n for p, n in x.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in x.items()),
            hashlib.sha256(spelt.encode()).hexdigest() if g else ""))
    return out


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_tokens_and_cuts(texts):
    tools = alignment.aligner(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))
    (a, bounds_a), (b, bounds_b) = tools.tokens(texts)
    cuts, _ = alignment.shared_cuts(np.cumsum(tools.sizes_a[a]), np.cumsum(tools.sizes_b[b]), bounds_a)
    for n, text in enumerate(texts):
        want = brute_groups(tools, text) or []
        assert a[bounds_a[n] : bounds_a[n + 1]].tolist() == [i for x, _ in want for i in x]
        assert b[bounds_b[n] : bounds_b[n + 1]].tolist() == [i for _, x in want for i in x]
        assert ((cuts >= bounds_a[n]) & (cuts < bounds_a[n + 1])).sum() == len(want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60), max_size=25), st.sets(st.integers(1, 60), max_size=25)), max_size=4))
def test_shared_cuts(texts):
    """Any ends at all, also texts that are one group throughout."""
    a = [sorted(x | {61}) for x, _ in texts]
    b = [sorted(y | {61}) for _, y in texts]
    ends_a, ends_b = (np.array([n * 61 + e for n, x in enumerate(s) for e in x], np.int64) for s in (a, b))
    bounds = np.append(0, np.cumsum([len(x) for x in a])).astype(np.int64)
    cuts, others = alignment.shared_cuts(ends_a, ends_b, bounds)
    assert ends_a[cuts].tolist() == sorted(set(ends_a.tolist()) & set(ends_b.tolist())) == ends_b[others].tolist()


EDGE_TEXTS = [
    None, "", " ", "a", "a", "foo  bar \n x", "a▁b", "<|endoftext|></s>", "日本語 text", "\0 😀", "z" * 3000, "the cat the cat", "the dog", "to " * 500,
    "".join(random.Random(3).choices("abcdef0123+/=", k=6000)),
]


@pytest.mark.parametrize(("block", "large"), [(2_000_000, 1 << 12), (40, 2)])
def test_alignment(spark, tools, monkeypatch, block, large):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", block)
    monkeypatch.setattr(alignment.block_bounds, "__defaults__", (block,))
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    df = spark.createDataFrame(list(enumerate(EDGE_TEXTS)), "id bigint, body string").withColumn("pairs", F.lit("x")).withColumn("n_best", F.lit(1)).repartition(4)
    got = sorted(alignment.link_counts(df, key="id", text="body").collect())
    assert [tuple(r)[1:] for r in got] == brute_alignment(tools, EDGE_TEXTS)


def test_alignment_of_edges(spark, tools, edges, nothing):
    assert alignment.link_counts(nothing).collect() == []
    want = brute_alignment(tools, [r["text"] for r in edges.collect()])
    got = alignment.link_counts(edges).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(want) and sum(r["doc_id"] is None for r in got) == 2


def test_large_groups_are_reduced_first(tools, monkeypatch):
    a, b = np.array([1, 1, 2, 3]), np.array([5, 6, 5])
    want = alignment.document_pairs(a, b, np.array([3]), np.array([2]), np.array([0]), 10, 10)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    monkeypatch.setattr(alignment, "LINKS", 2)
    got = alignment.document_pairs(a, b, np.array([3]), np.array([2]), np.array([0]), 10, 10)
    assert [x.tolist() for x in got] == [x.tolist() for x in want] == [[0] * 6, [15, 16, 25, 26, 35, 36], [4, 2, 2, 1, 2, 1]]


def test_kept_is_bounded_in_bytes():
    kept = Kept(2000)
    for n in range(1000):
        kept.keep([str(n)], [b"abcd"])
        assert kept.held <= 2000 + 300 and len(kept) < 20
    kept.keep(["x" * 300, "y"], [(b"", b"a"), (b"b", b"c")])
    assert "x" * 300 not in kept and kept["y"] == (b"b", b"c")


# neighbour votes


@pytest.fixture(scope="module")
def votes(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    return docs, labels, neighbours.train_on_open_rows(docs, labels)


def test_votes_are_those_of_all_labelled_vectors(votes):
    docs, _, model = votes
    scored, name = neighbours.score(docs, model)
    place = neighbours.places_of(model.space.trigrams)
    for r in scored.limit(60).collect():
        rows = [x for _, x in neighbours.vectors_of(pa.array([r["text"]], pa.string()), place, model.space.weights)][0]
        vector = rows[0] @ model.space.axes
        cosine = model.vectors @ vector / np.linalg.norm(vector)
        least = sorted(cosine, reverse=True)[neighbours.NEIGHBOURS - 1]
        near = cosine >= least - 1e-6
        weight = np.maximum(cosine[near], 0).astype(float) ** neighbours.POWER
        assert 0 <= r[name] <= 1 and abs(r[name] - (weight @ model.labels[near]) / weight.sum()) < 1e-3


def test_trigrams_and_habits():
    texts = ["", "ab", "abcd", "é!", "Go go\ngo GO $$ x\ngo GO $$ x", "a\0b\n\na\0b"]
    codes, doc = neighbours.trigram_codes(pa.array(texts))
    want = [(n, int.from_bytes(x.encode()[i : i + 3], "big")) for n, x in enumerate(texts) for i in range(len(x.encode()) - 2)]
    assert list(zip(doc.tolist(), codes.tolist())) == want
    step = neighbours.habits(pa.array([None, *texts]))
    assert step[0].tolist() == step[1].tolist() == [0, 0, 0, 0]
    share = [4 / 8, 4 / 8, 5 / 14, 1 / 3]  # repeated words, symbols by word, capitals, repeated lines
    assert step[5].tolist() == np.searchsorted(neighbours.SHARES, share, side="right").tolist()


def test_votes_on_held_out_rows(spark):
    """Learnt at the middle size: the held-out labels are told apart."""
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = neighbours.train_on_open_rows(docs, labels)
    scored, name = neighbours.score(docs, model)
    rows = scored.join(labels, "doc_id").where(neighbours.held_out()).select(name, "quality").collect()
    assert rows and np.mean([(s >= neighbours.THRESHOLD) == bool(q) for s, q in rows]) >= 0.96


def test_held_out_labels_are_not_read(votes):
    docs, labels, model = votes
    other = labels.withColumn("quality", F.when(neighbours.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = neighbours.train_on_open_rows(docs, other)
    assert np.array_equal(again.labels, model.labels) and np.allclose(again.vectors, model.vectors, atol=1e-4)
    ids = [r["doc_id"] for r in docs.where(neighbours.held_out()).collect()]
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)


def test_votes_on_edges(spark, votes, edges, nothing):
    _, labels, model = votes
    scored, name = neighbours.score(edges, model)
    rows = scored.collect()
    assert name not in edges.columns and len(rows) == 11 and all(0 <= r[name] <= 1 for r in rows)
    same = {r[name] for r in rows if not r["text"]}
    assert len(same) == 1
    assert neighbours.score(nothing, model)[0].collect() == []
    blank = neighbours.train(nothing, labels)
    scored, name = neighbours.score(edges, blank)
    assert {r[name] for r in scored.collect()} == {0.5}
