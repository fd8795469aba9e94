"""Near duplicates against brute force, components against union-find."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from visitgrid.llm import minhash
from visitgrid.llm.components import components

from ..conftest import SMALL


def plain(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    words = plain(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else {("text", text or "")})


def groups(keys, links):
    """Smallest key of each one's group."""
    above = {k: k for k in keys}

    def top(k):
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {k: top(k) for k in keys}


def weights(text):
    """1 + ln(count) of each shingle, 1 where all occur equally often."""
    words = plain(text)
    counts = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or Counter(shingle_set(text))
    return {x: 1.0 for x in counts} if len(set(counts.values())) == 1 else {x: 1 + math.log(n) for x, n in counts.items()}


def weighted_similarity(one, two):
    """Probability Jaccard by its definition."""
    every = list(one.keys() | two.keys())
    x, y = (np.array([side.get(j, 0) for j in every]) for side in (one, two))
    common = (x > 0) & (y > 0)
    return sum(1 / np.maximum(x / a, y / b).sum() for a, b in zip(x[common], y[common]))


def brute_classes(texts):
    """Texts of one set of shingles are one node, with the counts of its smallest key."""
    nodes, links = {}, []
    for k in sorted(texts):
        first = nodes.setdefault(frozenset(shingle_set(texts[k])), k)
        links.append((first, k))
    sets, weigh = {k: s for s, k in nodes.items()}, {k: weights(texts[k]) for k in nodes.values()}
    holders = {}
    for k, s in sets.items():
        common = {}
        for x in s:
            for other in holders.setdefault(x, []):
                common[other] = common.get(other, 0) + 1
            holders[x].append(k)
        for o, n in common.items():
            near = 5 * n >= 4 * (len(s) + len(sets[o]) - n)
            uneven = len(set(weigh[k].values()) | set(weigh[o].values())) > 1
            if near or (uneven and weighted_similarity(weigh[k], weigh[o]) >= 0.8):
                links.append((k, o))
    return groups(texts, links)


def edited(words, rng, share):
    return " ".join(w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words)


@pytest.fixture(scope="module")
def mixed(spark):
    """Given documents, a large group of near copies with all similarities about the limit,
    exact copies, chains, and pairs on both sides of the limit."""
    rng = random.Random(4)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    base = [f"b{i}" for i in range(150)]
    n = 10_000
    for _ in range(400):
        texts[n] = edited(base, rng, rng.choice([0.01, 0.02, 0.03, 0.05]))
        n += 1
    for _ in range(300):
        texts[n] = "one text that many documents hold word by word and nothing else at all"
        n += 1
    words = [f"c{i}" for i in range(200)]
    for i in range(12):  # a chain: neighbours are near, the ends are not
        texts[n] = " ".join(words[i * 8 : i * 8 + 100])
        n += 1
    for size in (1, 3, 4, 5, 6):
        for _ in range(2):
            texts[n] = " ".join(f"s{size}x{k}" for k in range(size))
            n += 1
    return texts


def test_classes_against_brute_force(spark, mixed):
    docs = spark.createDataFrame(list(mixed.items()), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert got == brute_classes(mixed)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_repeated_passages_do_not_hide_near_copies(spark):
    """Pairs above and below the limit, one side with a passage that it repeats; and texts of
    one set of shingles that repeat unequally."""
    texts, n = {}, 0
    for pair in range(60):
        shared = [f"p{pair}w{i}" for i in range(160)]
        own = [f"p{pair}x{i}" for i in range(15)]
        other = 18 if pair % 6 else 40
        texts[n] = " ".join(shared + own * 500)
        texts[n + 1] = " ".join(shared + [f"p{pair}y{i}" for i in range(other)])
        if pair % 3 == 0:
            texts[n + 2] = " ".join(shared + own * 2)
        n += 3
    found = brute_classes(texts)
    assert len(set(found.values())) == 70  # all pairs but those of the long other ends
    for pair in range(60):  # near by weight only: what both repeat weighs more than what each has alone
        shared = [f"q{pair}w{i}" for i in range(60)]
        for side in "xy":
            texts[n] = " ".join(shared * (30 if pair % 2 else 2) + [f"q{pair}{side}{i}" for i in range(25)])
            n += 1
    found = brute_classes(texts)
    assert 70 + 60 < len(set(found.values())) < 70 + 120
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()} == found


def test_many_nodes_are_joined_without_a_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(80)]
    texts = {n: edited(base, rng, 0.03) for n in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    assert {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()} == brute_classes(texts)


def test_edges(spark, edges, nothing):
    rows = minhash.classes(edges).collect()
    named = sorted((str(r["doc_id"]), r["class_id"], r["copy_id"]) for r in rows)
    # null and empty texts are copies, texts without words by their text; a row without key is alone
    assert named == sorted([
        ("1", 1, 1), ("2", 1, 1), ("3", 3, 3), ("4", 4, 4), ("5", 5, 5), ("5", 5, 5), ("6", 6, 6), ("7", 7, 7), ("8", 8, 8),
        ("None", None, None), ("None", None, None)])
    kept = minhash.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "None"]
    assert minhash.classes(nothing).count() == 0 and minhash.keep_one(nothing).count() == 0


def test_sketch_estimates_probability_jaccard():
    """Shares of equal registers against the weighted similarity, worked out by its sum."""
    rng = random.Random(9)
    pairs = []
    for _ in range(60):
        x = {s: rng.choice([1, 1, 2, 5]) for s in range(40)}
        pairs.append((x, {s if rng.random() < 0.8 else s + 100: w * rng.choice([1, 1, 3]) for s, w in x.items()}))
    sets = [s for pair in pairs for s in pair]
    doc = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
    number = minhash.mix(np.array([k for s in sets for k in s], np.uint64) + np.uint64(12345))
    weight = np.array([w for s in sets for w in s.values()], float)
    registers = minhash.sketch(doc, number, weight, len(sets))
    share = [(registers[2 * i] == registers[2 * i + 1]).mean() for i in range(len(pairs))]
    exact = [
        sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys()) for x, y in pairs]
    assert abs(np.mean(share) - np.mean(exact)) < 0.01
    assert np.abs(np.array(share) - exact).max() < 5 * np.sqrt(0.25 / minhash.REGISTERS)


def test_shingles_have_counts():
    doc, shingle, count = minhash.shingles_of(pa.array(["a b c d e a b c d e", "a b", None, "!"]))
    assert np.bincount(doc, minlength=4).tolist() == [5, 1, 0, 0] and sorted(count.tolist()) == [1, 1, 1, 1, 1, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500 + i) for i in range(60)]
    want = groups({k for e in edges for k in e if e[0] != e[1]}, [e for e in edges if e[0] != e[1]])
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
