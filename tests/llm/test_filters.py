"""Quality rules, licenses, decontamination and toxicity."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitgrid.llm import decontamination, licenses, quality, toxicity

from ..conftest import SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def text_of(start, count):
    return " ".join(f"w{i}" for i in range(start, start + count))


# quality rules


def brute_measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    hit = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in (i, i + 1, i + 2)} if len(words) < 3000 else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), hit if hit is None else len(hit)


def test_measures(spark, edges):
    fixed = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["a b c a b c", "a a a a a", "x\ny\nx\n\n\n", "# | <>", "a b c d a b c x a b", "  a\x0bb\x0cc\rd"])], "doc_id bigint, text string")
    for df in (edges, fixed):
        measured, name = quality.measure(df)
        for r in measured.select("text", f"{name}.*").collect():
            want = brute_measures(r["text"])
            assert [r[x] for x in quality.MEASURES][: 4 if want[4] is None else 5] == list(want[: 4 if want[4] is None else 5])


def test_host_verdicts(spark):
    good, bad = text_of(0, 60), "short"
    rows = [("bad", i, bad if i < 45 else good) for i in range(50)] + [("good", i, good) for i in range(400)] 
    rows += [(f"fair{h}", i, bad if i < 8 + h % 3 else good) for h in range(20) for i in range(60)]
    rows += [("tiny", 0, bad), (None, 0, good)]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id bigint, source string, n int, text string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    by_host = {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()}
    assert by_host == {"good": 400, None: 1} | {f"fair{h}": 52 - h % 3 for h in range(20)}
    # one document says little: its host is not rejected, whatever its own fate
    hosts = quality.host_counts(*quality.measure(docs))
    assert [r["host"] for r in quality.rejected_hosts(hosts).collect()] == ["bad"]
    # without a spread between hosts there is no verdict on any
    assert quality.beta_priors(hosts.where("host = 'bad'")) == {}


def test_many_rejected_hosts_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_HOSTS", 0)
    test_host_verdicts(spark)


def test_quality_edges(spark, edges, nothing):
    kept = quality.keep_good(edges)
    assert kept.columns == edges.columns and kept.count() == 0
    assert quality.keep_good(nothing).count() == 0


# licenses


def test_license_scan_against_brute_force(spark, edges, nothing):
    notices = licenses.TEMPLATES
    apache = next(iter(notices))
    texts = [
        "All rights reserved. ALL, rights: reserved!", "cc-by then cc by", f"x\n{apache}\ny", "licensed under the apache license of 2.0", "the the the",
        "Released under an MIT License", "released under mit\nlicense", "GENERAL PUBLIC LICENSE", "GNU General Public License, version 3: this work is licensed under it",
        "Kdfoo all rights reserve", " ".join(notices), "\n".join(notices) * 3,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").union(edges.select(F.lit(99).cast("bigint"), "text"))
    found, name = licenses.label(docs)
    for r in found.select("text", f"{name}.*").collect():
        words, places, labels = plain(r["text"]), [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        base, found_here = sorted(labels), brute_notices(r["text"])
        labels, share = labels | set(found_here), max(found_here.values(), default=0.0)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert (r["base_labels"], r["labels"]) == (base, sorted(labels))
        assert r["score"] == (1.0 if places else pytest.approx(share))
    labelled, _ = licenses.label(edges)
    assert labelled.columns[:-1] == edges.columns and labelled.count() == edges.count()
    assert licenses.label(nothing)[0].count() == 0


def wrapped(text, at):
    """A notice as a comment of lines of ``at`` words."""
    words = text.split()
    return "\n".join(" * " + " ".join(words[i : i + at]) for i in range(0, len(words), at))


def brute_notices(text):
    words, found = plain(text), {}
    for notice, label in licenses.TEMPLATES.items():
        sequence = licenses.words_of_notice(notice)
        want, span = set(sequence), len(sequence) + len(sequence) // 4
        told = [f" {p} " for p in licenses.TELLING if f" {p} " in f" {' '.join(sequence)} "]
        for i in range(len(words)):
            run = words[i : i + span]
            have = len(want & set(run))
            if 100 * have >= 80 * len(want) and all(p in f" {' '.join(run)} " for p in told):
                found[label] = max(found.get(label, 0), have / len(want))
    return found


def test_wrapped_notices_against_brute_force(spark):
    texts = [f"/* Code of x.\n{wrapped(t, at)}\n */ int main" for t in licenses.TEMPLATES for at in (3, 8, 13)]
    split = len(texts)
    texts += [
        "Released under an MIT License", "released under mit\nlicense", "", "the\n" * 300, "x\n\n".join(licenses.TEMPLATES),
        "released " + "word " * 40 + "under the MIT License", "Licensed under the\r\n# Apache\r\n# License, Version 2.0",
    ]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    found, name = licenses.label(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3))
    got = {r["doc_id"]: r for r in found.select("doc_id", f"{name}.*").collect()}
    assert len(got) == len(texts)
    for n, text in enumerate(texts):
        want = brute_notices(text)
        assert got[n]["notice_labels"] == sorted(want), text[:200]
        assert got[n]["notice_score"] == pytest.approx(max(want.values(), default=0.0))
    whole = [label for label in licenses.TEMPLATES.values() for _ in range(3)]
    assert all(label in got[n]["notice_labels"] for n, label in zip(range(split), whole))


def test_labels_of_absent_documents_take_no_place(spark):
    labels = spark.createDataFrame([(n, n % 2) for n in range(3000)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(2900, 3000)], "doc_id bigint, text string")
    for limit, rows in ((60, 60), (500, 100)):
        sample = toxicity.sample_of(docs.union(docs.limit(5)), labels, limit, "doc_id", "text", "toxic")
        assert sample.count() == rows


def test_notices_are_told_apart(spark):
    gpl, other = "This work is licensed under the GNU General Public License, version", "Creative Commons Attribution"
    texts = {
        gpl + " 2": ["gpl-2.0"], gpl + " 3": ["gpl-3.0"], gpl + "\n3\n2 things": ["gpl-3.0"], f"{gpl} 2. {gpl} 3.": ["gpl-2.0", "gpl-3.0"],
        gpl + " 3 or the Apache License, Version 2.0": ["gpl-3.0"],
        "Licensed under CC BY-NC 4.0": ["cc-by-nc-4.0"], "Licensed under CC BY-SA 4.0": ["cc-by-sa-4.0"], "Licensed under CC BY-NC-SA 4.0": [],
        f"This work is licensed under a {other} 4.0 International License": ["cc-by-4.0"],
        f"This work is licensed under a {other}-ShareAlike 4.0 International License": [],
        "Released under the MIT License": ["mit"], "Released under the X License": [], "released " + "x " * 50 + "under MIT license": [],
    }
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found, name = licenses.label(docs)
    assert {r["text"]: r[name]["notice_labels"] for r in found.collect()} == texts


# decontamination


def brute_hits(text, items, window=13):
    words, hit, found = plain(text), set(), set()
    for name, item in items:
        own = plain(item)
        size = min(window, len(own))
        wins = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        at = [i for i in range(len(words) - size + 1) if tuple(words[i : i + size]) in wins] if size else []
        hit |= {p for i in at for p in range(i, i + size)}
        found |= {str(name)} if at else set()
    return len(words), hit, sorted(found)


@pytest.fixture(scope="module")
def contaminated(spark):
    items = [(1, text_of(0, 30)), (2, text_of(100, 13)), (3, "Short Item"), (4, None), (5, ""), (6, text_of(0, 30)), (7, text_of(200, 14)), (7, "other text")]
    texts = [
        text_of(0, 30), f"a {text_of(5, 12)} b", f"a {text_of(5, 13).upper()} b", f"{text_of(90, 40)}", "a short, item b", "short", None, "", text_of(300, 400) + " " + text_of(200, 13),
        text_of(0, 13) + " x " + text_of(17, 13), "other text and other text",
    ]
    return items, spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, texts[0]])], "doc_id bigint, text string, hits string"), \
        spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 100])
def test_hits(spark, contaminated, block):
    items, docs, benchmark = contaminated
    got = {r["doc_id"]: r for r in decontamination.verdicts(docs, benchmark, block_bytes=block).collect()}
    for r in docs.collect():
        words, hit, found = brute_hits(r["text"], items)
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["items"]) == (words, len(hit), found)
        assert g["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= words)


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 100])
def test_removal(spark, contaminated, block):
    items, docs, benchmark = contaminated
    whole = decontamination.decontaminate(docs, benchmark, block_bytes=block)
    assert whole.columns == docs.columns and sorted(r["doc_id"] for r in whole.collect()) == [1, 5, 6, 7, 8]
    cut = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, benchmark, "spans", block_bytes=block).collect()}
    assert cut[2] == "a  b" and cut[0] == "" and cut[4] == "a  b" and cut[6] is None and cut[1] == f"a {text_of(5, 12)} b"
    assert all(not brute_hits(x, items)[1] for x in cut.values())


def test_decontamination_edges(spark, edges, nothing, contaminated):
    benchmark = contaminated[2]
    assert decontamination.decontaminate(edges, benchmark).count() == edges.count()
    assert decontamination.decontaminate(edges, benchmark.limit(0)).columns == edges.columns
    assert decontamination.decontaminate(nothing, benchmark).count() == 0


# toxicity


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.train_on_open_rows(docs, labels)
    scored, name = toxicity.score(docs.select("doc_id", "text"), model)
    rows = scored.where(toxicity.held_out()).join(labels, "doc_id").select("toxic", name).toPandas()
    toxic = rows[rows.toxic == 1][name]
    clean = rows[rows.toxic == 0][name]
    order = np.concatenate([toxic, clean]).argsort().argsort()
    auc = (order[: len(toxic)].sum() - len(toxic) * (len(toxic) - 1) / 2) / (len(toxic) * len(clean))
    assert auc > 0.95 and (clean >= toxicity.THRESHOLD).mean() < 0.01 and (toxic >= toxicity.THRESHOLD).mean() > 0.75


def test_held_out_labels_are_not_learnt(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train_on_open_rows(docs, x) for x in (labels, flipped))
    assert np.array_equal(a.features, b.features) and np.allclose(a.weights, b.weights)


def test_sentences_are_located(spark):
    docs = [(i, f"Good day to all number {i % 7}. Nice {'vileword' if i % 3 == 0 else 'sunny'} thing here.\nThe end") for i in range(90)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, toxic int")
    model = toxicity.train(rows, labels)
    bad = toxicity.locate(rows, model).collect()
    assert {(r["doc_id"], r["sentence"]) for r in bad} == {(i, 1) for i in range(0, 90, 3)}
    assert all(r["words"].startswith("Nice vileword") for r in bad)
    scored, name = toxicity.score(rows, model)
    for r in scored.collect():  # the noisy-or of the sentences, worked out by hand
        words = toxicity.words_of(toxicity.pa.array([r["text"]]))
        p, _ = toxicity.sentence_scores(model, words)
        assert r[name] == pytest.approx(1 - (1 - model.leak) * np.prod(1 - p))


def test_toxicity_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (6, None), (77, 1)], "doc_id bigint, toxic int")
    for docs, marks in ((edges, labels), (edges, labels.limit(0)), (nothing, labels)):
        model = toxicity.train(docs, marks)
        scored, name = toxicity.score(docs, model)
        assert scored.columns[:-1] == docs.columns
        assert all(0 <= r[name] <= 1 for r in scored.collect())
        kept = toxicity.drop_toxic(docs, model)
        assert kept.columns == docs.columns
    assert toxicity.score(nothing, model)[0].count() == 0
