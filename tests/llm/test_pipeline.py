"""The pipeline's rows against plain Python over the same documents."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from visitgrid.llm import bpe, toxicity

from ..conftest import SMALL
from .test_copies import brute_classes
from .test_filters import brute_hits, brute_measures

FOLDER = SMALL.replace("0.001", "0.01")


def brute_score(model, text):
    """Noisy-or over sentences, one sentence at a time."""
    known = dict(zip(model.features.tolist(), model.weights.tolist()))
    keep = 1 - model.leak
    for sentence in "".join("\n" if c in ".!?\n" else c for c in text or "").split("\n"):
        words = toxicity.words_of(pa.array([sentence]))
        if len(words.starts):
            features = set(toxicity.features_of(words)[0].tolist())
            keep *= 1 - 1 / (1 + math.exp(-model.bias - sum(known.get(f, 0) for f in features)))
    return 1 - keep


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with extra columns of clashing names, nulls and repeated rows."""
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 400")
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    fill = " ".join(f"w{i}" for i in range(60))
    more = [(None, None, "en", "src0", 0), (9001, None, "en", "src1", 0), (9002, "", "en", None, 0), (9003, f"{fill} {item}", "en", "src1", 1), (9003, f"{fill} {item}", "en", "src1", 1),
            (9004, f"{fill} clean", "en", "src2", 1), (9004, f"{fill} clean", "en", "src2", 1), (9005, f"{fill} clean now", "en", "src2", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema)).selectExpr("*", "1 AS score", "'x' AS kept", "2 AS row", "3 AS n_words")
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pipeline_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    model = toxicity.train_on_open_rows(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in rows if brute_score(model, r[1]) < toxicity.THRESHOLD]

    def passes(text):
        n, _, _, _, repeated = brute_measures(text)
        return n >= 50 and (repeated is None or 100 * repeated <= 50 * n)

    long = [r for r in rows if brute_measures(r[1])[4] is None]
    assert len(long) < 5
    rows = [r for r in rows if passes(r[1])]
    named = brute_classes(dict(enumerate(t for _, t in rows)))
    first = {}
    for n, (key, _) in enumerate(rows):
        first.setdefault(named[n], []).append((key is None, key or 0, n))
    rows = [rows[min(members)[2]] for members in first.values()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = {n: brute_hits(t, items) for n, (_, t) in enumerate(rows)}
    rows = [r for n, r in enumerate(rows) if not (hits[n][1] and 20 * len(hits[n][1]) >= hits[n][0])]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
    want = sorted((k, hashlib.sha256(np.array(library.encode_ordinary(t), "<u4").tobytes()).hexdigest()) for k, t in rows)
    got = corpus_pipeline.run(spark, folder).select("doc_id", "ids_sha256").collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in got if r["doc_id"] not in {k for k, _ in long}) == [x for x in want if x[0] not in {k for k, _ in long}]
    assert 9004 in {r["doc_id"] for r in got} and not {9001, 9002, 9003, 9005} & {r["doc_id"] for r in got}


def test_stages_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
