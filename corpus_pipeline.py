"""Corpus pipeline over ``documents``: stages that each take what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitgrid.llm import bpe, decontamination, minhash, quality, toxicity
from visitgrid.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the labels of held-out rows are not learnt from."""
    model = toxicity.train_on_open_rows(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a rule nor their host rejects."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is of benchmark passages."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document left; the last stage, so it returns them instead of documents."""
    return bpe.encode(docs, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("near duplicates", drop_copies),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", tokens),
]

#: A trained score, registers of a sketch and token merges have no SQL form;
#: tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
