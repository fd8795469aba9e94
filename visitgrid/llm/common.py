"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import materialize, scratch_path  # noqa: F401

#: Text bytes and rows handled by one numpy step; a single longer text is a step of its own.
STEP_BYTES, STEP_ROWS = 2 << 20, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the frame does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def steps(batches: Iterator[pa.RecordBatch], column: int | str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has few rows and the text column about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = min(max(at + 1, int(np.searchsorted(sizes, done + limit, side="right"))), at + STEP_ROWS)
            yield batch.slice(at, end - at)
            at = end


def texts_of(batch: pa.RecordBatch, column: int | str) -> list[str]:
    """Texts of a column, empty for null."""
    return [x or "" for x in batch.column(column).to_pylist()]


def open_store(path: str):
    """File system and path in it; a path without a scheme is a local one."""
    from pyarrow import fs

    if "://" not in path:
        return (fs.LocalFileSystem(), path.removeprefix("file:"))
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{rest}")
