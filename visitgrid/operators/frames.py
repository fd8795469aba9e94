"""Small driver-made rule tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A mapping holds a few hundred rules; a table of up to this many bytes is sent to every task.
MAX_RULE_BYTES = 32 << 20


def rule_frame(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """Rule rows as a local relation, marked for broadcast if it is small; a larger one is
    joined like any table."""
    fields = StructType.fromDDL(schema)
    table = pa.Table.from_pylist(
        [{f.name: row.get(f.name) for f in fields} for row in rows], schema=to_arrow_schema(fields)
    )
    frame = spark.createDataFrame(table, schema=fields)
    return F.broadcast(frame) if table.nbytes <= MAX_RULE_BYTES else frame


def measured(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its rows are found to be small in all."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= MAX_RULE_BYTES else df
