"""Incremental intake of a folder: each new workbook is parsed once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import base_name
from ..operators.frames import measured
from ..operators.numbering import next_id_base
from ..plans import batch
from ..plans.mapping import MappingRules
from ..session import materialize
from ..sinks import writers
from ..sources.tables import TableStore
from ..sources.workbooks import FORMATS, scan_workbooks

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def folder_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files of a folder tree, lock files left out: ``source_path, content``."""
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .where(F.lower("path").rlike(r"\.(" + "|".join(FORMATS) + ")$"))
        .where(~base_name(F.col("path")).startswith("~$"))
        .select(F.col("path").alias("source_path"), "content")
    )


def follow_folder(
    spark: SparkSession, folder: str, target: str, checkpoint: str, sheets: Iterable[str] | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Scan the files that arrived since the last run and append their rows.

    ``availableNow`` works through the backlog in batches of bounded size and stops;
    the checkpoint keeps the list of files already taken.
    """
    return (
        scan_workbooks(folder_files(spark, folder, files_per_batch), sheets).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    )


@dataclass(frozen=True)
class Intake:
    """Extraction, visits, tables and audit of each arrival, below one root.

    Everything a micro-batch writes lies in folders of its number, and its ids start after
    the largest id of the batches before it.  So a batch that is taken again, after a
    failure between its writes and the commit of the stream, replaces its own rows with
    the same ones and nothing else.  Root and checkpoint belong together.
    """

    rules: MappingRules
    root: str

    def visits(self, spark: SparkSession) -> DataFrame | None:
        return TableStore(spark, self.root).find("visits")

    def id_base(self, spark: SparkSession, number: int) -> int:
        stored = self.visits(spark)
        return 0 if stored is None else next_id_base(stored.where(F.col("batch") < number), "QAID")

    def take(self, files: DataFrame, number: int) -> None:
        """One micro-batch of files (``source_path, content``)."""
        spark = files.sparkSession
        result = batch.extract(spark, files, self.rules)
        seen = materialize(batch.batch_visits(result, self.id_base(spark, number)), "arrived-visits")
        name = str(number)
        ids = measured(seen.select("workbook_id", F.col("QAID").alias("qaid")))  # else all rows were shuffled for them
        writers.write_tables({k: df.join(ids, "workbook_id") for k, df in result.tables.items()}, self.root, name)
        writers.write_parquet_table(batch.run_audit(result, seen, self.rules), self.root, "audit", name)
        writers.write_parquet_table(seen, self.root, "visits", name)  # last: what it lists is complete

    def follow(self, files: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take what arrived since the last run, in micro-batches, and stop."""
        return (
            files.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
