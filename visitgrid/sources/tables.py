"""Reference tables, stored tables and archives."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.audit import parsed_details
from ..operators.typing import with_inferred_types
from ..operators.visits import merged_reference, resolve_references


def read_text_table(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None, order: str | None = None) -> DataFrame:
    """Quoted text table with a header; quotes inside values are doubled.

    ``order`` names a column for the place of a row: file, block of the file, and a
    number that grows with the rows of a block.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    rows = reader.schema(schema).csv(path) if schema else reader.csv(path)
    if order is None:
        return rows
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", place.alias(order))


def reference_files(spark: SparkSession, folder: str, suffix: str = ".txt") -> dict[str, str]:
    """Table name -> path of the text tables in a folder (a bounded, configured set).

    A table is a file, or a folder of part files as Spark writes them.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    tables = listing.select(F.regexp_extract("path", rf"^(.*/[^/]+{re.escape(suffix)})(/part-[^/]*)?$", 1).alias("path")).where("path <> ''").distinct()
    return {r["path"].rsplit("/", 1)[-1][: -len(suffix)]: r["path"] for r in tables.collect()}


def read_reference_tables(spark: SparkSession, folder: str, typed: bool = True, order: str | None = None) -> dict[str, DataFrame]:
    """All reference tables of a folder, typed by their content when asked, with a column
    for the load order when asked."""
    tables = {name: read_text_table(spark, path, order=order) for name, path in reference_files(spark, folder).items()}
    return {name: with_inferred_types(df) if typed else df for name, df in tables.items()}


def resolve_from_folder(visits: DataFrame, folder: str, link: str = "Linktable", systems: str = "System") -> DataFrame:
    """Hospital, system and system info of visits from a folder of reference tables; of
    rows with one device number the first in file order wins."""
    found = read_reference_tables(visits.sparkSession, folder, order="load_order")
    return resolve_references(visits, found[link], found[systems], "load_order")


def read_dataset(spark: SparkSession, root: str) -> DataFrame:
    """Partitioned Parquet folder; files may differ in their columns."""
    return spark.read.option("mergeSchema", True).parquet(root)


class TableStore:
    """Named Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def find(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", True).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # anything else is a table that cannot be read
                return None
            raise

    def __contains__(self, name: str) -> bool:
        return self.find(name) is not None

    def get(self, name: str, schema: str = "") -> DataFrame:
        """The table, or an empty one of the given schema."""
        found = self.find(name)
        return self.spark.createDataFrame([], schema or "_none string") if found is None else found

    def put(self, name: str, df: DataFrame) -> None:
        """Replace a table.  ``df`` must not read from the table it replaces."""
        df.write.mode("overwrite").parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))

    def create(self, name: str, schema: str) -> None:
        """New empty table; an existing one is left alone."""
        if name not in self:
            self.put(name, self.spark.createDataFrame([], schema))

    def select(self, name: str, condition: str) -> DataFrame:
        """Rows of a table that meet an SQL condition (pushed down to the scan)."""
        return self.get(name).where(condition)

    def load_reference(self, name: str, incoming: DataFrame, key: str = "ID") -> None:
        """Incremental load: unknown ids are appended, a table without ids is replaced."""
        stored = self.find(name)
        if stored is not None and key in stored.columns and key in incoming.columns:
            self.append(name, incoming.join(stored.select(key).distinct(), key, "left_anti").select(*incoming.columns))
        else:
            self.put(name, merged_reference(incoming, None, key))

    def names(self) -> list[str]:
        """Table names, from the listing of the data files (contents are not read)."""
        files = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(self.root).select("path")
        )
        below = F.element_at(F.split("path", re.escape(self.root.split("://")[-1].lstrip("/") + "/")), -1)
        found = files.select(F.split(below, "/")[0].alias("name")).distinct().collect()
        return sorted(r["name"] for r in found)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.get(name) for name in self.names()}


def read_audit(store: TableStore, name: str = "AuditTrail") -> DataFrame:
    """Stored audit log with its details as a map."""
    return parsed_details(store.get(name))


def read_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Archived visits: chunk rows back to one row per archived record."""
    chunks = spark.read.schema(f"workbook_id string, section string, chunk bigint, rows array<struct<{schema}>>").json(path)
    return chunks.select("workbook_id", "section", F.inline("rows"))
