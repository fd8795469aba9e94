"""Given tables, and the sheets that are made from them.

``line_cells``: one workbook per order, sheet ``LI``, the line number is the row.
  Lines of one (order, number) are combined by an aggregate, so a row exists once
  and a sheet has at most as many rows as there are line numbers.
  A quantity, B price, C discount, D return flag (blank for N), E status, F ship day.
``event_cells``: one workbook per 200 event ids, sheet ``EV``, rows 1..200; copies of
  an event are one row.
  A type, B value (blank for errors), C user, D day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_PER_BOOK = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_form(df: DataFrame, values: list[tuple[int, str, Column]]) -> DataFrame:
    items = F.array(*[
        F.struct(F.lit(col).alias("col"), F.lit(ctype).alias("ctype"), raw.alias("raw")) for col, ctype, raw in values
    ])
    return df.select("workbook_id", "sheet", "row", F.inline(items)).where("raw is not null")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined lines.  Flags are single letters; their codes keep the aggregate a
    hash aggregate, which text buffers would turn into a sort of all lines."""
    return combined_lines(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def combined_lines(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(
        F.sum("l_quantity").alias("a"),
        F.max("l_extendedprice").alias("b"),
        F.min("l_discount").alias("c"),
        F.max(F.ascii("l_returnflag")).alias("d"),
        F.min(F.ascii("l_linestatus")).alias("e"),
        F.min("l_shipdate").cast("date").alias("f"),
    ).withColumns({"d": F.char("d"), "e": F.char("e")})


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rows(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("workbook_id"), F.lit("LI").alias("sheet"),
        F.col("l_linenumber").cast("int").alias("row"), "a", "b", "c", "d", "e", "f",
    )
    return long_form(rows, [
        (1, "float", F.col("a").cast("string")),
        (2, "float", F.col("b").cast("string")),
        (3, "float", F.col("c").cast("string")),
        (4, "text", F.when(F.col("d") != "N", F.col("d"))),
        (5, "text", F.col("e")),
        (6, "text", F.col("f").cast("string")),
    ])


LINES_SQL = """li AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS workbook_id, CAST(l_linenumber AS INTEGER) AS r, sum(l_quantity) AS a,
         max(l_extendedprice) AS b, min(l_discount) AS c, nullif(max(l_returnflag), 'N') AS d,
         min(l_linestatus) AS e, strftime(min(l_shipdate), '%Y-%m-%d') AS f
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.floor(F.col("event_id") / EVENTS_PER_BOOK).cast("string").alias("workbook_id"),
        F.lit("EV").alias("sheet"),
        (F.pmod("event_id", F.lit(EVENTS_PER_BOOK)) + 1).cast("int").alias("row"),
        "event_type", "value", "user_id", F.col("ts").cast("date").alias("day"),
    ).distinct()
    return long_form(rows, [
        (1, "text", F.col("event_type")),
        (2, "float", F.when(F.col("event_type") != "error", F.col("value").cast("string"))),
        (3, "int", F.col("user_id").cast("string")),
        (4, "text", F.col("day").cast("string")),
    ])


EVENTS_SQL = """ev AS (
  SELECT DISTINCT CAST(event_id // 200 AS VARCHAR) AS workbook_id, CAST(event_id % 200 + 1 AS INTEGER) AS r,
         event_type AS a, CASE WHEN event_type <> 'error' THEN value END AS b, user_id AS c,
         strftime(ts, '%Y-%m-%d') AS d
  FROM events)"""


def books_of(cells: DataFrame) -> DataFrame:
    """Workbooks of a cell table with their sheet lists (a handful of names each)."""
    return cells.groupBy("workbook_id").agg(F.array_sort(F.collect_set("sheet")).alias("sheets"))


def mapping(sheet: str, section: dict, sheet_settings: dict | None = None, section_id: str = "block") -> dict:
    """Mapping document with one sheet and one section."""
    return {
        "workbook": {"version": "1"},
        "sheets": {"s1": {"sheet_name": sheet, **(sheet_settings or {}), "sections": {section_id: section}}},
    }
