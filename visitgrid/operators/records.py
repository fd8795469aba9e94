"""Long scalar records to fields, wide rows and per-table rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import suffix_repeats
from ..session import materialize
from .frames import MAX_RULE_BYTES

# Record kinds that fill a table of single values.
ROW_KINDS = ("field", "result_scalar")


def pivot_last(df: DataFrame, keys: Sequence[str], names: Sequence[str], order: str = "seq",
               context: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last value of each name and the first non-null context.

    Names are given, so no extra job looks for them; every aggregate combines
    before the shuffle.
    """
    def last(name: str) -> Column:
        return F.max_by("value", F.when(F.col("name") == name, F.col(order)))

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col(order)))

    return df.groupBy(*keys).agg(
        *[last(n).alias(n) for n in names], *[first(c).alias(c) for c in context]
    )


#: A task sorts its records by table; 196,000 of them were seen to take 286 MB.
RECORDS_PER_TASK = 250_000


def single_value_rows(
    records: DataFrame, names: Sequence[str], filled_tables: DataFrame | None = None, context: Sequence[str] = ()
) -> DataFrame:
    """Wide row per (workbook, db_table, sheet, section) for tables made of scalars.

    Tables of a workbook that already have rows are left out.  The number
    of tasks follows from the number of records, so the memory of one does not grow with
    the input; ``records`` are counted for that, and should be written before.
    """
    rows = records.where(
        F.col("kind").isin(*ROW_KINDS) & F.col("db_table").isNotNull() & (F.trim("db_table") != "")
    )
    table = ["workbook_id", "db_table"]
    filled = None if filled_tables is None else filled_tables.select(*table)
    tasks = -(-rows.count() // RECORDS_PER_TASK)
    if tasks > 1:  # a given number is not coalesced; both sides have it, so the join and the aggregate keep it
        tasks = max(tasks, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartition(tasks, *table)
        filled = None if filled is None else filled.repartition(tasks, *table)
    if filled is not None:
        # marked and filtered: an anti join would be moved below the shuffle, back to tasks of any size
        rows = rows.join(filled.distinct().withColumn("_filled", F.lit(True)), table, "left").where(F.col("_filled").isNull()).drop("_filled")
    keys = ["workbook_id", "db_table", "sheet_id", "sheet_name", "section_id"]
    wide = pivot_last(rows, keys, names, context=context)
    return wide.withColumnsRenamed(
        {"sheet_id": "source_sheet_id", "sheet_name": "source_sheet_name", "section_id": "source_section_id"}
    )


def single_value_maps(records: DataFrame, filled_tables: DataFrame, context: Sequence[str] = ()) -> DataFrame:
    """All tables made of scalars in one aggregate: a row per (workbook, db_table, sheet,
    section) with its ``values`` (last of each name) and the first context values.

    Tables of a workbook that already have rows are left out.  A map holds the names of
    one section, as many as the mapping has.
    """
    keys = ["workbook_id", "db_table", "sheet_id", "sheet_name", "section_id"]
    rows = records.where(F.col("kind").isin(*ROW_KINDS) & F.col("db_table").isNotNull() & (F.trim("db_table") != ""))
    rows = rows.join(filled_tables.select("workbook_id", "db_table").distinct(), ["workbook_id", "db_table"], "left_anti")
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c)))).alias(c) for c in context]
    named = rows.groupBy(*keys, "name").agg(F.max_by("value", "seq").alias("_value"), *first)
    wide = named.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "_value"))).alias("values"), *[F.min(c).alias(c) for c in context])
    return wide.select(*keys, "values", *[F.col(c)[c].alias(c) for c in context])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Field lists with their names, repeats suffixed in each sheet, then in the list."""
    for batch in batches:
        names = []
        for fields in batch.column("fields").to_pylist():
            sheets: dict[str, list[str]] = {}
            for field in fields:  # in reading order, so a sheet stands where its first field does
                sheets.setdefault(field["sheet_id"], []).append(field["name"])
            places = [(sheet, n) for sheet, own in sheets.items() for n in range(len(own))]
            given = dict(zip(places, suffix_repeats(name for own in sheets.values() for name in suffix_repeats(own))))
            seen: Counter[str] = Counter()
            names.append([])
            for field in fields:
                names[-1].append(given[field["sheet_id"], seen[field["sheet_id"]]])
                seen[field["sheet_id"]] += 1
        yield pa.RecordBatch.from_arrays([batch.column("fields_id"), pa.array(names, pa.list_(pa.string()))], names=["fields_id", "names"])


def field_names(records: DataFrame) -> DataFrame:
    """Field name and value per record, repeats suffixed first in a sheet, then in
    the workbook.

    Which names a workbook has follows from the fields that are present, and most
    workbooks have the same ones: names are worked out once for each list of fields.  A
    workbook has as many fields as its mapping has rules, so its list is small.
    """
    own = records.where(F.col("kind").isin("field", "named_result")).withColumn(
        "_name",
        F.when(F.col("kind") == "named_result", F.concat("section_id", F.lit("."), "name")).otherwise(F.col("name")),
    )
    books = own.groupBy("workbook_id").agg(F.array_sort(F.collect_list(F.struct("seq", "sheet_id", F.col("_name").alias("name"), "value"))).alias("items"))
    fields = F.transform("items", lambda x: F.struct(x["sheet_id"].alias("sheet_id"), x["name"].alias("name")))
    books = materialize(books.withColumn("fields", fields).withColumn("fields_id", F.sha2(F.to_json("fields"), 256)), "field-lists")
    lists = books.groupBy("fields_id").agg(F.any_value("fields").alias("fields"))
    named = materialize(lists.mapInArrow(_named, "fields_id string, names array<string>"), "field-names")
    size = named.agg(F.sum(F.octet_length(F.to_json("names")))).first()[0] or 0
    if size <= MAX_RULE_BYTES:  # a shuffle would bring all workbooks of the usual list to one task
        named = F.broadcast(named)
    pairs = F.arrays_zip(F.col("names").alias("name"), F.transform("items", lambda x: x["value"]).alias("value"),
                         F.transform("items", lambda x: x["seq"]).alias("seq"))
    return books.join(named, "fields_id").select("workbook_id", F.inline(pairs))


def fields_map(fields: DataFrame) -> DataFrame:
    """One map of fields per workbook (its size is bounded by the mapping)."""
    return fields.groupBy("workbook_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("fields"),
        F.count("*").alias("n_fields"),
    )


def named_fields(fields: DataFrame, words: Sequence[str]) -> DataFrame:
    """Fields whose name holds one of the words (used where no table is present)."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.lower("name").contains(word)
    return fields.where(hit)
