"""Visit statistics and processing summaries (all partially combined aggregates)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_visits(visits: DataFrame, key: str = "qaid", *columns: str) -> DataFrame:
    """Distinct visits, and of sites, systems ..., in one row."""
    return visits.agg(F.count_distinct(key).alias("total_visits"), *[F.count_distinct(c).alias(f"{c}_count") for c in columns])


def rows_by(visits: DataFrame, column: str) -> DataFrame:
    """Rows per site or system, largest first; null is no site."""
    counts = visits.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("visits"))
    return counts.orderBy(F.desc("visits"), column)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


_FACTS = (
    "total_sheets", "configured_sheets", "processed_sheets", "errors", "extracted_fields", "total_rows",
    "extracted_scalar_records", "extracted_named_results",
)


def extraction_stats(workbooks: DataFrame, fields: DataFrame, records: DataFrame, tables: DataFrame,
                     sheet_audit: DataFrame) -> DataFrame:
    """Counts of sheets, fields, tables, records, named results and errors per workbook."""

    def facts(df: DataFrame, **counts: Column) -> DataFrame:
        """Each input row as one row per named count."""
        items = F.array(*[
            F.struct(F.lit(name).alias("fact"), n.cast("bigint").alias("n")) for name, n in counts.items()
        ])
        table = F.concat_ws("\u0001", "sheet_id", "table_key") if "total_rows" in counts else F.lit(None).cast("string")
        return df.select("workbook_id", table.alias("table"), F.inline(items))

    one = F.lit(1)
    named = (F.col("kind") == "named_result").cast("int")
    done = (F.col("present") & ~F.col("skipped")).cast("int")
    parts = [
        facts(workbooks, total_sheets=F.size("sheets")),
        facts(sheet_audit, configured_sheets=one, processed_sheets=done, errors=F.size("errors")),
        facts(fields, extracted_fields=one),
        facts(tables, total_rows=one),
        facts(records, extracted_scalar_records=1 - named, extracted_named_results=named),
    ]
    # All counts in one aggregate over a union: one shuffle instead of a join per count.
    per_book = reduce(DataFrame.unionByName, parts).groupBy("workbook_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("fact") == name, F.col("n"))), F.lit(0)).alias(name) for name in _FACTS],
        F.count_distinct("table").alias("extracted_tables"),
    )
    return per_book.where("total_sheets > 0")


def result_summary(items: DataFrame) -> DataFrame:
    """Counts per workbook from a long item list (workbook_id, item, name)."""
    def distinct(kind: str) -> Column:
        return F.count_distinct(F.when(F.col("item") == kind, F.col("name")))

    return items.groupBy("workbook_id").agg(
        distinct("field").alias("fields_count"),
        distinct("table").alias("tables_count"),
        F.count_if(F.col("item") == "scalar_record").alias("scalar_records_count"),
        F.count_if(F.col("item") == "named_result").alias("named_results_count"),
        F.count_if(F.col("item") == "table").alias("total_rows"),
    )


def batch_completion(status: DataFrame, ok: Column) -> DataFrame:
    """Successes, total and rate as text with one decimal."""
    return status.agg(F.count_if(ok).alias("success_count"), F.count("*").alias("total_count")).select(
        "success_count", "total_count",
        F.concat(
            F.format_string("%.1f", percent(F.col("success_count"), F.col("total_count"))), F.lit("%")
        ).alias("success_rate"),
    )


def batch_summary(report: DataFrame) -> DataFrame:
    """Totals of a processing report."""
    return report.agg(
        F.count("*").alias("files_found"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.coalesce(F.col("status"), F.lit("")) != "success").alias("failed"),
        F.count_if(F.coalesce(F.col("QAMPR"), F.lit("")) == "").alias("missing_qampr"),
        F.count_if(~F.coalesce(F.col("parquet_export_ok"), F.lit(False))).alias("parquet_errors"),
        F.count_if(~F.coalesce(F.col("access_export_ok"), F.lit(False))).alias("text_errors"),
    )


def report_with_failures(report: DataFrame, failures: DataFrame) -> DataFrame:
    """Processing report with export flags and messages.

    ``failures`` holds (source_file, sink, message).  They are made distinct before
    they are listed, so a list holds at most one message per exported table and sink.
    """
    per_file = (
        failures.groupBy("source_file", "sink", "message").agg(F.lit(1).alias("_one"))
        .groupBy("source_file")
        .agg(
            F.max(F.col("sink") == "text").alias("_text"),
            F.max(F.col("sink") == "parquet").alias("_parquet"),
            F.array_sort(F.collect_list(F.struct(F.col("sink") == "parquet", "message"))).alias("_messages"),
        )
    )
    ok = F.col("status") == "success"

    def flag(name: str) -> Column:
        return ok & ~F.coalesce(F.col(name), F.lit(False))

    listed = F.transform("_messages", lambda m: m["message"])
    return report.join(per_file, "source_file", "left").select(
        *report.columns,
        flag("_text").alias("access_export_ok"),
        flag("_parquet").alias("parquet_export_ok"),
        F.concat_ws("; ", F.col("error"), listed).alias("error_message"),
    ).drop("error")
