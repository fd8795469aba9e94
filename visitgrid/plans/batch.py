"""The batch job: a folder of workbooks to tables, visits, reports and audit."""

from __future__ import annotations

import functools
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import batch_device_number, derive_device_number, hospital_id, system_id
from ..operators import audit, records, stats, tables, visits
from ..operators.frames import rule_frame
from ..operators.numbering import visit_ids
from ..operators.scalars import missing_required, scalar_records
from ..session import materialize
from ..sinks import writers
from ..sources import workbooks as wb
from .mapping import MappingRules


@dataclass
class Extraction:
    """Result of one batch; every table holds the rows of all workbooks."""

    workbooks: DataFrame
    cells: DataFrame
    records: DataFrame
    fields: DataFrame
    table_rows: DataFrame
    sheet_errors: DataFrame
    tables: dict[str, DataFrame]
    sheet_audit: DataFrame

    @property
    def named_results(self) -> DataFrame:
        return self.records.where(F.col("kind") == "named_result")

    @property
    def scalars(self) -> DataFrame:
        return self.records.where(F.col("kind") != "named_result")


def sheet_audit(books: DataFrame, rules: MappingRules, recs: DataFrame, rows: DataFrame, broken: DataFrame) -> DataFrame:
    """Per (workbook, configured sheet): counts, errors, warnings, skipped flag."""
    configured = F.array(*[
        F.struct(
            F.lit(s["seq"]).alias("seq"), F.lit(s["sheet_id"]).alias("sheet_id"), F.lit(s["sheet_name"]).alias("sheet"),
            F.lit(s["extract"]).alias("extract"), F.lit(s["required"]).alias("required"),
        )
        for s in rules.sheets
    ])
    grid = books.where("error is null").select("workbook_id", "sheets", F.inline(configured)).select(
        "workbook_id", "seq", "sheet_id", "sheet", "extract", "required",
        F.array_contains("sheets", F.col("sheet")).alias("present"),
    )
    by_sheet = recs.groupBy("workbook_id", "sheet_id").agg(
        F.count_if(F.col("kind").isin("field", "named_result")).alias("fields_extracted"),
        F.count_if(F.col("kind") != "named_result").alias("scalar_records"),
        F.count_if(F.col("kind") == "named_result").alias("named_results"),
    )
    lacking = missing_required(recs).groupBy("workbook_id", "sheet_id").agg(
        F.array_sort(F.collect_set("error")).alias("_lacking")
    )
    filled = rows.groupBy("workbook_id", "sheet_id").agg(F.count_distinct("table_key").alias("tables_extracted"))
    out = grid
    for part in (by_sheet, lacking, filled):
        out = out.join(part, ["workbook_id", "sheet_id"], "left")
    out = out.join(broken.withColumnRenamed("error", "_broken"), ["workbook_id", "sheet"], "left")
    none = F.array().cast("array<string>")
    absent = F.array(F.concat(F.lit("configured sheet missing: "), F.col("sheet")))
    gone = F.col("extract") & ~F.col("present")
    return out.select(
        "workbook_id", "seq", "sheet_id", "sheet", "present",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c)
          for c in ("fields_extracted", "tables_extracted", "scalar_records", "named_results")],
        F.when(gone & F.col("required"), absent).otherwise(
            F.concat(F.coalesce("_lacking", none), F.array_compact(F.array("_broken")))
        ).alias("errors"),
        F.when(gone & ~F.col("required"), absent).otherwise(none).alias("warnings"),
        (~F.col("extract")).alias("skipped"),
    )


def extract(spark: SparkSession, files: DataFrame, rules: MappingRules) -> Extraction:
    """Files to typed results.

    The scan is written once to the shared folder; all that follows reads it from
    there, so workbooks are parsed once and a lost executor costs no second parse.
    """
    used = [s["sheet_name"] for s in rules.sheets if s["extract"]]
    active = {s["sheet_id"] for s in rules.sheets if s["extract"]}
    named = any(r["how"] == "name" for r in rules.scalars)
    scan = materialize(wb.scan_workbooks(files, None if named else used, by_row=True), "scan")
    books = wb.workbooks(scan)
    grid = wb.cells(scan)
    scalar_rules = [r for r in rules.scalars if r["sheet_id"] in active]
    table_rules = [t for t in rules.tables if t["sheet_id"] in active]
    inject = {s["sheet_id"]: s["inject"] for s in rules.sheets if s["inject"]}
    recs = materialize(
        scalar_records(books, grid, scalar_rules, wb.defined_names(scan), inject), "records"
    ) if scalar_rules else spark.createDataFrame(
        [], "workbook_id string, seq int, sheet_id string, sheet_name string, section_id string, db_table string, "
            "name string, kind string, dtype string, row int, col string, value string, required boolean")
    plain = [t for t in table_rules if t["stop"] != "range"]
    slots = materialize(tables.table_records(wb.rows(scan), plain, scalar_rules), "tables", "table_id") if plain else None
    found = tables.all_tables(grid, slots, table_rules, scalar_rules, rules.sheets, recs)
    rows = _table_rows(spark, grid, slots, table_rules)
    fields = records.field_names(recs)
    broken = wb.sheet_errors(scan)
    return Extraction(books, grid, recs, fields, rows, broken, found, sheet_audit(books, rules, recs, rows, broken))


def _table_rows(spark: SparkSession, grid: DataFrame, slots: DataFrame | None, table_rules: list[dict]) -> DataFrame:
    """Which table each row belongs to: one read of the records, whatever the number of
    tables, beside the rules (broadcast, checked in size)."""
    schema = "workbook_id string, row int, sheet_id string, table_key string"
    parts = []
    if slots is not None:
        names = rule_frame(spark, [{k: t[k] for k in ("table_id", "sheet_id", "table_key")} for t in table_rules if t["stop"] != "range"],
                           "table_id int, sheet_id string, table_key string")
        parts.append(slots.select("workbook_id", "row", "table_id").join(names, "table_id").select("workbook_id", "row", "sheet_id", "table_key"))
    for t in table_rules:
        if t["stop"] == "range":
            parts.append(tables.header_range(grid, t).select(
                "workbook_id", "row", F.lit(t["sheet_id"]).alias("sheet_id"), F.lit(t["table_key"]).alias("table_key")))
    return functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def batch_visits(result: Extraction, base: int = 0) -> DataFrame:
    """One visit per file, ids in path order after ``base``; a failed file keeps its row
    with zero counts."""
    ids = visit_ids(result.workbooks, "source_path", "QAID", base)
    maps = records.fields_map(result.fields)
    n_tables = result.table_rows.groupBy("workbook_id").agg(F.count_distinct("table_key").alias("n_tables"))
    n_named = result.named_results.groupBy("workbook_id").agg(F.count("*").alias("n_named_results"))
    out = ids.join(maps, "workbook_id", "left").join(n_tables, "workbook_id", "left").join(n_named, "workbook_id", "left")
    fields = F.coalesce("fields", F.create_map().cast("map<string,string>"))

    def get(names):
        return [F.try_element_at(fields, F.lit(n)) for n in names]

    return out.select(
        "workbook_id", "QAID",
        batch_device_number(get(visits.REFERENCE_FIELDS), F.col("source_path")).alias("QAMPR"),
        F.col("source_path").alias("source_file"),
        hospital_id(F.col("source_path"), *get(visits.HOSPITAL_FIELDS)).alias("hospital_id"),
        system_id(F.col("source_path"), *get(visits.SYSTEM_FIELDS)).alias("system_id"),
        F.when(F.col("error").isNull(), "success").otherwise("failed").alias("extraction_status"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_fields", "n_tables", "n_named_results")],
        "error",
    )


def run_stamp() -> str:
    """Time of a run as text, taken once by the driver."""
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S")


def full_visits(result: Extraction, rules: MappingRules, linktable: DataFrame, systems: DataFrame, order: str,
                base: int = 0, default_type: str | None = None, stamp: str | None = None) -> DataFrame:
    """Visits with all attributes and resolved references, written once: all sinks see
    the same ids and the one stamp of the run."""
    good = result.workbooks.where("error is null")
    rows = visit_ids(good, "source_path", "qaid", base).join(
        records.fields_map(result.fields), "workbook_id", "left"
    )
    fields = F.coalesce("fields", F.create_map().cast("map<string,string>"))
    own = visits.visit_attributes(fields, default_type)
    stamp = F.lit(stamp or run_stamp())
    rows = rows.select(
        "workbook_id", "qaid",
        derive_device_number(
            *[F.try_element_at(fields, F.lit(n)) for n in visits.NUMBER_FIELDS], F.col("source_filename")
        ).alias("qampr"),
        visits.field_value(fields, visits.REFERENCE_FIELDS).alias("reference_qc"),
        *[c.alias(n) for n, c in own.items()],
        F.col("source_filename").alias("excel_file_name"),
        F.lit(rules.template_id).alias("template_id"),
        F.lit(rules.version).alias("sidecar_version"),
        "workbook_hash",
        stamp.alias("date_to_db"), stamp.alias("processing_timestamp"),
        F.lit("template").alias("extraction_method"),
    )
    return materialize(visits.resolve_references(rows, linktable, systems, order), "visits")


def run_batch(spark: SparkSession, folder: str, rules: MappingRules, text_root: str, parquet_root: str,
              report_path: str) -> DataFrame:
    """Folder of workbooks -> text and Parquet exports, processing report; gives the report."""
    result = extract(spark, wb.workbook_files(spark, folder, ("xlsm",), skip_locks=True), rules)
    seen = materialize(batch_visits(result), "visits")
    traced = {
        name: visits.add_batch_trace(df.drop("row", "sheet_id"), seen).drop("workbook_id")
        for name, df in result.tables.items()
    }
    errors = writers.write_batch(traced, seen, text_root, parquet_root)
    failures = spark.createDataFrame([], "source_file string, sink string, message string")
    for key, message in errors.items():
        sink, _, name = key.partition(":")
        hit = seen if name == "QAVisit" else result.table_rows.where(F.col("table_key") == name).select(
            "workbook_id").distinct().join(seen, "workbook_id")
        failures = failures.unionByName(hit.select("source_file", F.lit(sink).alias("sink"), F.lit(message).alias("message")))
    report = stats.report_with_failures(
        seen.select("source_file", F.col("extraction_status").alias("status"), "QAID", "QAMPR", "hospital_id",
                    "system_id", "n_fields", "n_tables", "n_named_results", "error"),
        failures,
    )
    writers.write_report(report, report_path)
    return report


def run_audit(result: Extraction, seen: DataFrame, rules: MappingRules) -> DataFrame:
    """Audit log of a batch: start and outcome per file, extraction counts, batch end."""
    status = seen.select(
        F.element_at(F.split("source_file", "/"), -1).alias("file_name"), F.col("QAID").alias("qaid"),
        F.lit(rules.template_id).alias("template_id"), "error", "n_fields", "n_tables",
    )
    done = stats.batch_completion(status, F.col("error").isNull())
    log = audit.file_events(status)
    log = log.unionByName(audit.extraction_events(status.where("error is null")))
    return materialize(log.unionByName(audit.batch_event(done)), "audit")
