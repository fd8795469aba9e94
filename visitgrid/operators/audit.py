"""Audit events, made from status tables instead of a running log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import percent

EVENT_COLUMNS = (
    "timestamp", "level", "component", "event_type", "message", "file_name", "qaid", "duration_ms", "details",
)
DETAILS_TYPE = "map<string,string>"


def details_json(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})


def events(df: DataFrame, level: str, component: str, event_type: str, message: Column, details: Column,
           file_name: Column | None = None, qaid: Column | None = None, duration_ms: Column | None = None,
           timestamp: Column | None = None) -> DataFrame:
    """One event per row of ``df``."""
    return df.select(
        (timestamp if timestamp is not None else F.current_timestamp().cast("string")).alias("timestamp"),
        F.lit(level).alias("level"),
        F.lit(component).alias("component"),
        F.lit(event_type).alias("event_type"),
        message.alias("message"),
        F.coalesce(file_name if file_name is not None else F.lit(""), F.lit("")).alias("file_name"),
        (qaid if qaid is not None else F.lit(None)).cast("bigint").alias("qaid"),
        (duration_ms if duration_ms is not None else F.lit(None)).cast("bigint").alias("duration_ms"),
        details.alias("details"),
    )


def file_events(status: DataFrame, dry_run: bool = False, timestamp: Column | None = None) -> DataFrame:
    """Start and outcome events from (file_name, qaid, template_id, error).

    Each status row is laid out as its two events in one pass, without a union of
    two scans of the workbooks.
    """
    stamp = timestamp if timestamp is not None else F.current_timestamp().cast("string")

    def event(level, event_type, message, qaid, details) -> Column:
        return F.struct(
            stamp.alias("timestamp"), level.alias("level"), F.lit("Orchestrator").alias("component"),
            event_type.alias("event_type"), message.alias("message"),
            F.coalesce("file_name", F.lit("")).alias("file_name"), qaid.cast("bigint").alias("qaid"),
            F.lit(None).cast("bigint").alias("duration_ms"), details.alias("details"),
        )

    none = F.lit(None).cast("bigint")
    start = event(F.lit("INFO"), F.lit("ProcessingStart"), F.lit("Start processing file"), none,
                  details_json(file=F.col("file_name")))
    failed = F.col("error").isNotNull()
    good_level, good_type, good_text = (
        ("INFO", "DryRunComplete", "Dry-run validation successful") if dry_run
        else ("SUCCESS", "ProcessingComplete", "File processed successfully")
    )
    good_qaid = none if dry_run else F.col("qaid")
    good_details = (
        details_json(template_id=F.col("template_id")) if dry_run
        else details_json(qaid=F.col("qaid"), template_id=F.col("template_id"))
    )
    outcome = event(
        F.when(failed, "ERROR").otherwise(good_level),
        F.when(failed, "ProcessingFailed").otherwise(good_type),
        F.when(failed, F.concat(F.lit("Processing failed: "), F.col("error"))).otherwise(good_text),
        F.when(~failed, good_qaid),
        F.when(failed, details_json(error=F.col("error"))).otherwise(good_details),
    )
    return status.select(F.inline(F.array(start, outcome)))


def template_events(status: DataFrame, method: Column, timestamp: Column | None = None) -> DataFrame:
    message = F.concat(F.lit("Template "), F.col("template_id"), F.lit(" selected"))
    return events(status, "INFO", "TemplateSelector", "TemplateSelected", message, details_json(method=method),
                  F.col("file_name"), timestamp=timestamp)


def extraction_events(counts: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """From (file_name, n_fields, n_tables)."""
    message = F.concat(
        F.lit("Extracted "), F.col("n_fields").cast("string"), F.lit(" fields and "),
        F.col("n_tables").cast("string"), F.lit(" tables"),
    )
    return events(counts, "INFO", "ExtractionEngine", "ExtractionComplete", message,
                  details_json(fields=F.col("n_fields"), tables=F.col("n_tables")), F.col("file_name"),
                  timestamp=timestamp)


def resolution_events(visits: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Created and reference-lookup events of resolved visits."""
    created = events(
        visits, "INFO", "QAVisit", "Created",
        F.concat(F.lit("QAVisit "), F.col("qaid").cast("string"), F.lit(" created successfully")),
        details_json(qampr=F.col("qampr"), reference_qc=F.col("reference_qc"), template=F.col("template_id")),
        timestamp=timestamp,
    )
    resolved = F.col("resolution") == "ReferencesResolved"
    number = F.coalesce("qampr", F.lit("-"))
    message = F.when(resolved, "References resolved successfully").otherwise(
        F.concat(F.lit("No reference for device number "), number)
    )
    details = F.when(
        resolved, details_json(hospital_id=F.col("hospital_id"), system_id=F.col("system_id"))
    ).otherwise(details_json(qampr=F.col("qampr"), reference_qc=F.col("reference_qc")))
    looked_up = visits.select(
        (timestamp if timestamp is not None else F.current_timestamp().cast("string")).alias("timestamp"),
        F.when(resolved, "INFO").otherwise("WARNING").alias("level"),
        F.lit("QAVisit").alias("component"),
        F.col("resolution").alias("event_type"),
        message.alias("message"),
        F.lit("").alias("file_name"),
        F.col("qaid").cast("bigint").alias("qaid"),
        F.lit(None).cast("bigint").alias("duration_ms"),
        details.alias("details"),
    )
    return created.unionByName(looked_up)


def batch_event(completion: DataFrame, timestamp: Column | None = None) -> DataFrame:
    return events(completion, "INFO", "Orchestrator", "BatchComplete", F.lit("Batch processing completed"),
                  details_json(success_count=F.col("success_count"), total_count=F.col("total_count"),
                               success_rate=F.col("success_rate")), timestamp=timestamp)


def sheet_audit_rows(sheets: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per processed sheet and one summary row per workbook."""
    per_sheet = sheets.select(
        "workbook_id", F.lit("ExtractionEngine").alias("component"), F.lit("SheetProcessed").alias("event_type"),
        "sheet", "fields_extracted", "tables_extracted", F.size("errors").alias("errors"),
    )
    summary = stats.select(
        "workbook_id", F.lit("ExtractionEngine").alias("component"), F.lit("ExtractionSummary").alias("event_type"),
        "total_sheets", "processed_sheets", "extracted_fields", "extracted_tables",
    )
    return per_sheet.unionByName(summary, allowMissingColumns=True)


def metrics(log: DataFrame) -> DataFrame:
    """Totals by level and the success rate, in one row."""
    def of_type(name: str) -> Column:
        return F.count_if(F.col("event_type") == name)

    def of_level(name: str) -> Column:
        return F.count_if(F.col("level") == name)

    return log.agg(
        of_type("ProcessingStart").alias("files_processed"),
        of_type("ProcessingComplete").alias("successful_files"),
        of_type("ProcessingFailed").alias("failed_files"),
        F.count("*").alias("total_events"),
        of_level("ERROR").alias("error_events"),
        of_level("WARNING").alias("warning_events"),
        of_level("SUCCESS").alias("success_events"),
    ).withColumn("success_rate", percent(F.col("successful_files"), F.col("files_processed")))


def metric_rows(totals: DataFrame) -> DataFrame:
    """One row per metric: (metric, value as text)."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("string").alias("value")) for name in totals.columns
    ]
    return totals.select(F.inline(F.array(*pairs)))


REPORT_LINES = (
    ("Files Processed", "files_processed"),
    ("Successful", "successful_files"),
    ("Failed", "failed_files"),
    ("Success Rate", "success_rate"),
    ("Total Events", "total_events"),
)


def report_text(totals: DataFrame, style: str = "text") -> DataFrame:
    """Report document in one ``value`` column: plain text or HTML."""
    def shown(name: str) -> Column:
        if name == "success_rate":
            return F.concat(F.format_string("%.1f", F.col(name)), F.lit("%"))
        return F.col(name).cast("string")

    if style == "html":
        items = [F.concat(F.lit(f"<li>{label}: "), shown(name), F.lit("</li>")) for label, name in REPORT_LINES[:4]]
        body = F.concat(F.lit("<ul>"), *items, F.lit("</ul>"))
        page = F.concat(
            F.lit("<html><head><title>Audit Report</title></head><body><h1>Audit Report</h1><h2>Summary</h2>"),
            body, F.lit("</body></html>"),
        )
        return totals.select(page.alias("value"))
    lines = [F.concat(F.lit(f"{label}: "), shown(name)) for label, name in REPORT_LINES]
    return totals.select(F.concat_ws("\n", F.lit("AUDIT REPORT"), F.lit("SUMMARY"), *lines).alias("value"))


def visit_events(log: DataFrame, qaid: int | None = None) -> DataFrame:
    """Events of one visit, or of all visits (events without a visit are left out)."""
    return log.where(F.col("qaid").isNotNull() if qaid is None else F.col("qaid") == qaid)


def by_date(log: DataFrame) -> DataFrame:
    """Log with the event date used as partition column."""
    return log.withColumn("date", F.substring("timestamp", 1, 10))


def parsed_details(log: DataFrame) -> DataFrame:
    return log.withColumn("details", F.from_json("details", DETAILS_TYPE))
