"""Parquet, quoted text, JSON and report writers.

Every writer writes the rows of a whole batch at once: two visits of one site in
one year add rows to the same partition instead of replacing each other.

With a batch name, a dataset has a folder per batch (a partition column ``batch`` for
readers).  A second run of the same batch replaces its folder and no other, so a re-run
doubles nothing.  The exports of a run name its batch after its files; without a name
rows are appended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import visit_year
from ..functions.names import standardized, table_file_name, table_stems
from ..operators import audit, routing
from ..operators.typing import none_number_to_null, prepare_export
from ..sources.tables import TableStore

# Columns of the visit tables and their export names.
VISIT_COLUMNS = (
    "qaid", "qampr", "reference_qc", "type", "date_test", "hospital_id", "system_id", "system_info_id",
    "excel_file_name", "source_file", "template_id", "sidecar_version", "workbook_hash", "qa_member1",
    "qa_member2", "processing_timestamp", "extraction_method",
)
VISIT_TEXT_COLUMNS = {
    "ID": "qaid", "Qampr": "qampr", "Reference_QC": "reference_qc", "Type": "type", "Date_Test": "date_test",
    "Hospital_ID": "hospital_id", "System_ID": "system_id", "System_Info_ID": "system_info_id",
    "Excel_File_Name": "excel_file_name", "QA_Member1": "qa_member1", "QA_Member2": "qa_member2",
    "Date_To_DB": "date_to_db", "Template_ID": "template_id", "Workbook_Hash": "workbook_hash",
}
EXTRACTION_TEXT_COLUMNS = {
    "QAID": "qaid", "Template_ID": "template_id", "Sidecar_Version": "sidecar_version",
    "Workbook_Hash": "workbook_hash", "Extraction_Method": "extraction_method",
    "Processing_Timestamp": "processing_timestamp", "Total_Sheets": "total_sheets",
    "Extracted_Fields": "extracted_fields", "Extracted_Tables": "extracted_tables",
}
BATCH_VISIT_COLUMNS = (
    "QAID", "QAMPR", "source_file", "hospital_id", "system_id", "extraction_status", "n_fields", "n_tables",
    "n_named_results",
)
REPORT_COLUMNS = (
    "source_file", "status", "QAID", "QAMPR", "hospital_id", "system_id", "n_fields", "n_tables",
    "n_named_results", "access_export_ok", "parquet_export_ok", "error_message",
)
PARTITIONS = ("year", "hospital", "system")
#: Tables of a batch that are written at the same time.
PARALLEL_TABLES = 8


def partition_columns() -> dict[str, Column]:
    """Year, hospital and system folder of a visit; a missing id is ``unknown``."""
    return {
        "year": visit_year(F.col("date_test"), F.col("processing_timestamp")),
        "hospital": F.coalesce(F.col("hospital_id").cast("string"), F.lit("unknown")),
        "system": F.coalesce(F.col("system_id").cast("string"), F.lit("unknown")),
    }


def batch_target(path: str, batch: str | None) -> tuple[str, str]:
    """Folder and save mode of a batch's part of a dataset."""
    return (path, "append") if batch is None else (f"{path}/batch={batch}", "overwrite")


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, batch: str | None = None) -> None:
    """Partitioned Parquet; adaptive execution splits a partition too big for one file."""
    target, mode = batch_target(path, batch)
    df.hint("rebalance", *[F.col(p) for p in partitions]).write.mode(mode).option("compression", "zstd").partitionBy(
        *partitions
    ).parquet(target)


def write_visits(visits: DataFrame, root: str, batch: str | None = None) -> None:
    rows = visits.withColumn("source_file", F.col("excel_file_name")).select(*VISIT_COLUMNS, *[
        c.alias(n) for n, c in partition_columns().items()
    ])
    write_partitioned(rows, f"{root}/visits", batch=batch)


def write_parquet_table(df: DataFrame, root: str, name: str, batch: str | None = None) -> str:
    path = f"{root}/{table_file_name(name)}"
    target, mode = batch_target(path, batch)
    df.write.mode(mode).option("compression", "zstd").parquet(target)
    return path


def at_once(spark: SparkSession, jobs: Sequence[Callable], parallel: int = PARALLEL_TABLES) -> list:
    """Results of independent jobs, several of which are under way at a time, so the end of
    one does not leave the cluster idle.  The first error is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def write_tables(tables: Mapping[str, DataFrame], root: str, batch: str | None = None) -> None:
    """One dataset per table, and the routed copies of the tables that have a target."""
    jobs = []
    for name, df in tables.items():
        jobs.append(lambda n=name, d=df: write_parquet_table(d, f"{root}/tables", n, batch))
        jobs += [lambda t=target, d=df: write_parquet_table(d, root, t, batch) for target in routing.parquet_targets(name)]
    if jobs:
        at_once(next(iter(tables.values())).sparkSession, jobs)


def write_text(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Quoted text with header; a quote inside a value is doubled."""
    (
        df.write.mode(mode).option("header", True).option("sep", sep).option("quoteAll", True)
        .option("escape", '"').option("encoding", "UTF-8").csv(path)
    )


def write_text_table(df: DataFrame, root: str, table: str, sep: str = ",") -> str:
    """Text export of a table into its sheet folder."""
    folder, file = routing.text_target(table)
    path = f"{root}/{folder}/{file}.txt"
    write_text(standardized(df), path, sep)
    return path


def renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def write_visit_text(visits: DataFrame, root: str) -> str:
    return write_text_table(renamed(visits, VISIT_TEXT_COLUMNS), root, "QAVisit")


def write_extraction_text(visits: DataFrame, root: str) -> str:
    return write_text_table(renamed(visits, EXTRACTION_TEXT_COLUMNS), root, "Extraction_Metadata")


def write_batch(
    tables: Mapping[str, DataFrame], visits: DataFrame, text_root: str, parquet_root: str, parallel: int = PARALLEL_TABLES,
) -> dict[str, str]:
    """Both batch exports: per table one write of all visits, plus the visit table.

    Tables are worked out once, for Parquet; their text is formatted from there.  Gives the
    messages of tables that could not be written; the others are not stopped by them.
    """
    stems = table_stems(tables)
    frames = {
        name: (prepare_export(df), f"{text_root}/Extracted_Tables/{stems[name]}.txt", f"{parquet_root}/tables/{stems[name]}.parquet")
        for name, df in tables.items()
    }
    frames["QAVisit"] = (
        prepare_export(visits.select(*BATCH_VISIT_COLUMNS)), f"{text_root}/Metadata/QAVisit.txt", f"{parquet_root}/metadata/QAVisit.parquet")

    def write(name: str) -> dict[str, str]:
        df, text, parquet = frames[name]
        errors = {}
        for sink, job in (("parquet", lambda: df.write.mode("overwrite").parquet(parquet)), ("text", lambda: write_text(df, text))):
            try:
                job()
            except Exception as exc:  # one table must not stop the others; its message goes to the report
                errors[f"{sink}:{name}"] = f"{sink} export failed for {name}: {exc}"
            else:
                if sink == "parquet":
                    df = df.sparkSession.read.schema(df.schema).parquet(parquet)
        return errors

    found = at_once(visits.sparkSession, [lambda n=name: write(n) for name in frames], parallel)
    return {key: message for errors in found for key, message in errors.items()}


def write_report(report: DataFrame, path: str) -> None:
    prepare_export(report.select(*REPORT_COLUMNS)).write.mode("overwrite").option("header", True).option(
        "escape", '"').csv(path)


def write_filtered(df: DataFrame, path: str, style: str) -> None:
    if style == "csv":
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif style == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"no distributed writer for {style!r}")


def dump_store(store: TableStore, root: str, tables: Sequence[str] | None = None, null_sentinel: bool = False) -> list[str]:
    """Stored tables as text, all or the selected ones."""
    paths = []
    for name, df in store.tables().items():
        if tables is None or name in tables:
            rows = none_number_to_null(df) if null_sentinel else df
            paths.append(write_text_table(rows, root, name))
    return paths


ARCHIVE_CHUNK = 1000


def archive_chunks(rows: DataFrame, section: str, row: str = "row", chunk_rows: int = ARCHIVE_CHUNK) -> DataFrame:
    """Rows of a visit packed into arrays of bounded length.

    A visit is cut by row number, so a very long table gives more chunks instead of
    one huge array.
    """
    body = [c for c in rows.columns if c != "workbook_id"]
    return (
        rows.withColumn("chunk", F.floor((F.col(row) - 1) / chunk_rows))
        .groupBy("workbook_id", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct(row, *[c for c in body if c != row]))).alias("rows"))
        .select("workbook_id", F.lit(section).alias("section"), "chunk", "rows")
    )


def write_archive(chunks: DataFrame, path: str, batch: str | None = None) -> None:
    target, mode = batch_target(path, batch)
    chunks.write.mode(mode).json(target)


def append_audit(log: DataFrame, store: TableStore, name: str = "AuditTrail", batch: str | None = None) -> None:
    target, mode = batch_target(store.path(name), batch)
    log.write.mode(mode).parquet(target)


def write_audit_parquet(log: DataFrame, path: str, batch: str | None = None) -> None:
    write_partitioned(audit.by_date(log), path, ("date",), batch)


def write_audit_text(log: DataFrame, path: str) -> None:
    """Tab-separated log; tabs inside details become spaces."""
    flat = log.select(*[
        F.regexp_replace(c, "\t", " ").alias(c) if c == "details" else F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c)
        for c in audit.EVENT_COLUMNS
    ])
    flat.write.mode("overwrite").option("header", True).option("sep", "\t").option("quote", "\u0000").option(
        "escapeQuotes", False).csv(path)


def write_audit_report(totals: DataFrame, path: str, style: str = "text") -> None:
    if style == "csv":
        audit.metric_rows(totals).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    else:
        audit.report_text(totals, style).write.mode("overwrite").text(path)
