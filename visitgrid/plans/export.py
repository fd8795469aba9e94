"""Full export of extracted visits: Parquet, quoted text, archive and audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, records, routing, stats
from ..operators.tables import union_by_name
from ..operators.visits import add_trace
from ..session import materialize
from ..sinks import writers
from ..sources.tables import TableStore
from .batch import Extraction


def _field_names(fields: DataFrame) -> list[str]:
    """Field names that occur: as many as the mapping has scalars."""
    return [r["name"] for r in fields.select("name").distinct().sort("name").collect()]


def wide_fields(fields: DataFrame, words: tuple[str, ...] | None = None) -> DataFrame | None:
    """One row of fields per workbook, all of them or those whose name holds a word."""
    chosen = fields if words is None else records.named_fields(fields, words)
    names = _field_names(chosen)
    return records.pivot_last(chosen, ["workbook_id"], names) if names else None


def summary_results(result: Extraction) -> dict[str, DataFrame]:
    """The two summary results (first candidate table, else matching fields) and the
    noise fields."""
    found = {
        "ctdi_results": routing.first_available(result.tables, routing.DOSE_TABLES),
        "iq_results": routing.first_available(result.tables, routing.IMAGE_TABLES),
    }
    if found["ctdi_results"] is None:
        found["ctdi_results"] = wide_fields(result.fields, routing.DOSE_WORDS)
    if found["iq_results"] is None:
        found["iq_results"] = wide_fields(result.fields, routing.IMAGE_WORDS)
    found["noise_fields"] = wide_fields(result.fields, ("noise",))
    return {name: df for name, df in found.items() if df is not None}


def single_value_tables(result: Extraction) -> dict[str, DataFrame]:
    """Rows of the tables that consist of scalars only, one frame per table.

    The records are read once for all of them; what a table opens are its own files.
    """
    known = {"workbook_id", "seq", "sheet_id", "sheet_name", "section_id", "db_table", "name", "kind", "dtype", "row",
             "col", "value", "required"}
    context = [c for c in result.records.columns if c not in known]
    filled = result.table_rows.select("workbook_id", F.col("table_key").alias("db_table"))
    maps = materialize(records.single_value_maps(result.records, filled, context), "single-values", "db_table")
    rows = result.records.where(F.col("kind").isin(*records.ROW_KINDS) & (F.trim("db_table") != ""))
    names: dict[str, list[str]] = {}
    for table, name in sorted(rows.select("db_table", "name").distinct().collect()):  # bounded by the mapping
        names.setdefault(table, []).append(name)
    return {
        table: maps.where(F.col("db_table") == table).select(
            "workbook_id", "db_table", F.col("sheet_id").alias("source_sheet_id"), F.col("sheet_name").alias("source_sheet_name"),
            F.col("section_id").alias("source_section_id"), *[F.try_element_at("values", F.lit(n)).alias(n) for n in own],
            *[c for c in context if c not in own])
        for table, own in names.items()
    }


def audit_rows(result: Extraction) -> DataFrame:
    totals = stats.extraction_stats(
        result.workbooks.where("error is null"), result.fields, result.records, result.table_rows, result.sheet_audit)
    return audit.sheet_audit_rows(result.sheet_audit, totals)


def files_name(paths: DataFrame, path: str) -> str:
    """Name of a batch after its files: the same files, in any order, have the same name."""
    mixed = paths.select(path).distinct().agg(F.bit_xor(F.xxhash64(path)), F.count(path)).first()
    return f"{(mixed[0] or 0) % (1 << 64):016x}-{mixed[1]}"


def run_name(result: Extraction) -> str:
    return files_name(result.workbooks, "source_path")


def export_parquet(result: Extraction, visits: DataFrame, root: str, batch: str | None = None) -> None:
    """Visits by year, hospital and system; tables, records, fields and audit rows.  A batch
    (named after its files, if not by the caller) replaces what an earlier run of it wrote."""
    batch = batch or run_name(result)
    ids = visits.select("workbook_id", "qaid")

    def with_id(df: DataFrame) -> DataFrame:
        return df.drop("qaid").join(ids, "workbook_id", "left")

    writers.write_visits(visits, root, batch)
    writers.write_tables({name: with_id(df.drop("row")) for name, df in result.tables.items()}, root, batch)
    parts: Mapping[str, DataFrame | None] = {
        **summary_results(result), "scalar_records": result.scalars, "named_results": result.named_results,
        "extracted_fields": wide_fields(result.fields), "extraction_audit": audit_rows(result),
    }
    writers.at_once(visits.sparkSession, [
        lambda n=name, d=df: writers.write_parquet_table(with_id(d), root, n, batch) for name, df in parts.items() if df is not None])


def export_text(result: Extraction, visits: DataFrame, root: str, sep: str = ",") -> list[str]:
    """Quoted text tables in their sheet folders, with trace columns."""
    def traced(df: DataFrame) -> DataFrame:
        return add_trace(df, visits).drop("workbook_id")

    totals = stats.extraction_stats(
        result.workbooks.where("error is null"), result.fields, result.records, result.table_rows, result.sheet_audit)
    counted = visits.join(totals.select("workbook_id", "total_sheets", "extracted_fields", "extracted_tables"), "workbook_id", "left")
    jobs = [lambda: writers.write_visit_text(visits, root), lambda: writers.write_extraction_text(counted, root)]
    named = {"CTDI_Results": routing.DOSE_TABLES, "IQ_Results": routing.IMAGE_TABLES}
    tables = {name: df.drop("row", "sheet_id") for name, df in result.tables.items()}
    for name, candidates in named.items():
        found = routing.first_available(tables, candidates)
        if found is not None:
            tables[name] = found
    for name, rows in single_value_tables(result).items():  # of workbooks that have no rows in the table
        tables[name] = union_by_name([tables[name], rows]) if name in tables else rows
    jobs += [lambda n=name, d=df: writers.write_text_table(traced(d), root, n, sep) for name, df in tables.items()]
    extra = {"Scalar_Records": result.scalars.drop("seq", "required"), "Named_Results": result.named_results.drop("seq", "required"),
             "Extracted_Fields": wide_fields(result.fields)}

    def write_extra(name: str, df: DataFrame) -> str:
        path = f"{root}/Metadata/{name}.txt"
        writers.write_text(writers.standardized(traced(df)), path, sep)
        return path

    jobs += [lambda n=name, d=df: write_extra(n, d) for name, df in extra.items() if df is not None]
    return writers.at_once(visits.sparkSession, jobs)


def export_archive(result: Extraction, visits: DataFrame, log: DataFrame, root: str, batch: str | None = None) -> None:
    """Visit metadata, all rows in chunks of bounded length, and each visit's events.
    Batches as in ``export_parquet``."""
    batch = batch or run_name(result)
    meta = visits.select("workbook_id", "qaid", "qampr", "reference_qc", "template_id", "hospital_id", "system_id",
                         "system_info_id", "excel_file_name", "processing_timestamp", "workbook_hash")
    writers.write_archive(meta, f"{root}/metadata", batch)
    for name, df in result.tables.items():
        writers.write_archive(writers.archive_chunks(df, name), f"{root}/result/{writers.table_file_name(name)}", batch)
    scalars = result.records.drop("row").withColumnRenamed("seq", "row").withColumn("row", F.col("row") + 1)
    writers.write_archive(writers.archive_chunks(scalars, "records"), f"{root}/result/records", batch)
    writers.write_archive(audit.visit_events(log), f"{root}/audit", batch)


def export_audit(log: DataFrame, store: TableStore, parquet_root: str, text_root: str, batch: str | None = None) -> None:
    """The log of a run in all its forms; a batch (named after the files in the log, if not
    by the caller) replaces what an earlier run of it wrote."""
    batch = batch or files_name(log.where("file_name <> ''"), "file_name")
    writers.append_audit(log, store, batch=batch)
    writers.write_audit_parquet(log, f"{parquet_root}/audit", batch)
    writers.write_audit_text(log, f"{text_root}/AuditTrail.txt")
