"""Sink queries: write to the shared folder, read back, give the rows."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, typing
from ..operators.scalars import scalar_records
from ..plans.mapping import read_mapping
from ..session import scratch_path
from ..sinks import writers
from ..sources import tables as readers
from . import query
from .auditing import event_log, order_report
from .inputs import EVENTS_SQL, books_of, event_cells, line_rows, table
from .visiting import VISITS_SQL, order_visits


@query("partitioned_visits", f"""
WITH {VISITS_SQL}
SELECT qaid, qampr, reference_qc, type, date_test, hospital_id, system_id, system_info_id, excel_file_name, excel_file_name AS source_file, template_id,
       sidecar_version, workbook_hash, qa_member1, qa_member2, processing_timestamp, extraction_method, left(date_test, 4) AS year, CAST(hospital_id AS VARCHAR) AS hospital
FROM visits
""")
def partitioned_visits(spark, sf_dir):
    """Visits written by year and hospital, and read back."""
    seen = order_visits(spark, sf_dir)
    root = scratch_path(spark, "visits")
    rows = seen.withColumn("source_file", F.col("excel_file_name")).select(
        *writers.VISIT_COLUMNS, *[c.alias(n) for n, c in writers.partition_columns().items() if n != "system"])
    writers.write_partitioned(rows, root, ("year", "hospital"))
    return spark.read.schema(rows.schema).parquet(root)


@query("export_rerun", f"""
WITH {VISITS_SQL}
SELECT 'visits' AS part, batch, qaid FROM visits, (VALUES ('a'), ('b')) x(batch) WHERE (qaid % 2 = 0) = (batch = 'a')
UNION ALL SELECT 'table', 'a', l_orderkey FROM lineitem
UNION ALL SELECT 'archive', 'a', qaid FROM visits
UNION ALL SELECT 'audit', 'a', event_id FROM events
UNION ALL SELECT 'audit by date', 'a', event_id FROM events
""")
def export_rerun(spark, sf_dir):
    """Two batches of visits, the first written twice, and a table, an archive and the audit
    log written twice: no row is there more than once."""
    seen, root = order_visits(spark, sf_dir).withColumn("system_id", F.lit(1).cast("bigint")), scratch_path(spark, "rerun")
    even = seen.where("qaid % 2 = 0")
    for part, batch in ((even, "a"), (seen.where("qaid % 2 = 1"), "b"), (even, "a")):
        writers.write_visits(part, root, batch)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("qaid"), "l_linenumber")
    for _ in range(2):
        writers.write_tables({"lines/all": lines}, root, "a")
        writers.write_archive(seen.select("qaid", "qampr"), f"{root}/archive", "a")
        writers.append_audit(event_log(spark, sf_dir), readers.TableStore(spark, root), batch="a")
        writers.write_audit_parquet(event_log(spark, sf_dir), f"{root}/audit", "a")

    def part(name: str, df, key: str = "qaid"):
        return df.select(F.lit(name).alias("part"), "batch", F.col(key).alias("qaid"))

    parts = [
        part("visits", readers.read_dataset(spark, f"{root}/visits")), part("table", readers.read_dataset(spark, f"{root}/tables/lines__all")),
        part("archive", spark.read.schema("qaid bigint, batch string").json(f"{root}/archive")),
        part("audit", readers.read_audit(readers.TableStore(spark, root)), "duration_ms"),
        part("audit by date", readers.read_dataset(spark, f"{root}/audit"), "duration_ms"),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query("parquet_roundtrip", """
SELECT l_orderkey, l_linenumber, l_quantity, l_orderkey AS qaid, 'lines__all' AS table_name FROM lineitem
UNION ALL
SELECT o_orderkey, NULL, o_totalprice, o_orderkey, 'geometry_lines' FROM orders
""")
def parquet_roundtrip(spark, sf_dir):
    """One dataset per table, the routed copy of one table included."""
    root = scratch_path(spark, "tables")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_orderkey").alias("qaid"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("l_quantity"), F.col("o_orderkey").alias("qaid"))
    writers.write_tables({"lines/all": lines, "geometry_lines": orders}, root)
    first = readers.read_dataset(spark, f"{root}/tables/lines__all").withColumn("table_name", F.lit("lines__all"))
    second = readers.read_dataset(spark, f"{root}/geometry_geometry_lines").withColumn("table_name", F.lit("geometry_lines"))
    return first.unionByName(second, allowMissingColumns=True)


@query("txt_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'say "' || o_orderstatus || '", twice' AS status__x, o_orderpriority, CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS cust FROM orders
""")
def txt_roundtrip(spark, sf_dir):
    """Quoted text with quotes, separators and nulls inside, plain column names."""
    root = scratch_path(spark, "text")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('", twice')).alias("status -(x)"), "o_orderpriority",
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("cust"))
    path = writers.write_text_table(orders, root, "orders/all")
    back = readers.read_text_table(spark, path, schema="o_orderkey string, status__x string, o_orderpriority string, cust string")
    return back.withColumn("cust", F.when(F.col("cust") != "", F.col("cust")))


@query("visit_text", f"""
WITH {VISITS_SQL}
SELECT CAST(qaid AS VARCHAR) AS "ID", qampr AS "Qampr", reference_qc AS "Reference_QC", type AS "Type", date_test AS "Date_Test", CAST(hospital_id AS VARCHAR) AS "Hospital_ID",
       CAST(system_id AS VARCHAR) AS "System_ID", CAST(system_info_id AS VARCHAR) AS "System_Info_ID", excel_file_name AS "Excel_File_Name", qa_member1 AS "QA_Member1",
       qa_member2 AS "QA_Member2", date_to_db AS "Date_To_DB", template_id AS "Template_ID", workbook_hash AS "Workbook_Hash"
FROM visits
""")
def visit_text(spark, sf_dir):
    """The 14-column visit table in the text export."""
    root = scratch_path(spark, "visit-text")
    path = writers.write_visit_text(order_visits(spark, sf_dir), root)
    return readers.read_text_table(spark, path)


@query("extraction_text", f"""
WITH {VISITS_SQL}
SELECT CAST(qaid AS VARCHAR) AS "QAID", template_id AS "Template_ID", sidecar_version AS "Sidecar_Version", workbook_hash AS "Workbook_Hash",
       extraction_method AS "Extraction_Method", processing_timestamp AS "Processing_Timestamp", '3' AS "Total_Sheets", '0' AS "Extracted_Fields", '0' AS "Extracted_Tables"
FROM visits
""")
def extraction_text(spark, sf_dir):
    """The extraction table of the text export."""
    root = scratch_path(spark, "extraction-text")
    seen = order_visits(spark, sf_dir).withColumns(
        {"total_sheets": F.lit(3), "extracted_fields": F.lit(0), "extracted_tables": F.lit(0)})
    path = writers.write_extraction_text(seen, root)
    return readers.read_text_table(spark, path)


@query("batch_export", f"""
WITH {VISITS_SQL}
SELECT 'parquet' AS sink, l_orderkey AS "QAID", CAST(l_linenumber AS VARCHAR) AS line, l_returnflag AS flag FROM lineitem
UNION ALL SELECT 'text', l_orderkey, CAST(l_linenumber AS VARCHAR), l_returnflag FROM lineitem
UNION ALL SELECT 'visit', qaid, NULL, 'success' FROM visits
""")
def batch_export(spark, sf_dir):
    """Batch export of one table and the visits to both sinks."""
    root = scratch_path(spark, "batch")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("QAID"), F.col("l_linenumber").cast("string").alias("line"), F.col("l_returnflag").alias("flag"))
    seen = order_visits(spark, sf_dir).select(
        F.col("qaid").alias("QAID"), F.col("qampr").alias("QAMPR"), F.col("excel_file_name").alias("source_file"), "hospital_id", "system_id",
        F.lit("success").alias("extraction_status"), F.lit(0).alias("n_fields"), F.lit(1).alias("n_tables"), F.lit(0).alias("n_named_results"))
    errors = writers.write_batch({"lines/all": lines}, seen, f"{root}/text", f"{root}/parquet")
    if errors:
        raise RuntimeError("; ".join(errors.values()))
    columns = ["sink", "QAID", "line", "flag"]
    kept = spark.read.parquet(f"{root}/parquet/tables/lines_all.parquet").withColumn("sink", F.lit("parquet"))
    text = readers.read_text_table(spark, f"{root}/text/Extracted_Tables/lines_all.txt", schema="QAID bigint, line string, flag string")
    visit = spark.read.parquet(f"{root}/parquet/metadata/QAVisit.parquet").select(
        F.lit("visit").alias("sink"), "QAID", F.lit(None).cast("string").alias("line"), F.col("extraction_status").alias("flag"))
    return kept.select(*columns).unionByName(text.withColumn("sink", F.lit("text")).select(*columns)).unionByName(visit)


#: Tables of the query below.
MANY = 20


@query("batch_export_many", f"""
WITH s(sink) AS (VALUES ('parquet'), ('text'))
SELECT sink, CAST(l_suppkey % {MANY} AS INTEGER) AS no, l_orderkey AS "QAID", CAST(l_linenumber AS VARCHAR) AS line,
  CASE l_suppkey % {MANY} % 3 WHEN 0 THEN l_returnflag WHEN 1 THEN CAST(l_partkey AS VARCHAR) ELSE l_linestatus END AS value
FROM lineitem, s
""")
def batch_export_many(spark, sf_dir):
    """Batch export of many tables with columns of their own to both sinks, read back in full."""
    root, lines = scratch_path(spark, "many"), table(spark, sf_dir, "lineitem")
    kinds = [("flag", "l_returnflag"), ("part", "l_partkey"), ("state", "l_linestatus")]

    def rows(no: int):
        name, source = kinds[no % 3]
        return lines.where(F.col("l_suppkey") % MANY == no).select(
            F.col("l_orderkey").alias("QAID"), F.col("l_linenumber").cast("string").alias("line"), F.col(source).alias(f"{name}_{no}"))

    seen = order_visits(spark, sf_dir).select(
        F.col("qaid").alias("QAID"), F.col("qampr").alias("QAMPR"), F.col("excel_file_name").alias("source_file"), "hospital_id", "system_id",
        F.lit("success").alias("extraction_status"), F.lit(0).alias("n_fields"), F.lit(1).alias("n_tables"), F.lit(0).alias("n_named_results"))
    errors = writers.write_batch({f"lines/{no}": rows(no) for no in range(MANY)}, seen, f"{root}/text", f"{root}/parquet")
    if errors:
        raise RuntimeError("; ".join(errors.values()))
    parts = []
    for no in range(MANY):
        own = f"{kinds[no % 3][0]}_{no}"
        kept = spark.read.parquet(f"{root}/parquet/tables/lines_{no}.parquet")
        text = readers.read_text_table(spark, f"{root}/text/Extracted_Tables/lines_{no}.txt", schema=f"QAID bigint, line string, {own} string")
        for sink, df in (("parquet", kept), ("text", text)):
            parts.append(df.select(F.lit(sink).alias("sink"), F.lit(no).alias("no"), "QAID", "line", F.col(own).cast("string").alias("value")))
    return functools.reduce(DataFrame.unionByName, parts)


@query("store_roundtrip", """
SELECT c_custkey AS "ID", CASE WHEN c_custkey % 4 < 2 THEN c_name ELSE lower(c_name) END AS name FROM customer WHERE c_custkey > 10
""")
def store_roundtrip(spark, sf_dir):
    """Put, incremental load, condition scan and table list of a store."""
    store = readers.TableStore(spark, scratch_path(spark, "store"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("name"))
    store.create("Empty", "ID bigint")
    store.put("System", customer.where("ID % 4 < 2"))
    store.load_reference("System", customer.withColumn("name", F.lower("name")))
    if store.names() != ["Empty", "System"] or store.get("Missing", "ID bigint").columns != ["ID"]:
        raise RuntimeError("store lists the wrong tables")
    return store.select("System", "ID > 10")


@query("store_dump", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, CASE WHEN l_linenumber > 2 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS n FROM lineitem
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), NULL, '' FROM lineitem
""")
def store_dump(spark, sf_dir):
    """Stored tables as text, the stand-in for "none" written as empty."""
    store = readers.TableStore(spark, scratch_path(spark, "store"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).otherwise(typing.NONE_NUMBER).alias("n"))
    store.put("lines", lines)
    store.put("other", lines.select("l_orderkey"))
    store.put("unwanted", lines.limit(1))
    paths = writers.dump_store(store, scratch_path(spark, "dump"), ["lines", "other"], null_sentinel=True)
    lines_back = readers.read_text_table(spark, paths[0], schema="l_orderkey string, l_partkey string, n string")
    other_back = readers.read_text_table(spark, paths[1], schema="l_orderkey string")
    return lines_back.unionByName(other_back, allowMissingColumns=True).withColumn("n", F.coalesce("n", F.lit("")))


@query("reference_scan", """
SELECT 'System' AS table_name, CAST(s_suppkey AS DOUBLE) AS "ID", CAST(s_nationkey AS DOUBLE) AS "System_Info_ID", NULL AS "Qampr" FROM supplier
UNION ALL SELECT 'Linktable', CAST(c_custkey AS DOUBLE), NULL, 'C' || CAST(c_custkey AS VARCHAR) FROM customer
""")
def reference_scan(spark, sf_dir):
    """A folder of reference text tables, typed by content, as one long table."""
    root = scratch_path(spark, "static")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").alias("System_Info_ID"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("Qampr"))
    writers.write_text(supplier, f"{root}/System.txt")
    writers.write_text(customer, f"{root}/Linktable.txt")
    parts = [df.withColumn("table_name", F.lit(name)) for name, df in sorted(readers.read_reference_tables(spark, root).items(), reverse=True)]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query("filtered_export", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def filtered_export(spark, sf_dir):
    """Filtered rows exported as JSON lines and read back."""
    path = scratch_path(spark, "export")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_filtered(typing.where_equal(orders, ["o_orderstatus=O"]), path, "json")
    return spark.read.schema(orders.schema).json(path)


@query("csv_report", """
SELECT status, access_export_ok, count(*) AS n FROM (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
         o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber % 2 = 0) AS access_export_ok FROM orders)
GROUP BY 1, 2
""")
def csv_report(spark, sf_dir):
    """Processing report written as CSV, read back and counted."""
    path = scratch_path(spark, "report")
    zero = {n: F.lit(0) for n in ("hospital_id", "system_id", "n_fields", "n_tables", "n_named_results")}
    writers.write_report(order_report(spark, sf_dir).withColumns(zero), path)
    back = readers.read_text_table(spark, path)
    return back.groupBy("status", F.col("access_export_ok").cast("boolean").alias("access_export_ok")).agg(F.count("*").alias("n"))


@query("audit_parquet", """
SELECT strftime(ts, '%Y-%m-%d') AS date, event_id AS duration_ms, props AS details FROM events
""")
def audit_parquet(spark, sf_dir):
    """Log partitioned by event date, and read back."""
    path = scratch_path(spark, "audit")
    log = event_log(spark, sf_dir)
    writers.write_audit_parquet(log, path)
    back = spark.read.schema(audit.by_date(log).schema).parquet(path)
    return back.select("date", "duration_ms", "details")


@query("audit_text", """
SELECT CAST(event_id AS VARCHAR) AS duration_ms, CASE WHEN event_type = 'view' THEN 'None' ELSE CAST(user_id AS VARCHAR) END AS qaid, 'a b ' || props AS details FROM events
""")
def audit_text(spark, sf_dir):
    """Tab-separated log; tabs in details become spaces."""
    path = scratch_path(spark, "audit-text")
    log = event_log(spark, sf_dir).withColumn("details", F.concat(F.lit("a\tb "), F.col("details")))
    writers.write_audit_text(log, path)
    back = spark.read.option("header", True).option("sep", "\t").option("quote", "\u0000").csv(path)
    return back.select("duration_ms", "qaid", "details")


@query("audit_store", "SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS k FROM events UNION ALL SELECT event_id, regexp_extract(props, '(\\d+)', 1) FROM events")
def audit_store(spark, sf_dir):
    """Log appended twice to the store and read back with its details."""
    store = readers.TableStore(spark, scratch_path(spark, "store"))
    for _ in range(2):
        writers.append_audit(event_log(spark, sf_dir), store)
    return readers.read_audit(store).select(
        F.col("duration_ms").alias("event_id"), F.try_element_at("details", F.lit("k")).alias("k"))


@query("json_archive", """
SELECT CAST(l_orderkey AS VARCHAR) AS workbook_id, 'lines' AS section, CAST(l_linenumber AS INTEGER) AS "row", sum(l_quantity) AS a, max(l_extendedprice) AS b,
       max(l_returnflag) AS d FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def json_archive(spark, sf_dir):
    """Rows of each visit archived as JSON chunks of bounded length, and read back."""
    path = scratch_path(spark, "archive")
    rows = line_rows(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("workbook_id"), F.col("l_linenumber").cast("int").alias("row"), "a", "b", "d")
    writers.write_archive(writers.archive_chunks(rows, "lines", chunk_rows=3), path)
    return readers.read_archive(spark, path, "row int, a double, b double, d string")


@query("record_sinks", f"""
WITH {EVENTS_SQL}
SELECT workbook_id, 'scalar_records' AS sink, 'v' AS name, CAST(max(CASE WHEN r = 4 THEN b END) AS VARCHAR) AS value FROM ev GROUP BY 1
UNION ALL SELECT workbook_id, 'named_results', 'n', max(CASE WHEN r = 5 THEN a END) FROM ev GROUP BY 1
""")
def record_sinks(spark, sf_dir):
    """Scalar records and named results in their own datasets."""
    cells = event_cells(spark, sf_dir)
    document = {"workbook": {}, "sheets": {"s": {"sheet_name": "EV", "sections": {"x": {
        "v": {"row": 4, "col": "B", "dtype": "float"}, "named_results": {"n": {"row": 5, "col": "A"}}}}}}}
    rows = scalar_records(books_of(cells), cells, read_mapping(document).scalars)
    root = scratch_path(spark, "records")
    named = F.col("kind") == "named_result"
    paths = {name: writers.write_parquet_table(part, root, name)
             for name, part in (("scalar_records", rows.where(~named)), ("named_results", rows.where(named)))}
    parts = [spark.read.parquet(path).select("workbook_id", F.lit(name).alias("sink"), "name", "value") for name, path in paths.items()]
    return parts[0].unionByName(parts[1])


@query("audit_report_csv", """
WITH m AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT 'files_processed' AS metric, CAST(sum(n) FILTER (event_type = 'view') AS VARCHAR) AS value FROM m
UNION ALL SELECT 'successful_files', CAST(sum(n) FILTER (event_type = 'purchase') AS VARCHAR) FROM m
UNION ALL SELECT 'failed_files', CAST(sum(n) FILTER (event_type = 'error') AS VARCHAR) FROM m
UNION ALL SELECT 'total_events', CAST(sum(n) AS VARCHAR) FROM m
UNION ALL SELECT 'error_events', CAST(sum(n) FILTER (event_type = 'error') AS VARCHAR) FROM m
UNION ALL SELECT 'warning_events', CAST(sum(n) FILTER (event_type = 'signup') AS VARCHAR) FROM m
UNION ALL SELECT 'success_events', CAST(sum(n) FILTER (event_type = 'purchase') AS VARCHAR) FROM m
UNION ALL SELECT 'success_rate', printf('%.6f', 100.0 * sum(n) FILTER (event_type = 'purchase') / sum(n) FILTER (event_type = 'view')) FROM m
""")
def audit_report_csv(spark, sf_dir):
    """All metric rows of the CSV report; the rate with six places."""
    path = scratch_path(spark, "audit-report")
    writers.write_audit_report(audit.metrics(event_log(spark, sf_dir)), path, "csv")
    value = F.when(F.col("metric") == "success_rate", F.format_string("%.6f", F.col("value").cast("double"))).otherwise(F.col("value"))
    return readers.read_text_table(spark, path).withColumn("value", value)


@query("audit_report_html", """
WITH m AS (SELECT count(*) FILTER (event_type = 'view') AS n, count(*) FILTER (event_type = 'purchase') AS ok, count(*) FILTER (event_type = 'error') AS bad FROM events)
SELECT '<html><head><title>Audit Report</title></head><body><h1>Audit Report</h1><h2>Summary</h2><ul><li>Files Processed: ' || n || '</li><li>Successful: ' || ok
       || '</li><li>Failed: ' || bad || '</li><li>Success Rate: ' || printf('%.1f', ok / n * 100) || '%</li></ul></body></html>' AS value FROM m
""")
def audit_report_html(spark, sf_dir):
    """The report as a page, written and read back."""
    path = scratch_path(spark, "audit-page")
    writers.write_audit_report(audit.metrics(event_log(spark, sf_dir)), path, "html")
    return spark.read.text(path)


@query("filtered_export_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filtered_export_csv(spark, sf_dir):
    """Filtered rows exported as CSV and read back."""
    path = scratch_path(spark, "export-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_filtered(typing.where_equal(orders, ["o_orderstatus=F"]), path, "csv")
    return spark.read.schema(orders.schema).option("header", True).csv(path)
