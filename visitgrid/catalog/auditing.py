"""Audit and report queries on the event and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, stats
from ..operators.visits import resolve_references
from . import query
from .inputs import table
from .visiting import reference_tables


def order_status(spark, sf_dir):
    """Orders as processed files: status P failed, the others went well."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".xlsm")).alias("file_name"),
        F.col("o_orderkey").alias("qaid"), F.lit("base").alias("template_id"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("bad "), F.col("o_orderpriority"))).alias("error"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )


def order_log(spark, sf_dir, dry_run=False):
    return audit.file_events(order_status(spark, sf_dir), dry_run, F.concat(F.col("day"), F.lit("T00:00:00")))


_LOG_SQL = """st AS (
  SELECT 'order_' || CAST(o_orderkey AS VARCHAR) || '.xlsm' AS file_name, o_orderkey AS qaid,
         CASE WHEN o_orderstatus = 'P' THEN 'bad ' || o_orderpriority END AS error, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' AS ts FROM orders),
log AS (
  SELECT ts AS "timestamp", 'INFO' AS level, 'Orchestrator' AS component, 'ProcessingStart' AS event_type, 'Start processing file' AS message,
         file_name, CAST(NULL AS BIGINT) AS qaid, CAST(NULL AS BIGINT) AS duration_ms, '{"file":"' || file_name || '"}' AS details FROM st
  UNION ALL
  SELECT ts, CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'ERROR' END, 'Orchestrator',
         CASE WHEN error IS NULL THEN 'ProcessingComplete' ELSE 'ProcessingFailed' END,
         coalesce('Processing failed: ' || error, 'File processed successfully'), file_name, CASE WHEN error IS NULL THEN qaid END, NULL,
         CASE WHEN error IS NULL THEN '{"qaid":' || CAST(qaid AS VARCHAR) || ',"template_id":"base"}' ELSE '{"error":"' || error || '"}' END FROM st)"""


@query("audit_events", f"WITH {_LOG_SQL} SELECT * FROM log")
def audit_events(spark, sf_dir):
    """Start and outcome events of every file."""
    return order_log(spark, sf_dir)


@query("audit_dry_run", f"""
WITH {_LOG_SQL}
SELECT level, event_type, count(*) AS events, count(qaid) AS with_visit FROM (
  SELECT CASE WHEN level = 'SUCCESS' THEN 'INFO' ELSE level END AS level,
         CASE WHEN event_type = 'ProcessingComplete' THEN 'DryRunComplete' ELSE event_type END AS event_type, CAST(NULL AS BIGINT) AS qaid FROM log)
GROUP BY 1, 2
""")
def audit_dry_run(spark, sf_dir):
    """A dry run processes files without successes."""
    return order_log(spark, sf_dir, True).groupBy("level", "event_type").agg(
        F.count("*").alias("events"), F.count("qaid").alias("with_visit"))


@query("audit_metrics", f"""
WITH {_LOG_SQL}
SELECT count(*) FILTER (event_type = 'ProcessingStart') AS files_processed, count(*) FILTER (event_type = 'ProcessingComplete') AS successful_files,
       count(*) FILTER (event_type = 'ProcessingFailed') AS failed_files, count(*) AS total_events, count(*) FILTER (level = 'ERROR') AS error_events,
       count(*) FILTER (level = 'WARNING') AS warning_events, count(*) FILTER (level = 'SUCCESS') AS success_events,
       count(*) FILTER (event_type = 'ProcessingComplete') / count(*) FILTER (event_type = 'ProcessingStart') * 100 AS success_rate
FROM log
""")
def audit_metrics(spark, sf_dir):
    """Totals by level and the success rate."""
    return audit.metrics(order_log(spark, sf_dir))


@query("audit_metric_rows", """
WITH m AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT 'files_processed' AS metric, CAST(sum(n) FILTER (event_type = 'view') AS VARCHAR) AS value FROM m
UNION ALL SELECT 'successful_files', CAST(sum(n) FILTER (event_type = 'purchase') AS VARCHAR) FROM m
UNION ALL SELECT 'failed_files', CAST(sum(n) FILTER (event_type = 'error') AS VARCHAR) FROM m
UNION ALL SELECT 'total_events', CAST(sum(n) AS VARCHAR) FROM m
UNION ALL SELECT 'error_events', CAST(sum(n) FILTER (event_type = 'error') AS VARCHAR) FROM m
UNION ALL SELECT 'warning_events', CAST(sum(n) FILTER (event_type = 'signup') AS VARCHAR) FROM m
UNION ALL SELECT 'success_events', CAST(sum(n) FILTER (event_type = 'purchase') AS VARCHAR) FROM m
""")
def audit_metric_rows(spark, sf_dir):
    """Metric and value rows of the report, from the event table as a log."""
    return audit.metric_rows(audit.metrics(event_log(spark, sf_dir))).where("metric <> 'success_rate'")


def event_log(spark, sf_dir):
    """The event table as an audit log: kinds give level and event type."""
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "signup", "WARNING").when(kind == "purchase", "SUCCESS").otherwise("INFO")
    name = F.when(kind == "view", "ProcessingStart").when(kind == "purchase", "ProcessingComplete").when(
        kind == "error", "ProcessingFailed").otherwise(kind)
    return table(spark, sf_dir, "events").select(
        F.concat(F.col("ts").cast("date").cast("string"), F.lit("T00:00:00")).alias("timestamp"), level.alias("level"),
        F.lit("Events").alias("component"), name.alias("event_type"), F.concat(F.lit("event "), kind).alias("message"),
        F.lit("").alias("file_name"), F.when(kind != "view", F.col("user_id")).alias("qaid"),
        F.col("event_id").alias("duration_ms"), F.col("props").alias("details"))


@query("audit_by_date", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1
""")
def audit_by_date(spark, sf_dir):
    """Events and errors per day."""
    return audit.by_date(event_log(spark, sf_dir)).groupBy("date").agg(
        F.count("*").alias("events"), F.count_if(F.col("level") == "ERROR").alias("errors"))


@query("visit_events", "SELECT user_id AS qaid, event_id AS duration_ms FROM events WHERE event_type <> 'view'")
def visit_events(spark, sf_dir):
    """Events of each visit; those without a visit are left out."""
    return audit.visit_events(event_log(spark, sf_dir)).select("qaid", "duration_ms")


@query("audit_details", "SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS k FROM events")
def audit_details(spark, sf_dir):
    """Details read back from their JSON text."""
    return audit.parsed_details(event_log(spark, sf_dir)).select(
        F.col("duration_ms").alias("event_id"), F.try_element_at("details", F.lit("k")).alias("k"))


@query("audit_report_text", f"""
WITH {_LOG_SQL}, m AS (SELECT count(*) FILTER (event_type = 'ProcessingStart') AS n, count(*) FILTER (level = 'SUCCESS') AS ok,
  count(*) FILTER (level = 'ERROR') AS bad, count(*) AS total FROM log)
SELECT 'AUDIT REPORT' || chr(10) || 'SUMMARY' || chr(10) || 'Files Processed: ' || CAST(n AS VARCHAR) || chr(10) || 'Successful: ' || CAST(ok AS VARCHAR)
       || chr(10) || 'Failed: ' || CAST(bad AS VARCHAR) || chr(10) || 'Success Rate: ' || printf('%.1f', ok / n * 100) || '%' || chr(10)
       || 'Total Events: ' || CAST(total AS VARCHAR) AS value FROM m
""")
def audit_report_text(spark, sf_dir):
    """The audit report as text."""
    return audit.report_text(audit.metrics(order_log(spark, sf_dir)))


@query("resolution_events", """
WITH link AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT CASE WHEN k IS NULL THEN 'WARNING' ELSE 'INFO' END AS level, CASE WHEN k IS NULL THEN 'ReferenceResolutionNoMatch' ELSE 'ReferencesResolved' END AS event_type, count(*) AS events
FROM customer LEFT JOIN link ON k = c_custkey GROUP BY 1, 2
UNION ALL SELECT 'INFO', 'Created', count(*) FROM customer
""")
def resolution_events(spark, sf_dir):
    """Events of visit creation and reference lookup."""
    link, systems = reference_tables(spark, sf_dir)
    seen = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("qaid"), F.col("c_custkey").cast("string").alias("qampr"), F.col("c_name").alias("reference_qc"),
        F.lit("base").alias("template_id"))
    log = audit.resolution_events(resolve_references(seen, link, systems, "load_order"))
    return log.groupBy("level", "event_type").agg(F.count("*").alias("events"))


@query("extraction_events", """
SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS file_name,
       'Extracted ' || CAST(count(*) AS VARCHAR) || ' fields and ' || CAST(count(DISTINCT l_linenumber) AS VARCHAR) || ' tables' AS message
FROM lineitem GROUP BY l_orderkey
""")
def extraction_events(spark, sf_dir):
    """Extraction messages with their counts."""
    lines = table(spark, sf_dir, "lineitem")
    counts = lines.groupBy("l_orderkey").agg(F.count("*").alias("n_fields"), F.count_distinct("l_linenumber").alias("n_tables"))
    named = counts.withColumn("file_name", F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")))
    return audit.extraction_events(named, F.lit("2026-01-01")).select("file_name", "message")


@query("template_events", """
SELECT 'Template base selected' AS message, '{"method":"' || o_orderpriority || '"}' AS details, count(*) AS events FROM orders GROUP BY 1, 2
""")
def template_events(spark, sf_dir):
    """Template choice per file, counted by method."""
    orders = table(spark, sf_dir, "orders").select(F.lit("base").alias("template_id"), F.col("o_orderpriority"), F.lit("f").alias("file_name"))
    log = audit.template_events(orders, F.col("o_orderpriority"), F.lit("2026-01-01"))
    return log.groupBy("message", "details").agg(F.count("*").alias("events"))


@query("batch_completion", """
SELECT count(*) FILTER (o_orderstatus <> 'P') AS success_count, count(*) AS total_count,
       printf('%.1f', count(*) FILTER (o_orderstatus <> 'P') / count(*) * 100) || '%' AS success_rate FROM orders
""")
def batch_completion(spark, sf_dir):
    """Successes, files, and rate as text."""
    return stats.batch_completion(order_status(spark, sf_dir), F.col("error").isNull())


def order_report(spark, sf_dir):
    """Processing report rows; failures come from lines of the urgent orders."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    report = orders.select(
        F.col("o_orderkey").cast("string").alias("source_file"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
        F.col("o_orderkey").alias("QAID"), F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("QAMPR"),
        F.when(F.col("o_orderstatus") == "P", "broken").alias("error"))
    sink = F.when(F.col("l_linenumber") % 2 == 0, "text").otherwise("parquet")
    failures = lines.where("l_returnflag = 'R' and l_linestatus = 'F'").select(
        F.col("l_orderkey").cast("string").alias("source_file"), sink.alias("sink"),
        F.concat(sink, F.lit(" export failed for t"), F.col("l_linenumber").cast("string")).alias("message"))
    return stats.report_with_failures(report, failures)


_REPORT_SQL = """fail AS (SELECT DISTINCT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 'text' ELSE 'parquet' END AS sink,
    CASE WHEN l_linenumber % 2 = 0 THEN 'text' ELSE 'parquet' END || ' export failed for t' || CAST(l_linenumber AS VARCHAR) AS message
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
msg AS (SELECT l_orderkey, bool_or(sink = 'text') AS t, bool_or(sink = 'parquet') AS p, string_agg(message, '; ' ORDER BY sink = 'parquet', message) AS m FROM fail GROUP BY 1),
rep AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS source_file, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status, o_orderkey AS "QAID",
         CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS "QAMPR", o_orderstatus <> 'P' AND NOT coalesce(t, FALSE) AS access_export_ok,
         o_orderstatus <> 'P' AND NOT coalesce(p, FALSE) AS parquet_export_ok, concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'broken' END, m) AS error_message
  FROM orders LEFT JOIN msg ON l_orderkey = o_orderkey)"""


@query("report_join", f"WITH {_REPORT_SQL} SELECT * FROM rep")
def report_join(spark, sf_dir):
    """Report rows with export flags and the messages of failed tables."""
    return order_report(spark, sf_dir)


@query("batch_summary", f"""
WITH {_REPORT_SQL}
SELECT count(*) AS files_found, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status <> 'success') AS failed,
       count(*) FILTER ("QAMPR" IS NULL) AS missing_qampr, count(*) FILTER (NOT parquet_export_ok) AS parquet_errors, count(*) FILTER (NOT access_export_ok) AS text_errors
FROM rep
""")
def batch_summary(spark, sf_dir):
    """Totals of the processing report."""
    return stats.batch_summary(order_report(spark, sf_dir))


@query("result_summary", """
SELECT CAST(l_orderkey AS VARCHAR) AS workbook_id, count(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS fields_count,
       count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS tables_count, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS scalar_records_count,
       count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS named_results_count, count(*) FILTER (l_returnflag = 'R') AS total_rows
FROM lineitem GROUP BY 1
""")
def result_summary(spark, sf_dir):
    """Counts of what each workbook gave."""
    flag = F.col("l_returnflag")
    item = F.when(flag == "A", "field").when(flag == "R", "table").when(F.col("l_linestatus") == "O", "scalar_record").otherwise("named_result")
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("workbook_id"), item.alias("item"), F.col("l_partkey").alias("name"))
    return stats.result_summary(items)
