"""Visit queries: attributes, lookups, ids, trace columns, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import checks
from ..functions.identity import visit_year
from ..operators import numbering, stats, tables, visits
from ..plans.mapping import LAST_ROW, read_mapping
from ..session import scratch_path
from ..sinks import writers
from ..sources.tables import resolve_from_folder as resolve_folder
from . import query
from .inputs import LINES_SQL, line_cells, mapping, table


def order_visits(spark, sf_dir):
    """Orders as visits: the order is the visit, the customer its device and system."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, "o_custkey", "left")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("workbook_id"), F.col("o_orderkey").alias("qaid"),
        F.col("o_custkey").cast("string").alias("qampr"), F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("reference_qc"),
        F.col("o_orderstatus").alias("type"), F.col("o_orderdate").cast("date").cast("string").alias("date_test"),
        F.col("c_nationkey").cast("bigint").alias("hospital_id"), F.col("o_custkey").alias("system_id"),
        F.lit(None).cast("bigint").alias("system_info_id"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".xlsm")).alias("excel_file_name"),
        F.lit("base").alias("template_id"), F.lit("1").alias("sidecar_version"), F.lit("0" * 16).alias("workbook_hash"),
        F.lit(None).cast("string").alias("qa_member1"), F.lit(None).cast("string").alias("qa_member2"),
        F.lit("2026-01-01T00:00:00").alias("processing_timestamp"), F.lit("2026-01-01").alias("date_to_db"),
        F.lit("template").alias("extraction_method"),
    )


VISITS_SQL = """visits AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS workbook_id, o_orderkey AS qaid, CAST(o_custkey AS VARCHAR) AS qampr,
         'R' || CAST(o_custkey AS VARCHAR) AS reference_qc, o_orderstatus AS type, strftime(o_orderdate, '%Y-%m-%d') AS date_test,
         CAST(c_nationkey AS BIGINT) AS hospital_id, o_custkey AS system_id, CAST(NULL AS BIGINT) AS system_info_id,
         'order_' || CAST(o_orderkey AS VARCHAR) || '.xlsm' AS excel_file_name, 'base' AS template_id, '1' AS sidecar_version,
         '0000000000000000' AS workbook_hash, CAST(NULL AS VARCHAR) AS qa_member1, CAST(NULL AS VARCHAR) AS qa_member2,
         '2026-01-01T00:00:00' AS processing_timestamp, '2026-01-01' AS date_to_db, 'template' AS extraction_method
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""


def reference_tables(spark, sf_dir):
    """Link rows from orders (many per device) and systems from suppliers."""
    link = table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("Qampr"),
        (F.col("o_orderkey") % 50).alias("Hospital_ID"), (F.col("o_orderkey") % 130).alias("System_ID"),
        F.col("o_orderkey").alias("load_order"),
    )
    systems = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ID"), F.col("s_nationkey").cast("double").alias("System_Info_ID"),
        F.col("s_suppkey").alias("load_order"),
    )
    return link, systems


_RESOLVED_SQL = """
link AS (SELECT o_custkey AS k, arg_min(o_orderkey, o_orderkey) % 50 AS hospital_id, arg_min(o_orderkey, o_orderkey) % 130 AS system_id
         FROM orders GROUP BY 1),
seen AS (SELECT c_custkey, CASE c_custkey % 10 WHEN 3 THEN NULL WHEN 4 THEN 'unknown' ELSE CAST(c_custkey AS VARCHAR) || '.0' END AS qampr FROM customer)
"""


def _customer_visits(spark, sf_dir):
    kind = F.col("c_custkey") % 10
    number = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(kind == 4, "unknown").when(kind != 3, number).alias("qampr"))


@query("resolve_references", f"""
WITH {_RESOLVED_SQL}
SELECT c_custkey, qampr, link.hospital_id, link.system_id, CAST(s_nationkey AS BIGINT) AS system_info_id,
       CASE WHEN TRY_CAST(qampr AS DOUBLE) IS NULL THEN 'ReferenceResolutionSkipped' WHEN link.k IS NULL THEN 'ReferenceResolutionNoMatch'
            ELSE 'ReferencesResolved' END AS resolution
FROM seen LEFT JOIN link ON link.k = TRY_CAST(qampr AS DOUBLE) LEFT JOIN supplier ON s_suppkey = link.system_id
""")
def resolve_references(spark, sf_dir):
    """Site, system and system info by device number; the first link row wins."""
    link, systems = reference_tables(spark, sf_dir)
    return visits.resolve_references(_customer_visits(spark, sf_dir), link, systems, "load_order")


@query("resolve_from_folder", f"""
WITH {_RESOLVED_SQL}
SELECT c_custkey, qampr, link.hospital_id, link.system_id, CAST(s_nationkey AS BIGINT) AS system_info_id,
       CASE WHEN TRY_CAST(qampr AS DOUBLE) IS NULL THEN 'ReferenceResolutionSkipped' WHEN link.k IS NULL THEN 'ReferenceResolutionNoMatch'
            ELSE 'ReferencesResolved' END AS resolution
FROM seen LEFT JOIN link ON link.k = TRY_CAST(qampr AS DOUBLE) LEFT JOIN supplier ON s_suppkey = link.system_id
""")
def resolve_from_folder(spark, sf_dir):
    """The same from text files: of many link rows of a device the first in file order wins."""
    root = scratch_path(spark, "static")
    link, systems = reference_tables(spark, sf_dir)
    writers.write_text(link.orderBy("load_order").drop("load_order"), f"{root}/Linktable.txt")
    writers.write_text(systems.drop("load_order"), f"{root}/System.txt")
    return resolve_folder(_customer_visits(spark, sf_dir), root)


@query("incremental_reference_load", """
SELECT c_custkey AS "ID", c_name, c_acctbal FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT c_custkey, upper(c_name), c_acctbal + 1 FROM customer WHERE c_custkey % 3 <> 0
""")
def incremental_reference_load(spark, sf_dir):
    """Rows with unknown ids are appended, known ids keep their stored row."""
    customer = table(spark, sf_dir, "customer")
    stored = customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("ID"), "c_name", "c_acctbal")
    incoming = customer.select(
        F.col("c_custkey").alias("ID"), F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return visits.merged_reference(incoming, stored)


@query("first_match", """
SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1
""")
def first_match(spark, sf_dir):
    """First row of each key in load order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return numbering.first_per_key(orders, ["o_custkey"], ["o_orderkey"])


@query("visit_attributes", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderpriority ELSE 'yearly' END AS type,
       CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_test,
       CASE WHEN o_orderkey % 4 = 0 THEN 'first' WHEN o_orderkey % 4 = 1 THEN 'Dr ' || o_orderstatus END AS qa_member1,
       CASE WHEN o_orderkey % 4 = 2 THEN 'second' WHEN o_orderkey % 4 < 2 THEN 'Dr ' || o_orderpriority END AS qa_member2
FROM orders
""")
def visit_attributes(spark, sf_dir):
    """Type, date and members from fields, from the list of physicians, or by default."""
    key = F.col("o_orderkey")
    doctors = F.to_json(F.array(
        F.struct(F.concat(F.lit("Dr "), F.col("o_orderstatus")).alias("nom"), F.lit("1").alias("riziv")),
        F.struct(F.concat(F.lit("Dr "), F.col("o_orderpriority")).alias("nom"), F.lit("2").alias("riziv"))))
    fields = F.create_map(
        F.lit("test_type"), F.when(key % 3 == 0, F.col("o_orderstatus")).otherwise(""),
        F.lit("type_test"), F.when(key % 3 == 1, F.col("o_orderpriority")),
        F.lit("visit_date"), F.when(key % 2 == 0, F.col("o_orderdate").cast("date").cast("string")),
        F.lit("qa_members"), F.when(key % 4 == 0, "first"),
        F.lit("qa_member2"), F.when(key % 4 == 2, "second"),
        F.lit("physiciens"), F.when(key % 4 < 2, doctors))
    own = visits.visit_attributes(F.col("fields"), "yearly")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", fields.alias("fields"))
    return rows.select("o_orderkey", *[c.alias(n) for n, c in own.items()])


@query("visit_validity", """
WITH t AS (SELECT o_orderkey, o_orderkey % 4 AS qaid, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'base' END AS template_id,
                  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS excel_file_name, 5 - o_custkey AS hospital_id FROM orders)
SELECT *, qaid <> 0 AND template_id <> '' AND excel_file_name IS NOT NULL AS is_valid,
       CASE WHEN qaid <> 0 AND template_id <> '' AND excel_file_name IS NOT NULL AND hospital_id < 0
            THEN 'invalid hospital id: ' || CAST(hospital_id AS VARCHAR) END AS warning
FROM t
""")
def visit_validity(spark, sf_dir):
    """Required attributes and a warning on odd site ids."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (key % 4).alias("qaid"), F.when(key % 7 == 0, "").otherwise("base").alias("template_id"),
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("excel_file_name"), (5 - F.col("o_custkey")).alias("hospital_id"))
    return visits.with_validity(rows)


@query("visit_year", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y') ELSE '2021' END AS year
FROM orders
""")
def visit_year_query(spark, sf_dir):
    """Partition year from both date spellings, else from the processing stamp."""
    key, day = F.col("o_orderkey") % 4, F.col("o_orderdate").cast("date")
    written = F.when(key == 0, F.date_format(day, "yyyy-MM-dd")).when(key == 1, F.date_format(day, "dd/MM/yyyy")).when(key == 2, "soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", visit_year(written, F.lit("2021-05-06T07:08:09")).alias("year"))


@query("visit_id_assign", """
SELECT source_path, row_number() OVER (ORDER BY string_split(source_path, '/')) AS qaid
FROM (SELECT '/in/' || ['a', 'a-b', 'a/b', 'a b', 'a.b'][1 + o_custkey % 5] || '/' || o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR) || '.xlsm' AS source_path FROM orders)
""")
def visit_id_assign(spark, sf_dir):
    """Visit id = position of the file in path order: folder by folder, so ``a/b`` before ``a-b``."""
    folder = F.get(F.array(*map(F.lit, ("a", "a-b", "a/b", "a b", "a.b"))), (F.col("o_custkey") % 5).cast("int"))
    path = F.concat(F.lit("/in/"), folder, F.lit("/"), F.col("o_orderpriority"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".xlsm"))
    return numbering.visit_ids(table(spark, sf_dir, "orders").select(path.alias("source_path")))


@query("next_visit_id", """
SELECT c_name AS source_path, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_name) AS qaid FROM customer
""")
def next_visit_id(spark, sf_dir):
    """New visits are numbered after the largest stored id."""
    base = numbering.next_id_base(table(spark, sf_dir, "orders"), "o_orderkey")
    files = table(spark, sf_dir, "customer").select(F.col("c_name").alias("source_path"))
    return numbering.visit_ids(files, base=base)


@query("trace_columns", f"""
WITH {VISITS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_orderkey AS VARCHAR) AS workbook_id, 'kept' AS "Qampr", qaid AS "QAID",
       reference_qc AS "Reference_QC", excel_file_name AS "Source_File"
FROM lineitem LEFT JOIN visits ON visits.qaid = l_orderkey
""")
def trace_columns(spark, sf_dir):
    """Visit trace columns added where a table lacks them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_orderkey").cast("string").alias("workbook_id"),
        F.lit("kept").alias("Qampr"))
    return visits.add_trace(lines, order_visits(spark, sf_dir))


@query("trace_columns_batch", f"""
WITH {VISITS_SQL}
SELECT CAST(l_orderkey AS VARCHAR) AS workbook_id, l_linenumber AS v, l_partkey AS v_2, qaid AS "QAID", qampr AS "QAMPR",
       excel_file_name AS source_file, hospital_id, system_id
FROM lineitem LEFT JOIN visits ON visits.qaid = l_orderkey
""")
def trace_columns_batch(spark, sf_dir):
    """Batch trace columns overwrite a table's own; repeated names are numbered first."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("workbook_id"), F.col("l_linenumber").alias("v"),
        F.col("l_partkey").alias("v"), F.lit(-1).alias("hospital_id"))
    seen = order_visits(spark, sf_dir).select(
        "workbook_id", F.col("qaid").alias("QAID"), F.col("qampr").alias("QAMPR"),
        F.col("excel_file_name").alias("source_file"), "hospital_id", "system_id")
    return visits.add_batch_trace(lines, seen)


@query("visit_stats_total", f"""
WITH {VISITS_SQL}
SELECT (SELECT count(DISTINCT qaid) FROM visits) AS total_visits, count(DISTINCT hospital_id) AS hospital_id_count,
       count(DISTINCT system_id) AS system_id_count
FROM visits
""")
def visit_stats_total(spark, sf_dir):
    """Visits, sites and systems of the whole store."""
    seen = order_visits(spark, sf_dir)
    return stats.total_visits(seen, "qaid", "hospital_id", "system_id")


@query("visit_stats_by_hospital", f"""
WITH {VISITS_SQL} SELECT hospital_id, count(*) AS visits FROM visits WHERE hospital_id IS NOT NULL GROUP BY 1
""")
def visit_stats_by_hospital(spark, sf_dir):
    """Visits per site, most first."""
    return stats.rows_by(order_visits(spark, sf_dir), "hospital_id")


@query("visit_stats_by_system", f"""
WITH {VISITS_SQL} SELECT system_id, count(*) AS visits FROM visits GROUP BY 1
""")
def visit_stats_by_system(spark, sf_dir):
    """Visits per system, most first."""
    return stats.rows_by(order_visits(spark, sf_dir), "system_id")


@query("measurements_by_hospital", f"""
WITH {VISITS_SQL}, {LINES_SQL}
SELECT hospital_id, count(*) AS n_rows, count(DISTINCT qaid) AS visits, CAST(sum(CAST(trunc(a) AS BIGINT)) AS BIGINT) AS quantity,
       count(*) FILTER (b BETWEEN 0 AND 50000) AS price_in_limits, count(d) AS flagged
FROM li JOIN visits USING (workbook_id) GROUP BY 1
""")
def measurements_by_hospital(spark, sf_dir):
    """Cells to a typed table, traced to its visit, checked and counted per site."""
    rules = read_mapping(mapping("LI", {"data_start_row": 1, "end_row": LAST_ROW, "db_table": "lines/all", "columns": {
        "quantity": {"col": "A", "dtype": "int"}, "price": {"col": "B", "dtype": "float"}, "flag": {"col": "D"}}}))
    records = tables.table_records(line_cells(spark, sf_dir), rules.tables)
    rows = tables.typed_table(records, rules.tables[0])
    seen = order_visits(spark, sf_dir).select("workbook_id", "qaid", "hospital_id")
    return rows.join(seen, "workbook_id").groupBy("hospital_id").agg(
        F.count("*").alias("n_rows"), F.count_distinct("qaid").alias("visits"), F.sum("quantity").alias("quantity"),
        F.count_if(checks.in_range(F.col("price"), 0, 50000)).alias("price_in_limits"), F.count("flag").alias("flagged"))
