"""Queries on workbook files built from the given lines: scan, tables, visits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..operators import audit, stats
from ..operators.tables import table_records, typed_table
from ..plans import batch, export
from ..plans.mapping import LAST_ROW, read_mapping
from ..session import materialize, scratch_path
from ..sources import tables as readers
from ..sources import workbooks as wb
from ..streaming.folder import Intake
from . import query
from .inputs import LINES_SQL, combined_lines, table
from .visiting import reference_tables
from .xlsx import pack_workbook

ORDERS_PER_BOOK = 100


_INFO = (
    '<row r="1"><c r="A1" t="s"><v>{first}</v></c><c r="B1"><v>{number}</v></c></row>'
    '<row r="2"><c r="B2" t="s"><v>{second}</v></c></row>'
)


def _line_xml(row: Column) -> Column:
    """A line as a row of sheet XML; blank flags, statuses and days have no cell."""

    def cell(letter: str, value: Column, attributes: str = "") -> Column:
        return F.concat(F.lit(f'<c r="{letter}'), row, F.lit(f'"{attributes}><v>'), value.cast("string"), F.lit("</v></c>"))

    def where_filled(given: Column, made: Column) -> Column:
        return F.when(given.isNotNull(), made).otherwise("")

    flag = F.when(F.col("d") != "N", F.ascii("d"))
    cells = [
        *[cell(letter, F.col(name)) for letter, name in zip("ABC", "abc")],
        where_filled(flag, cell("D", flag, ' t="s"')),
        where_filled(F.col("e"), cell("E", F.ascii("e"), ' t="s"')),
        where_filled(F.col("f"), cell("F", F.date_diff("f", F.lit("1899-12-30").cast("date")), ' s="1"')),
        cell("G", (F.col("a") > 25).cast("int"), ' t="b"'),
    ]
    xml = F.concat(F.lit('<row r="'), row, F.lit('">'), *cells, F.lit("</row>"))
    return F.coalesce(xml, F.raise_error(F.lit("a line without a number, quantity, price or discount")).cast("string"))


def line_files(spark, sf_dir):
    """One .xlsm file per 100 orders; an order has as many rows as the largest line number.

    Every 13th file is cut short, so that it cannot be read.
    """
    lines = table(spark, sf_dir, "lineitem")
    stride = lines.agg(F.coalesce(F.max("l_linenumber"), F.lit(1))).first()[0]
    book = F.floor(F.col("l_orderkey") / ORDERS_PER_BOOK)
    row = (F.pmod("l_orderkey", F.lit(ORDERS_PER_BOOK)) * stride + F.col("l_linenumber")).cast("int")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = (
        combined_lines(lines.withColumn("book", book).repartition(tasks, "book"), "book", "l_orderkey", "l_linenumber")
        .withColumn("row", row)  # the number of tasks is not coalesced: building and parsing files is CPU work
        .select("book", "row", F.ascii("d").alias("d"), F.ascii("e").alias("e"), _line_xml(F.col("row").cast("string")).alias("xml"))
        .sortWithinPartitions("book", "row", "xml")
    )

    def file(number: int, body: str, codes: set[int]) -> pa.RecordBatch:
        # flags and statuses stand at the code of their letter, two texts more after them
        letters = [chr(code) if code in codes else "" for code in range(max(codes, default=-1) + 1)]
        info = _INFO.format(number=number, first=len(letters), second=len(letters) + 1)
        strings = [*letters, "centre", "QA 0%d CT" % number]
        content = pack_workbook({"LI": body, "Info": info}, strings, {"ref": "Info!$B$2"}, level=1)
        name = f"/in/QC{number % 9 + 1:03d}_0624_{number:05d}CT-CT{number % 5}.xlsm"
        content = content[: len(content) // 2] if number % 13 == 12 else content
        return pa.RecordBatch.from_pydict({"source_path": [name], "content": [content]})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A file at a time, so that a task holds one input batch and one file."""
        number, bodies, codes = None, [], set()
        for found in batches:
            ends = pc.run_end_encode(found.column("book")).run_ends.to_pylist()
            for begin, end in zip([0, *ends], ends):
                own = found.slice(begin, end - begin)
                if own["book"][0].as_py() != number:
                    if bodies:
                        yield file(number, "".join(bodies), codes)
                    number, bodies, codes = own["book"][0].as_py(), [], set()
                bodies.append(pc.binary_join(pa.ListArray.from_arrays([0, end - begin], own["xml"].cast(pa.string())), "")[0].as_py())
                codes.update(pc.drop_null(pa.concat_arrays([own["d"], own["e"]])).unique().to_pylist())
        if bodies:
            yield file(number, "".join(bodies), codes)

    return packed.mapInArrow(build, "source_path string, content binary")


_BOOK_SQL = f"""{LINES_SQL},
cell AS (
  SELECT CAST(workbook_id AS BIGINT) // 100 AS n, CAST(CAST(workbook_id AS BIGINT) % 100 * (SELECT max(l_linenumber) FROM lineitem) + r AS INTEGER) AS r, a, b, c, d, e, f FROM li),
book AS (
  SELECT DISTINCT n, '/in/QC' || lpad(CAST(n % 9 + 1 AS VARCHAR), 3, '0') || '_0624_' || lpad(CAST(n AS VARCHAR), 5, '0') || 'CT-CT' || CAST(n % 5 AS VARCHAR) || '.xlsm' AS path FROM cell)"""


@query("workbook_scan", f"""
WITH {_BOOK_SQL}, good AS (SELECT path AS workbook_id, r AS "row", cell.* EXCLUDE (r) FROM cell JOIN book USING (n) WHERE n % 13 <> 12)
SELECT workbook_id, 'LI' AS sheet, "row", 1 AS col, 'float' AS ctype, CAST(a AS VARCHAR) AS raw FROM good
UNION ALL SELECT workbook_id, 'LI', "row", 2, 'float', CAST(b AS VARCHAR) FROM good
UNION ALL SELECT workbook_id, 'LI', "row", 3, 'float', CAST(c AS VARCHAR) FROM good
UNION ALL SELECT workbook_id, 'LI', "row", 4, 'text', d FROM good WHERE d IS NOT NULL
UNION ALL SELECT workbook_id, 'LI', "row", 5, 'text', e FROM good
UNION ALL SELECT workbook_id, 'LI', "row", 6, 'date', f || ' 00:00:00' FROM good
UNION ALL SELECT workbook_id, 'LI', "row", 7, 'bool', CASE WHEN a > 25 THEN 'True' ELSE 'False' END FROM good
""")
def workbook_scan(spark, sf_dir):
    """All cells of one sheet of every readable file."""
    scan = wb.scan_workbooks(line_files(spark, sf_dir), ["LI"])
    return wb.cells(scan)


@query("workbook_list", f"""
WITH {_BOOK_SQL}
SELECT path AS source_path, regexp_extract(path, '([^/]+)$', 1) AS source_filename, CASE WHEN n % 13 = 12 THEN '' ELSE 'LI|Info' END AS sheet_list,
       CASE WHEN n % 13 = 12 THEN substr(sha256(''), 1, 16) ELSE substr(sha256('LI|Info'), 1, 16) END AS workbook_hash, n % 13 = 12 AS failed
FROM book
""")
def workbook_list(spark, sf_dir):
    """Files with their sheet lists and fingerprints; a broken file is one failed row."""
    books = wb.workbooks(wb.scan_workbooks(line_files(spark, sf_dir), []))
    return books.select("source_path", "source_filename", F.array_join("sheets", "|").alias("sheet_list"), "workbook_hash",
                        F.col("error").isNotNull().alias("failed"))


def batch_rules(spare: bool = False):
    optional = {"spare": {"sheet_name": "Optional", "required": False, "sections": {"x": {"y": {"row": 1, "col": 1}}}}} if spare else {}
    return read_mapping({"workbook": {"version": "3"}, "sheets": {
        "info": {"sheet_name": "Info", "sections": {
            "qa_visit": {"db_table": "meta/visit", "reference_QC": {"row": 2, "col": "B"}, "centrum_nummer": {"row": 1, "col": "B", "dtype": "int"}}}},
        "lines": {"sheet_name": "LI", "inject_columns": {"source": "scan"}, "sections": {
            "all": {"db_table": "lines/all", "data_start_row": 1, "end_row": LAST_ROW, "columns": {
                "qty": {"col": "A", "dtype": "float"}, "flag": {"col": "D"}, "shipped": {"col": "F", "dtype": "date"},
                "large": {"col": "G", "dtype": "bool"}},
                "named_results": {"first_price": {"row": 1, "col": "B", "dtype": "float"}}},
            "head": {"db_table": "lines/head", "columns": {"price": {"col": "B", "dtype": "int"}}}}},
        "gone": {"sheet_name": "Absent", "required": True, "sections": {"x": {"y": {"row": 1, "col": 1}}}},
        **optional,
        "off": {"sheet_name": "Off", "extract": False},
    }})


@query("workbook_tables", f"""
WITH {_BOOK_SQL}
SELECT path AS workbook_id, r AS "row", a AS qty, d AS flag, f AS shipped, a > 25 AS large, 'scan' AS source
FROM cell JOIN book USING (n) WHERE n % 13 <> 12
""")
def workbook_tables(spark, sf_dir):
    """Files to one typed table."""
    rules = batch_rules()
    rows = wb.rows(wb.scan_workbooks(line_files(spark, sf_dir), ["LI"], by_row=True))
    wanted = [t for t in rules.tables if t["table_key"] == "lines/all"]
    records = table_records(rows, wanted, rules.scalars)
    return typed_table(records, wanted[0], rules.scalars, {"source": "scan"})


def _extraction(spark, sf_dir):
    return batch.extract(spark, line_files(spark, sf_dir), batch_rules())


@query("workbook_visits", f"""
WITH {_BOOK_SQL}, head AS (SELECT n, count(*) FILTER (r = 1) > 0 AS has_first FROM cell GROUP BY 1)
SELECT row_number() OVER (ORDER BY path) AS "QAID", CAST(n AS VARCHAR) AS "QAMPR", path AS source_file,
       n % 9 + 1 AS hospital_id, n % 5 AS system_id, CASE WHEN n % 13 = 12 THEN 'failed' ELSE 'success' END AS extraction_status,
       CAST(CASE WHEN n % 13 = 12 THEN 0 ELSE 3 END AS BIGINT) AS n_fields,
       CAST(CASE WHEN n % 13 = 12 THEN 0 ELSE 1 + CAST(has_first AS INTEGER) END AS BIGINT) AS n_tables,
       CAST(CASE WHEN n % 13 = 12 THEN 0 ELSE 1 END AS BIGINT) AS n_named_results
FROM book JOIN head USING (n)
""")
def workbook_visits(spark, sf_dir):
    """Visits of the whole batch, failed files included."""
    return batch.batch_visits(_extraction(spark, sf_dir)).drop("workbook_id", "error")


@query("workbook_audit", f"""
WITH {_BOOK_SQL}, head AS (SELECT n, path, count(*) FILTER (r = 1) > 0 AS has_first FROM cell JOIN book USING (n) WHERE n % 13 <> 12 GROUP BY 1, 2)
SELECT path AS workbook_id, 'info' AS sheet_id, 2::BIGINT AS fields_extracted, 0::BIGINT AS tables_extracted, 2::BIGINT AS scalar_records, 0::BIGINT AS named_results, '' AS errors, '' AS warnings, TRUE AS present, FALSE AS skipped FROM head
UNION ALL SELECT path, 'lines', 1, 1 + CAST(has_first AS INTEGER), 0, 1, '', '', TRUE, FALSE FROM head
UNION ALL SELECT path, 'gone', 0, 0, 0, 0, 'configured sheet missing: Absent', '', FALSE, FALSE FROM head
UNION ALL SELECT path, 'spare', 0, 0, 0, 0, '', 'configured sheet missing: Optional', FALSE, FALSE FROM head
UNION ALL SELECT path, 'off', 0, 0, 0, 0, '', '', FALSE, TRUE FROM head
""")
def workbook_audit(spark, sf_dir):
    """Extraction audit per configured sheet: an absent one is an error or, where it is
    optional, a warning."""
    found = batch.extract(spark, line_files(spark, sf_dir), batch_rules(spare=True))
    return found.sheet_audit.select(
        "workbook_id", "sheet_id", "fields_extracted", "tables_extracted", "scalar_records", "named_results",
        F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), "present", "skipped")


@query("extraction_stats", f"""
WITH {_BOOK_SQL}, head AS (SELECT n, path, count(*) FILTER (r = 1) > 0 AS has_first, count(*) AS n_rows,
         count(*) FILTER (r = 1) AS one FROM cell JOIN book USING (n) WHERE n % 13 <> 12 GROUP BY 1, 2),
run AS (SELECT n, count(*) AS n_head FROM (SELECT n, r, row_number() OVER (PARTITION BY n ORDER BY r) AS k FROM cell) WHERE r = k GROUP BY 1)
SELECT path AS workbook_id, 2::BIGINT AS total_sheets, 4::BIGINT AS configured_sheets, 2::BIGINT AS processed_sheets, 1::BIGINT AS errors,
       3::BIGINT AS extracted_fields, 1 + CAST(has_first AS BIGINT) AS extracted_tables, n_rows + coalesce(n_head, 0) AS total_rows,
       2::BIGINT AS extracted_scalar_records, 1::BIGINT AS extracted_named_results
FROM head LEFT JOIN run USING (n)
""")
def extraction_stats(spark, sf_dir):
    """Counts of sheets, fields, tables, rows, records and errors per file."""
    found = _extraction(spark, sf_dir)
    return stats.extraction_stats(found.workbooks.where("error is null"), found.fields, found.records, found.table_rows, found.sheet_audit)


@query("extraction_audit_rows", f"""
WITH {_BOOK_SQL}, head AS (SELECT path AS workbook_id, count(*) FILTER (r = 1) > 0 AS has_first FROM cell JOIN book USING (n) WHERE n % 13 <> 12 GROUP BY 1),
sheet(sheet, fields, tables, errors) AS (VALUES ('Info', 2, 0, 0), ('LI', 1, 1, 0), ('Absent', 0, 0, 1), ('Off', 0, 0, 0))
SELECT workbook_id, 'SheetProcessed' AS event_type, sheet, fields::BIGINT AS fields, (tables + CASE WHEN sheet = 'LI' AND has_first THEN 1 ELSE 0 END)::BIGINT AS tables,
  errors::INTEGER AS errors, NULL::BIGINT AS total_sheets, NULL::BIGINT AS processed_sheets FROM head, sheet
UNION ALL
SELECT workbook_id, 'ExtractionSummary', NULL, 3, 1 + CAST(has_first AS BIGINT), NULL, 2, 2 FROM head
""")
def extraction_audit_rows(spark, sf_dir):
    """One audit row per sheet and one per file."""
    found = _extraction(spark, sf_dir)
    totals = stats.extraction_stats(found.workbooks.where("error is null"), found.fields, found.records, found.table_rows, found.sheet_audit)
    rows = audit.sheet_audit_rows(found.sheet_audit, totals)
    return rows.select(
        "workbook_id", "event_type", "sheet", F.coalesce("fields_extracted", "extracted_fields").alias("fields"),
        F.coalesce("tables_extracted", "extracted_tables").alias("tables"), "errors", "total_sheets", "processed_sheets")


@query("folder_listing", """
WITH f AS (SELECT n_name || CASE n_nationkey % 5 WHEN 0 THEN '.xlsm' WHEN 1 THEN '.xlsx' WHEN 2 THEN '.XLS' WHEN 3 THEN '.txt' ELSE '.xlsm' END AS name, n_nationkey AS k FROM nation)
SELECT 'all' AS part, name FROM f WHERE k % 5 <> 3
UNION ALL SELECT 'all', '~$' || name FROM f WHERE k % 5 = 0
UNION ALL SELECT 'batch', name FROM f WHERE k % 5 IN (0, 4)
""")
def folder_listing(spark, sf_dir):
    """Workbooks of a folder tree by their endings, with lock files and without."""
    root = scratch_path(spark, "tree")
    names = table(spark, sf_dir, "nation").select("n_name", "n_nationkey").collect()  # a fixed table of 25 rows
    endings = (".xlsm", ".xlsx", ".XLS", ".txt", ".xlsm")
    paths = [f"{root}/{k % 2}/{k % 3}/{name}{endings[k % 5]}" for name, k in names]
    paths += [f"{root}/~${name}{endings[0]}" for name, k in names if k % 5 == 0]
    store, _ = fs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")
    for path in paths:
        at = path.split("://", 1)[-1].removeprefix("file:")
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(at) as target:
            target.write(b"x")  # empty files are not listed

    def listed(part, *options):
        return wb.workbook_files(spark, root, *options).select(F.lit(part).alias("part"), F.url_decode(base_name(F.col("source_path"))).alias("name"))

    return listed("all").unionByName(listed("batch", ("xlsm",), True))


@query("batch_audit_log", f"""
WITH {_BOOK_SQL}, s AS (SELECT count(*) AS n, count(*) FILTER (n % 13 = 12) AS bad FROM book)
SELECT 'INFO' AS level, 'ProcessingStart' AS event_type, n AS events FROM s
UNION ALL SELECT 'SUCCESS', 'ProcessingComplete', n - bad FROM s
UNION ALL SELECT 'ERROR', 'ProcessingFailed', bad FROM s WHERE bad > 0
UNION ALL SELECT 'INFO', 'ExtractionComplete', n - bad FROM s
UNION ALL SELECT 'INFO', 'BatchComplete', 1 FROM s
""")
def batch_audit_log(spark, sf_dir):
    """Events of a batch, counted by kind."""
    found = _extraction(spark, sf_dir)
    log = batch.run_audit(found, batch.batch_visits(found), batch_rules())
    return log.groupBy("level", "event_type").agg(F.count("*").alias("events"))


def mixed_rules():
    """One table that a section fills with rows and, where it has none, with a scalar."""
    return read_mapping({"workbook": {"version": "3"}, "sheets": {
        "info": {"sheet_name": "Info", "sections": {"qa_visit": {"db_table": "meta/visit", "reference_QC": {"row": 2, "col": "B"}}}},
        "lines": {"sheet_name": "LI", "sections": {"late": {
            "db_table": "lines/late", "data_start_row": 690, "end_row": LAST_ROW, "columns": {"qty": {"col": "A", "dtype": "float"}},
            "pass_fail": {"row": 8, "col": "G", "dtype": "bool"}}}},
    }})


@query("text_export_mixed", f"""
WITH {_BOOK_SQL}, good AS (SELECT regexp_extract(path, '([^/]+)$', 1) AS source_file, cell.* FROM cell JOIN book USING (n) WHERE n % 13 <> 12),
late AS (SELECT source_file, r, a FROM good WHERE r >= 690)
SELECT source_file, a::DOUBLE AS qty, CAST(NULL AS VARCHAR) AS pass_fail FROM late
UNION ALL
SELECT source_file, NULL, CAST(bool_or(a > 25) FILTER (r = 8) AS VARCHAR) FROM good WHERE source_file NOT IN (SELECT source_file FROM late) GROUP BY 1
""")
def text_export_mixed(spark, sf_dir):
    """Text export, read back, of a table that holds rows of some workbooks and a single
    value of the others."""
    root, rules = scratch_path(spark, "mixed"), mixed_rules()
    found = batch.extract(spark, line_files(spark, sf_dir), rules)
    link, systems = reference_tables(spark, sf_dir)
    export.export_text(found, batch.full_visits(found, rules, link, systems, "load_order"), root)
    back = readers.read_text_table(spark, f"{root}/Extracted_Tables/lines__late.txt")
    return back.select(F.col("Source_File").alias("source_file"), F.col("qty").cast("double").alias("qty"), "pass_fail")


@query("incremental_visits", f"""
WITH {_BOOK_SQL}, good AS (SELECT path, count(*) AS n_rows FROM cell JOIN book USING (n) WHERE n % 13 <> 12 GROUP BY 1)
SELECT CAST(n % 2 AS INTEGER) AS arrival, row_number() OVER (ORDER BY n % 2, path) AS "QAID", path AS source_file,
       CASE WHEN n % 13 = 12 THEN 'failed' ELSE 'success' END AS extraction_status, coalesce(n_rows, 0) AS n_rows,
       CASE WHEN n % 13 = 12 THEN 'ProcessingFailed,ProcessingStart' ELSE 'ExtractionComplete,ProcessingComplete,ProcessingStart' END AS events
FROM book LEFT JOIN good USING (path)
""")
def incremental_visits(spark, sf_dir):
    """Two arrivals of files, the second of them taken once more: visits with the rows and
    events stored for each.  Ids of the second arrival follow the first's."""
    root, arrived, checkpoint = (scratch_path(spark, x) for x in ("intake", "arrived", "intake-checkpoint"))
    intake, files = Intake(batch_rules(), root), materialize(line_files(spark, sf_dir), "files")
    schema = "source_path string, content binary"
    odd = F.regexp_extract("source_path", r"_(\d+)CT", 1).cast("bigint") % 2
    for number in (0, 1):
        files.where(odd == number).write.mode("append").parquet(arrived)
        intake.follow(spark.readStream.schema(schema).parquet(arrived), checkpoint).awaitTermination()
    intake.take(files.where(odd == 1), 1)  # as after a failure before the commit
    lines = spark.read.parquet(f"{root}/tables/lines__all").groupBy("qaid").agg(F.count("*").alias("n_rows"))
    log = spark.read.parquet(f"{root}/audit").where("file_name <> ''")
    log = log.groupBy("file_name").agg(F.array_join(F.array_sort(F.collect_list("event_type")), ",").alias("events"))
    seen = intake.visits(spark).withColumn("file_name", base_name(F.col("source_file")))
    return seen.join(log, "file_name").join(lines.withColumnRenamed("qaid", "QAID"), "QAID", "left").select(
        F.col("batch").alias("arrival"), "QAID", "source_file", "extraction_status", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "events")


@query("visit_archive", f"""
WITH {_BOOK_SQL}, ids AS (SELECT n, path, row_number() OVER (ORDER BY path) AS qaid, n % 13 = 12 AS bad FROM book),
good AS (SELECT n, path, row_number() OVER (ORDER BY path) AS qaid FROM book WHERE n % 13 <> 12)
SELECT 'metadata' AS part, qaid, regexp_extract(path, '([^/]+)$', 1) AS name, 1 AS number FROM good
UNION ALL
SELECT 'audit', qaid, 'ProcessingComplete', 1 FROM ids WHERE NOT bad
UNION ALL
SELECT 'lines', qaid, NULL, CAST(count(*) AS INTEGER) FROM good JOIN cell USING (n) GROUP BY ALL
UNION ALL
SELECT 'records', qaid, NULL, 3 FROM good
""")
def visit_archive(spark, sf_dir):
    """Archive of every visit, read back: metadata, events, table rows and records."""
    root, rules = scratch_path(spark, "visit-archive"), batch_rules()
    found = _extraction(spark, sf_dir)
    link, systems = reference_tables(spark, sf_dir)
    seen = batch.full_visits(found, rules, link, systems, "load_order")
    log = batch.run_audit(found, batch.batch_visits(found), rules)
    export.export_archive(found, seen, log, root)
    ids = seen.select("workbook_id", "qaid")
    one = F.lit(1).alias("number")
    metadata = spark.read.schema("qaid bigint, excel_file_name string").json(f"{root}/metadata")
    events = spark.read.schema("qaid bigint, event_type string").json(f"{root}/audit")
    parts = metadata.select(F.lit("metadata").alias("part"), "qaid", F.col("excel_file_name").alias("name"), one)
    parts = parts.unionByName(events.select(F.lit("audit").alias("part"), "qaid", F.col("event_type").alias("name"), one))
    for name, folder, field in (("lines", "lines__all", "row int"), ("records", "records", "name string")):
        rows = readers.read_archive(spark, f"{root}/result/{folder}", field).join(ids, "workbook_id").groupBy("qaid").agg(F.count("*").cast("int").alias("number"))
        parts = parts.unionByName(rows.select(F.lit(name).alias("part"), "qaid", F.lit(None).cast("string").alias("name"), "number"))
    return parts
