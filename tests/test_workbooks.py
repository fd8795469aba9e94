"""Real files: scan, extraction, batch job, incremental intake."""

import io
import json
import os
import zipfile
import zlib
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visitgrid.catalog import workbooks as catalog_books
from visitgrid.catalog.xlsx import make_workbook
from visitgrid import session
from visitgrid.functions import convert
from visitgrid.operators import frames, tables
from visitgrid.operators.scalars import scalar_records
from visitgrid.plans import batch, export
from visitgrid.plans.mapping import read_mapping
from visitgrid.session import materialize
from visitgrid.sources import workbooks as wb
from visitgrid.sources.tables import TableStore, read_archive, read_audit, read_reference_tables, read_text_table
from visitgrid.streaming.folder import follow_folder

from .conftest import SMALL

MAPPING = {"workbook": {"version": "6"}, "sheets": {
    "info": {"sheet_name": "Info", "required": True, "sections": {
        "qa_visit": {"db_table": "meta/visit",
                     "date_test": {"row": 1, "col": "B", "dtype": "date"},
                     "reference_QC": {"row": 2, "col": "B", "dtype": "string"},
                     "physiciens": {"data_start_row": 4, "data_end_row": 8, "col_nom": "A", "col_riziv": "B", "dtype": "list_of_dict"},
                     "pass_fail": {"row": 9, "col": "A", "dtype": "bool", "bool_map": {"Voldoet": True}}}}},
    "data": {"sheet_name": "Data", "inject_columns": {"recon_type": "std"}, "sections": {
        "noise": {"db_table": "noise/row", "data_start_row": 2, "end_condition": {"type": "empty_col", "col": "A"},
                  "metadata": {"kv": {"row": 1, "col": "D", "dtype": "float"}},
                  "columns": {"n": {"col": "A", "dtype": "int"}, "hu": {"col": "B", "dtype": "float", "locale_safe": True},
                              "limit": {"col": "C", "row": 2, "dtype": "float"}},
                  "named_results": {"mean": {"row": 9, "col": "B", "dtype": "float"}}}}},
    "hidden": {"sheet_name": "Secret", "extract": False, "sections": {"x": {"y": {"row": 1, "col": 1}}}},
}}


def book(reference="QC300_0624_01504CT-CT11"):
    info = [(1, 1, "Datum"), (1, 2, date(2024, 4, 3)), (2, 1, "Ref"), (2, 2, reference),
            (4, 1, " Jansen "), (4, 2, 123), (5, 1, "Peeters"), (7, 1, "after gap"), (9, 1, "voldoet")]
    data = [(1, 1, "n"), (1, 4, 120), (2, 1, 1), (2, 2, "1,5"), (2, 3, 4), (3, 1, 2), (3, 2, 2.25), (3, 3, 99),
            (5, 1, 4), (5, 2, 8), (9, 2, 0.5)]
    return make_workbook({"Info": info, "Data": data, "Secret": [(1, 1, "no")]}, {"kvname": "Data!$D$1", "n": "Data!$A$1:$B$2"})


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "QC300_0624_01504CT-CT11.xlsm").write_bytes(book())
    (root / "sub" / "b.xlsm").write_bytes(book(""))
    (root / "sub" / "~$b.xlsm").write_bytes(b"lock")
    (root / "sub" / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0old")
    (root / "broken.xlsm").write_bytes(book()[:300])
    (root / "c.xlsx").write_bytes(book())
    (root / "notes.txt").write_text("x")
    return str(root)


def test_folder_listing(spark, folder):
    def names(*args, **kw):
        return sorted(os.path.basename(r["source_path"]) for r in wb.workbook_files(spark, folder, *args, **kw).select("source_path").collect())

    assert names() == ["QC300_0624_01504CT-CT11.xlsm", "b.xlsm", "broken.xlsm", "c.xlsx", "old.xls", "~$b.xlsm"]
    assert names(("xlsm",), skip_locks=True) == ["QC300_0624_01504CT-CT11.xlsm", "b.xlsm", "broken.xlsm"]


def test_scan_values():
    moment = datetime(2024, 4, 3, 10, 30)
    content = make_workbook({"S": [(1, 1, 1), (1, 2, 1.0), (1, 28, "x & <y>"), (2, 1, True), (3, 1, moment), (3, 2, 1e-5), (4, 1, " ")]})
    got = {(r[2], r[3]): (r[4], r[5]) for part in wb.open_workbook(content) if part[0] == "part" for r in wb.parse_part(part[1], *part[7:]) if r[0] == "cell"}
    assert got == {
        (1, 1): ("int", "1"), (1, 2): ("float", "1.0"), (1, 28): ("text", "x & <y>"), (2, 1): ("bool", "True"),
        (3, 1): ("date", "2024-04-03 10:30:00"), (3, 2): ("float", "1e-05"), (4, 1): ("text", " "),
    }


def test_sheets_of_one_file_go_to_several_tasks(spark):
    content = make_workbook({f"S{n}": [(1, 1, f"text {n}"), (2, 2, n)] for n in range(40)})
    files = spark.createDataFrame([("/in/a.xlsx", content)], "source_path string, content binary")
    found = wb.scan_workbooks(files, {f"S{n}" for n in range(30)}).withColumn("task", F.spark_partition_id())
    cells = found.where("kind = 'cell'").collect()
    assert len(cells) == 60 and {r["raw"] for r in cells if r["col"] == 1} == {f"text {n}" for n in range(30)}
    assert len({r["task"] for r in cells}) > 4
    assert found.where("kind = 'sheet'").count() == 40 and found.where("kind = 'part'").count() == 0


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_entries_of_any_packing(method):
    plain, out = zipfile.ZipFile(io.BytesIO(book())), io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as packed:
        for name in plain.namelist():
            packed.writestr(name, plain.read(name))
    parts = [x for x in wb.open_workbook(out.getvalue(), {"Data"}) if x[0] == "part"]
    assert len(parts) == 1
    rows = list(wb.parse_part(parts[0][1], *parts[0][7:]))
    assert len(rows) == 11 and all(r[0] == "cell" for r in rows)
    sheet, strings, settings, data = parts[0][1], *parts[0][7:]
    cut = list(wb.parse_part(sheet, strings, settings, data[: len(data) // 2]))
    assert cut[-1][0] == "sheet_error"
    other = settings.replace('"checksum": ', '"checksum": 1')
    assert list(wb.parse_part(sheet, strings, other, data))[-1][5].startswith("BadZipFile")


def test_broken_sheet_keeps_the_others(spark, tmp_path):
    good = book()
    source, target = tmp_path / "g.xlsm", tmp_path / "h.xlsm"
    source.write_bytes(good)
    with zipfile.ZipFile(source) as old, zipfile.ZipFile(target, "w") as new:
        for item in old.namelist():
            data = old.read(item)
            new.writestr(item, data[: len(data) // 2] if item.endswith("sheet2.xml") else data)
    files = spark.createDataFrame([("p", target.read_bytes())], "source_path string, content binary")
    found = batch.extract(spark, files, read_mapping(MAPPING))
    assert found.workbooks.first()["error"] is None
    audit = {r["sheet_id"]: r["errors"] for r in found.sheet_audit.collect()}
    assert audit["info"] == [] and "ParseError" in audit["data"][0]


def test_extraction(spark, folder):
    rules = read_mapping(MAPPING, "base")
    found = batch.extract(spark, wb.workbook_files(spark, folder, ("xlsm",), skip_locks=True), rules)
    rows = found.tables["noise/row"].where(F.col("workbook_id").contains("QC300")).sort("row").collect()
    assert [(r["n"], r["hu"], r["limit"], r["kv"], r["recon_type"]) for r in rows] == [(1, 1.5, 4.0, 120.0, "std"), (2, 2.25, 4.0, 120.0, "std")]
    fields = {r["name"]: r["value"] for r in found.fields.where(F.col("workbook_id").contains("QC300")).collect()}
    assert fields == {
        "date_test": "2024-04-03", "reference_QC": "QC300_0624_01504CT-CT11", "noise.mean": "0.5",
        "physiciens": '[{"nom":"Jansen","riziv":"123"},{"nom":"Peeters","riziv":null}]',
    }
    result = found.records.where("kind = 'result_scalar'").select("value").distinct().collect()
    assert [r["value"] for r in result] == ["true"]
    seen = {os.path.basename(r["source_file"]): r for r in batch.batch_visits(found).collect()}
    assert {n: r["QAID"] for n, r in seen.items()} == {"QC300_0624_01504CT-CT11.xlsm": 1, "broken.xlsm": 2, "b.xlsm": 3}
    good, bad = seen["QC300_0624_01504CT-CT11.xlsm"], seen["broken.xlsm"]
    assert (good["QAMPR"], good["hospital_id"], good["system_id"], good["n_fields"], good["n_tables"], good["n_named_results"]) == (
        "1504", 300, 11, 4, 1, 1)
    assert (bad["extraction_status"], bad["n_fields"], bad["n_tables"]) == ("failed", 0, 0)


def test_full_visits(spark, folder):
    rules = read_mapping(MAPPING)
    found = batch.extract(spark, wb.workbook_files(spark, folder, ("xlsm",), skip_locks=True), rules)
    link = spark.createDataFrame([("01504", 7, 8, 1), ("1504", 9, 9, 2)], "Qampr string, Hospital_ID long, System_ID long, n int")
    systems = spark.createDataFrame([("8", 80, 1)], "ID string, System_Info_ID long, n int")
    rows = {r["excel_file_name"]: r for r in batch.full_visits(found, rules, link, systems, "n", base=10, default_type="jaarlijks").collect()}
    visit = rows["QC300_0624_01504CT-CT11.xlsm"]
    assert (visit["qaid"], visit["hospital_id"], visit["system_id"], visit["system_info_id"]) == (11, 7, 8, 80)
    assert (visit["qa_member1"], visit["qa_member2"], visit["type"], visit["date_test"]) == ("Jansen", "Peeters", "jaarlijks", "2024-04-03")
    assert rows["b.xlsm"]["resolution"] == "ReferenceResolutionSkipped"


def test_batch_job(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    report = batch.run_batch(spark, folder, read_mapping(MAPPING), f"{out}/text", f"{out}/parquet", f"{out}/report.csv")
    status = sorted((r["status"], r["access_export_ok"], r["parquet_export_ok"]) for r in report.collect())
    assert status == [("failed", False, False), ("success", True, True), ("success", True, True)]
    table = spark.read.parquet(f"{out}/parquet/tables/noise_row.parquet")
    assert table.count() == 4 and {"QAID", "QAMPR", "source_file", "hospital_id", "system_id"} <= set(table.columns)
    assert spark.read.option("header", True).csv(f"{out}/report.csv").count() == 3
    assert os.path.isdir(f"{out}/text/Extracted_Tables/noise_row.txt")


def test_full_export(spark, folder, tmp_path):
    rules = read_mapping(MAPPING)
    found = batch.extract(spark, wb.workbook_files(spark, folder, ("xlsm",), skip_locks=True), rules)
    link = spark.createDataFrame([("1504", 7, 8, 1)], "Qampr string, Hospital_ID long, System_ID long, n int")
    systems = spark.createDataFrame([("8", 80, 1)], "ID string, System_Info_ID long, n int")
    visits = materialize(batch.full_visits(found, rules, link, systems, "n"), "visits")
    log = batch.run_audit(found, batch.batch_visits(found), rules)
    parquet, text, archive = (str(tmp_path / n) for n in ("parquet", "text", "archive"))
    for _ in range(2):  # the same files again: nothing is doubled
        export.export_parquet(found, visits, parquet)
        paths = export.export_text(found, visits, text)
        export.export_archive(found, visits, log, archive)
        export.export_audit(log, TableStore(spark, str(tmp_path / "store")), parquet, text)

    stored = spark.read.parquet(f"{parquet}/visits")
    assert sorted((r["year"], r["hospital"], r["system"]) for r in stored.select(
        *[F.col(c).cast("string") for c in ("year", "hospital", "system")]).collect()) == [
        ("2024", "7", "8"), ("2024", "unknown", "unknown")]
    assert spark.read.parquet(f"{parquet}/tables/noise__row").where("qaid is not null").count() == 4
    assert spark.read.parquet(f"{parquet}/noise_noise__row").count() == 4  # the routed copy
    assert spark.read.parquet(f"{parquet}/noise_fields").columns == ["workbook_id", "noise.mean", "qaid", "batch"]
    assert spark.read.parquet(f"{parquet}/extraction_audit").groupBy("event_type").count().count() == 2
    assert sorted(os.path.relpath(p, text) for p in paths) == [
        "Extracted_Tables/meta__visit.txt", "Extracted_Tables/noise__row.txt", "Metadata/Extracted_Fields.txt",
        "Metadata/Extraction_Metadata.txt", "Metadata/Named_Results.txt", "Metadata/QAVisit.txt", "Metadata/Scalar_Records.txt"]
    single = read_text_table(spark, f"{text}/Extracted_Tables/meta__visit.txt").where("Source_File like 'QC300%'").first()
    assert (single["date_test"], single["pass_fail"], single["Qampr"]) == ("2024-04-03", "true", "1504")
    back = read_archive(spark, f"{archive}/result/noise__row", "row int, n bigint, hu double").collect()
    assert sorted((r["row"], r["n"], r["hu"]) for r in back) == [(2, 1, 1.5), (2, 1, 1.5), (3, 2, 2.25), (3, 2, 2.25)]
    assert spark.read.json(f"{archive}/audit").where("qaid is null").count() == 0
    assert read_audit(TableStore(spark, str(tmp_path / "store"))).count() == log.count()


def test_reference_folder(spark, tmp_path):
    (tmp_path / "System.txt").write_text('ID,System_Info_ID,open_date\n1,10,01/02/2020\n2,,\n')
    (tmp_path / "Linktable.txt").write_text('Qampr,note\n"0150","say ""x"", ok"\n')
    (tmp_path / "other.csv").write_text("a\n1\n")
    found = read_reference_tables(spark, str(tmp_path))
    assert sorted(found) == ["Linktable", "System"]
    assert dict(found["System"].dtypes) == {"ID": "double", "System_Info_ID": "double", "open_date": "timestamp_ntz"}
    assert tuple(found["Linktable"].first()) == (150.0, 'say "x", ok')


def test_defined_name(spark, folder):
    scan = wb.scan_workbooks(wb.workbook_files(spark, folder, ("xlsx",)))
    rules = read_mapping({"sheets": {"Data": {"fields": {
        "kv": {"name": "kvname", "dtype": "float"}, "none": {"name": "zzz"}, "area": {"name": "n"}, "empty": {"row": None, "col": "A", "default": "d"}}}}})
    rows = scalar_records(wb.workbooks(scan), wb.cells(scan), rules.scalars, wb.defined_names(scan)).collect()
    assert {r["name"]: r["value"] for r in rows} == {"kv": "120.0", "none": None, "area": None, "empty": "d"}


def test_incremental_intake(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "cells"), str(tmp_path / "checkpoint")
    follow_folder(spark, folder, target, checkpoint).awaitTermination(120)
    first = spark.read.parquet(target).where("kind = 'sheet'").count()
    with open(f"{folder}/new.xlsm", "wb") as handle:
        handle.write(book())
    follow_folder(spark, folder, target, checkpoint).awaitTermination(120)
    assert first == 9 and spark.read.parquet(target).where("kind = 'sheet'").count() == 12


def test_sheets_of_plain_cells_are_read_as_the_xml_parser_reads_them(spark):
    """All spellings of numbers, empty rows and cells, and sheets that need the parser from
    their beginning, their middle or their end."""
    moment = datetime(2020, 1, 2, 3, 4)
    numbers = [1, -3, 0, 1.0, 0.1, 1e-5, 2.5e-7, 1e20, -0.0, 0.1 + 0.2, 100.0, 1e15, 1234567890.5, 12345678901234567, True, False, moment, "x & y", "x"]
    many = [(r, c, v) for r in range(1, 400, 2) for c, v in enumerate(numbers, start=1)]

    def sheet(body):
        return f'<worksheet xmlns="{wb._SPACE[1:-1]}"><sheetData>{body}</sheetData></worksheet>'

    plain = '<row r="1"/><row r="2" spans="1:2"><c r="A2" s="1"/><c r="B2" s="1"><v>43831</v></c></row><row r="9"></row><row r="10"><c r="AB10"><v>007.50</v></c></row>'
    bodies = [
        plain, "", plain + '<row r="11"><c r="A11"><f>1+1</f><v>2</v></c></row>', plain + '<row r="11"><c r="A11" t="s"><v>7</v></c></row>',
        plain + '<row r="11"><c r="A11"><v>1</v></c>', plain + '<!-- <row r="3"><c r="A3"><v>1</v></c></row> -->', plain + '<row><c><v>1</v></c></row>',
    ]
    parts = [(r[1], r[7], r[8], r[9]) for r in wb.open_workbook(make_workbook({"S": many, "E": []})) if r[0] == "part"]
    settings = '{"styles": {"1": "date"}, "base_1904": false, "method": 0, "checksum": %d}'
    for body in bodies:
        data = sheet(body).encode()
        parts += [("S", ["x"], settings % zlib.crc32(data), data), ("S", ["x"], settings % 1, data)]
    for part in parts:
        names = ("kind", "sheet", "row", "col", "ctype", "raw", "name")
        found = [tuple(row[n] for n in names) for t in wb.part_tables(*part) for row in t.to_pylist()]
        assert found == list(wb.parse_part(*part))
    name, strings, settings, data = parts[0]
    known = json.loads(settings)
    styles = {int(k): v for k, v in known["styles"].items()}
    assert sum(t.num_rows for t in wb._plain_rows(wb._Inflated(data, known["method"], known["checksum"]), strings, styles, False)) == len(many)


def test_scan_by_row_holds_the_cells_of_a_scan(spark, folder):
    """A row whose cells do not stand from left to right comes in several pieces."""
    def sheet(body):
        return f'<worksheet xmlns="{wb._SPACE[1:-1]}"><sheetData>{body}</sheetData></worksheet>'.encode()

    odd = sheet('<row r="1"><c r="B1"><v>2</v></c><c r="A1"><v>1</v></c><c r="A1"><v>3</v></c></row><row r="1"><c r="C1"><v>4</v></c></row>')
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(make_workbook({"S": [(1, 1, 1)]}))) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            new.writestr(name, odd if name.endswith("sheet1.xml") else old.read(name))
    more = spark.createDataFrame([("/odd.xlsx", bytearray(out.getvalue())), (None, bytearray(book()))], "source_path string, content binary")
    files = wb.workbook_files(spark, folder).unionByName(more)
    flat, packed = wb.scan_workbooks(files), wb.scan_workbooks(files, by_row=True)
    assert packed.where("kind = 'cell'").count() == 0 and packed.where("workbook_id = '/odd.xlsx' and kind = 'row'").count() == 3
    assert sorted(map(repr, wb.cells(packed).collect())) == sorted(map(repr, wb.cells(flat).collect()))
    rest = [sorted(map(repr, x.where("kind not in ('cell', 'row')").drop("cells").collect())) for x in (flat, packed)]
    assert rest[0] == rest[1] and any("error" in r for r in rest[0])


def test_given_lines_leave_their_builder_a_file_at_a_time(spark):
    """So that a task holds one file and not those of a whole batch of groups."""
    plan = catalog_books.line_files(spark, SMALL)._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "MapInArrow" in plan


def _odd_book(names):
    """A workbook with a row that stands too late, a gap, and rows that need the XML parser."""
    def sheet(body):
        return f'<worksheet xmlns="{wb._SPACE[1:-1]}"><sheetData>{body}</sheetData></worksheet>'.encode()

    def row(n, *cells):
        return f'<row r="{n}">' + "".join(f'<c r="{c}{n}"{kind}><v>{v}</v></c>' for c, kind, v in cells) + "</row>"

    bodies = {
        "gap": [row(1, ("A", "", 1), ("B", "", 2)), row(2, ("A", "", 3)), row(4, ("A", "", 5), ("C", ' t="s"', 0))],
        "late": [row(1, ("A", "", 1)), row(3, ("A", "", 3)), row(2, ("A", "", 2)), row(4, ("B", "", 4)), row(5, ("A", "", 5))],
        "twice": [row(1, ("A", "", 1)), row(1, ("B", "", 2)), row(2, ("B", "", 7)), row(3, ("A", "", 1))],
        "begins": [row(2, ("A", "", 1)), row(3, ("A", "", 2))],
        "parser": [row(1, ("A", "", 1)), '<row r="2"><c r="A2"><f>1</f><v>2</v></c></row>', row(4, ("A", "", 3))],
        "none": ['<row r="1"><c r="A1"/></row>'], "index": [row(1, ("A", ' t="s"', 9))],
    }
    out = io.BytesIO()
    blank = make_workbook({n: [(1, 1, t)] for n, t in zip(names, "uvwxyz")})
    with zipfile.ZipFile(io.BytesIO(blank)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            at = name.removeprefix("xl/worksheets/sheet").removesuffix(".xml")
            new.writestr(name, sheet("".join(bodies[names[int(at) - 1]])) if at.isdigit() else old.read(name))
    return out.getvalue()


def test_plain_sheets_of_a_batch_are_read_together(spark):
    """Sheets of several workbooks in one pass, each with the strings of its own workbook; a
    sheet that needs the parser leaves those beside it alone or takes them along."""
    books = [_odd_book(["gap", "late", "parser"]), _odd_book(["none", "begins"]), book(), make_workbook({"S": [(1, 1, "a"), (1, 2, "b"), (2, 2, "a")]})]
    rows = [r for b in books for r in wb.open_workbook(b) if r[0] == "part"]

    def read(rows):
        parts = pa.RecordBatch.from_pydict({
            "strings": pa.array([r[7] for r in rows], pa.list_(pa.string())), "settings": [r[8] for r in rows], "data": pa.array([r[9] for r in rows], pa.binary())})
        return list(wb.plain_sheets(parts))

    found = read(rows)
    assert max(len(places) for places, _ in found) > 3 and sum(len(places) for places, _ in found) == len(rows) - 1
    for places, cells in found:
        want = [(n, *c[2:6]) for n, at in enumerate(places) for c in wb.parse_part(rows[at][1], *rows[at][7:])]
        assert [tuple(c[k] for k in ("sheet_no", "row", "col", "ctype", "raw")) for c in cells.to_pylist()] == want
    bad = [r for r in wb.open_workbook(_odd_book(["index", "gap"])) if r[0] == "part"]
    assert read(bad) == [] and read([]) == []


def test_shared_strings_are_read_as_the_xml_parser_reads_them():
    texts = ["", " a ", "x & y", "<", "é€\U0001f600", "a\nb", "]]>"]
    for some in ([], texts[:2], texts[4:5], texts):
        with zipfile.ZipFile(io.BytesIO(make_workbook({"S": [(n + 1, 1, t) for n, t in enumerate(some)]}))) as made:
            assert wb._shared_strings(made) == some
            assert (wb._plain_strings(made.read("xl/sharedStrings.xml")) is None) == (some == texts)
    for odd in (b"<sst><si><t>a</t></si>", b"<sst><si><r><t>a</t></r></si></sst>", b'<?xml version="1.0" encoding="latin-1"?><sst></sst>', b"<sst a><si><t>a</t></si></sst>"):
        assert wb._plain_strings(odd) is None


def test_tables_of_rows_are_those_of_cells(spark):
    """With tables that end at a blank cell, at a label or at a fixed row, and fixed cells."""
    books = [("/a.xlsx", bytearray(_odd_book(["gap", "late", "twice"]))), ("/b.xlsx", bytearray(_odd_book(["parser", "begins", "none"]))),
             ("/b.xlsx", bytearray(_odd_book(["twice", "gap", "parser"])))]
    files = spark.createDataFrame(books, "source_path string, content binary")
    empty = {"end_condition": {"type": "empty_col", "col": "A"}}
    sections = {
        "plain": {"db_table": "t/plain", "data_start_row": 1, "end_row": 9, "columns": {"a": {"col": "A"}, "b": {"col": "B"}}},
        "blank": {"db_table": "t/blank", "data_start_row": 1, **empty, "columns": {"a": {"col": "A"}, "c": {"col": "C"}}},
        "second": {"db_table": "t/second", "data_start_row": 2, **empty, "columns": {"a": {"col": "A"}}},
        "fixed": {"db_table": "t/fixed", "data_start_row": 1, **empty, "columns": {"a": {"col": "A"}, "late": {"col": "A", "row": 4}}},
    }
    names = ("gap", "late", "twice", "parser", "begins", "none")
    for some in (list(sections), list(sections)[:3]):
        rules = read_mapping({"workbook": {"version": "1"}, "sheets": {n: {"sheet_name": n, "sections": {k: sections[k] for k in some}} for n in names}})
        flat, packed = wb.cells(wb.scan_workbooks(files)), wb.rows(wb.scan_workbooks(files, by_row=True))
        want, found = (sorted(map(repr, tables.table_records(x, rules.tables, rules.scalars).collect())) for x in (flat, packed))
        assert want == found and len(found) > 20


def test_a_row_is_looked_up_once(spark):
    """The condition that drops rows without a cell must not repeat the look-ups."""
    rows = spark.createDataFrame([], f"workbook_id string, sheet string, row int, cells {dict(spark.createDataFrame([], wb.ROW_SCHEMA).dtypes)['cells']}")
    rules = catalog_books.batch_rules()
    plan = tables.table_records(rows, rules.tables, rules.scalars)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position") == 5


def test_days_by_the_short_way_are_those_of_the_long_way(spark):
    texts = ["2020-02-29 00:00:00", "2021-02-29 00:00:00", "2020-01-02 03:04:05", "2020-01-02", "2020-13-02", "2020-01-02\n", "0001-01-01", "1/2/2020",
             "3 mar 2020", "43831", "0.5", "60", "-1", "True", "false", "nvt", "", " ", None]
    kinds = ["date", "text", "int", "float", "bool", "time", None]
    rows = spark.createDataFrame([(t, k) for t in texts for k in kinds], "raw string, ctype string")
    both = rows.select(convert.to_date(F.col("raw"), F.col("ctype")).alias("now"), convert._temporal_text(F.col("raw"), F.col("ctype"), False).alias("long"))
    assert [r for r in both.collect() if r["now"] != r["long"]] == []
    short = rows.select(convert.to_date(F.col("raw"), F.col("ctype")))._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" in short  # the long way is no part of the generated code


def test_rows_of_a_table_are_no_single_file(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 10)
    kept = materialize(spark.range(45).withColumn("t", F.lit(1)), "files-of-rows", "t")
    assert kept.count() == 45 and len(kept.inputFiles()) >= 5


def test_ids_are_broadcast_if_they_are_found_to_be_small(spark, monkeypatch):
    ids = materialize(spark.range(100), "small-ids")
    assert "broadcast" in frames.measured(ids)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(frames, "MAX_RULE_BYTES", 100)
    assert "broadcast" not in frames.measured(ids)._jdf.queryExecution().analyzed().toString()


def test_files_are_built_after_one_shuffle_of_the_lines(spark):
    plan = catalog_books.line_files(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
