"""Cell-grid queries: scalars, labels, names, lists, row ranges, table pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scalars, tables
from ..operators.scalars import missing_required, scalar_records
from ..operators.visits import structure_check
from ..plans.mapping import LAST_ROW, read_mapping
from ..session import materialize
from . import query
from .inputs import EVENTS_SQL, LINES_SQL, books_of, event_cells, line_cells, long_form, mapping, table


def _scalars(cells, fields, sheet, names=None):
    rules = read_mapping({"sheets": {sheet: {"fields": fields}}})
    records = scalar_records(books_of(cells), cells, rules.scalars, names)
    return records.select("workbook_id", "name", "value")


def _table(cells, sheet, section, settings=None):
    rules = read_mapping(mapping(sheet, section, settings))
    records = tables.table_records(cells, rules.tables, rules.scalars)
    return tables.typed_table(records, rules.tables[0], rules.scalars, rules.sheets[0]["inject"])


@query("grid_scalar_lookup", f"""
WITH {LINES_SQL}
SELECT workbook_id, 'first_qty' AS name, CAST(max(CASE WHEN r = 1 THEN a END) AS VARCHAR) AS value FROM li GROUP BY 1
UNION ALL
SELECT workbook_id, 'second_price', coalesce(CAST(max(CASE WHEN r = 2 THEN b END) AS VARCHAR), '0.0') FROM li GROUP BY 1
UNION ALL
SELECT workbook_id, 'last_flag', max(CASE WHEN r = 7 THEN d END) FROM li GROUP BY 1
UNION ALL
SELECT workbook_id, 'third_whole', CAST(max(CASE WHEN r = 3 THEN CAST(trunc(a) AS BIGINT) END) AS VARCHAR) FROM li GROUP BY 1
""")
def grid_scalar_lookup(spark, sf_dir):
    """Cells at (row, column), at an address, with a default, and by an address-like name."""
    fields = {
        "first_qty": {"row": 1, "col": "A", "dtype": "float"},
        "second_price": {"locator": {"cell": "B2"}, "dtype": "float", "default": 0},
        "last_flag": {"row": 7, "col": 4, "dtype": "string"},
        "third_whole": {"name": "A3", "dtype": "int"},
    }
    return _scalars(line_cells(spark, sf_dir), fields, "LI")


@query("grid_label_search", f"""
WITH {EVENTS_SQL}, hit AS (
  SELECT workbook_id, n.name, min(r) AS r FROM ev JOIN (VALUES ('purch'), ('rror')) n(name) ON contains(a, n.name)
  GROUP BY ALL),
books AS (SELECT DISTINCT workbook_id, n.name FROM ev, (VALUES ('purch'), ('rror')) n(name))
SELECT workbook_id, name, CAST(b AS VARCHAR) AS value
FROM books LEFT JOIN hit USING (workbook_id, name) LEFT JOIN ev USING (workbook_id, r)
""")
def grid_label_search(spark, sf_dir):
    """Right neighbour of the first cell that contains a text; a blank neighbour is null."""
    fields = {"purch": {"name": "purch", "dtype": "float"}, "rror": {"name": "rror", "dtype": "float"}}
    return _scalars(event_cells(spark, sf_dir), fields, "EV")


@query("grid_label_offset", f"""
WITH {EVENTS_SQL}, hit AS (
  SELECT workbook_id, min(r) AS r FROM ev WHERE r BETWEEN 20 AND 120 AND contains(a, 'click') GROUP BY 1)
SELECT DISTINCT e.workbook_id, 'user' AS name, CAST(h.c AS VARCHAR) AS value
FROM ev e LEFT JOIN hit USING (workbook_id) LEFT JOIN ev h ON h.workbook_id = e.workbook_id AND h.r = hit.r
""")
def grid_label_offset(spark, sf_dir):
    """Label search in bounded rows, two columns to the right of the label."""
    find = {"text": "click", "start_row": 20, "end_row": 120, "offset_col": 2}
    return _scalars(event_cells(spark, sf_dir), {"user": {"locator": {"find": find}, "dtype": "int"}}, "EV")


@query("grid_defined_names", f"""
WITH {EVENTS_SQL}, hit AS (
  SELECT workbook_id, min(r) AS first_r, max(r) AS last_r FROM ev WHERE a = 'view' GROUP BY 1),
books AS (SELECT DISTINCT workbook_id FROM ev)
SELECT workbook_id, 'view' AS name, CAST(b AS VARCHAR) AS value
FROM books LEFT JOIN hit USING (workbook_id) LEFT JOIN ev ON ev.workbook_id = books.workbook_id
  AND r = CASE WHEN CAST(books.workbook_id AS BIGINT) % 2 = 0 THEN last_r ELSE first_r END
""")
def grid_defined_names(spark, sf_dir):
    """Defined name where the workbook has one (the last row of each event type), label
    search where it has not."""
    cells = event_cells(spark, sf_dir)
    even = F.col("workbook_id").cast("bigint") % 2 == 0
    names = cells.where(even & (F.col("col") == 1)).groupBy("workbook_id", "sheet", F.col("raw").alias("name")).agg(
        F.max("row").alias("row")).withColumn("col", F.lit(2))
    return _scalars(cells, {"view": {"name": "view", "dtype": "float"}}, "EV", names)


@query("grid_lists", f"""
WITH {EVENTS_SQL}, stop AS (
  SELECT workbook_id, coalesce(min(CASE WHEN b IS NULL THEN r END), 13) AS r FROM ev WHERE r <= 12 GROUP BY 1)
SELECT ev.workbook_id, 'people' AS name, '[' || coalesce(string_agg(
         '{{"nom":"' || CAST(b AS VARCHAR) || '","riziv":"' || a || '"}}', ',' ORDER BY ev.r)
         FILTER (ev.r < stop.r), '') || ']' AS value
FROM ev JOIN stop USING (workbook_id) WHERE ev.r <= 12 GROUP BY 1
UNION ALL
SELECT workbook_id, 'kinds', '[' || string_agg('"' || a || '"', ',' ORDER BY r) || ']'
FROM ev WHERE r BETWEEN 2 AND 6 GROUP BY 1
UNION ALL
SELECT workbook_id, 'kinds', '[]' FROM ev GROUP BY 1 HAVING count(*) FILTER (r BETWEEN 2 AND 6) = 0
""")
def grid_lists(spark, sf_dir):
    """Lists read down to the first blank: pairs (value, type) and plain texts."""
    fields = {
        "people": {"dtype": "list_of_dict", "data_start_row": 1, "data_end_row": 12, "col_nom": "B", "col_riziv": "A"},
        "kinds": {"dtype": "list_of_string", "data_start_row": 2, "data_end_row": 6, "col": "A"},
    }
    return _scalars(event_cells(spark, sf_dir), fields, "EV")


@query("grid_rows_fixed", f"""
WITH {LINES_SQL}
SELECT workbook_id, r AS "row", a AS qty, d AS flag FROM li WHERE r BETWEEN 2 AND 5
""")
def grid_rows_fixed(spark, sf_dir):
    """Rows of an explicit range; rows without data drop out."""
    section = {
        "data_start_row": 2, "end_row": 5,
        "columns": {"qty": {"col": "A", "dtype": "float"}, "flag": {"col": "D", "dtype": "string"}},
    }
    return _table(line_cells(spark, sf_dir), "LI", section)


@query("grid_rows_n", f"""
WITH {LINES_SQL}
SELECT workbook_id, r AS "row", d AS flag, CAST(CAST(c * 100 AS INTEGER) AS DOUBLE) / 100 AS discount
FROM li WHERE r BETWEEN 3 AND 5
""")
def grid_rows_n(spark, sf_dir):
    """A fixed number of rows from a first row."""
    section = {
        "data_start_row": 3, "end_condition": {"type": "n_rows", "n": 3},
        "columns": {"flag": {"col": "D", "dtype": "string"}, "discount": {"col": "C", "dtype": "float"}},
    }
    return _table(line_cells(spark, sf_dir), "LI", section)


@query("grid_rows_until_blank", f"""
WITH {EVENTS_SQL}, stop AS (
  SELECT workbook_id, coalesce(min(CASE WHEN b IS NULL THEN r END), 1 << 30) AS r FROM ev WHERE r >= 3 GROUP BY 1)
SELECT ev.workbook_id, ev.r AS "row", a AS kind, b AS val, c AS who
FROM ev JOIN stop USING (workbook_id) WHERE ev.r >= 3 AND ev.r < stop.r
""")
def grid_rows_until_blank(spark, sf_dir):
    """Rows from a first row to the first blank of a stop column."""
    section = {
        "data_start_row": 3, "end_condition": {"type": "empty_col", "col": "B"},
        "columns": {
            "kind": {"col": "A", "dtype": "string"}, "val": {"col": "B", "dtype": "float"}, "who": {"col": "C", "dtype": "int"},
        },
    }
    return _table(event_cells(spark, sf_dir), "EV", section)


@query("grid_rows_prefix", f"""
WITH {LINES_SQL}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY workbook_id ORDER BY r) AS n FROM li)
SELECT workbook_id, r AS "row", a AS qty, b AS price FROM numbered WHERE r = n
""")
def grid_rows_prefix(spark, sf_dir):
    """Without a rule the first column ends the table: rows 1, 2, ... with no gap."""
    section = {
        "columns": {"qty": {"col": "A", "dtype": "float"}, "price": {"col": "B", "dtype": "float"}},
    }
    return _table(line_cells(spark, sf_dir), "LI", section)


@query("grid_rows_until_label", f"""
WITH {EVENTS_SQL}, stop AS (
  SELECT workbook_id, coalesce(min(CASE WHEN a = 'signup' THEN r END), 1 << 30) AS r FROM ev WHERE r >= 2 GROUP BY 1)
SELECT ev.workbook_id, ev.r AS "row", b AS val, d AS "day"
FROM ev JOIN stop USING (workbook_id) WHERE ev.r >= 2 AND ev.r < stop.r
""")
def grid_rows_until_label(spark, sf_dir):
    """Rows up to the row that holds a label (compared without case and edges)."""
    section = {
        "data_start_row": 2, "end_condition": {"type": "label_row", "col": "A", "label": " SignUp "},
        "columns": {"val": {"col": "B", "dtype": "float"}, "day": {"col": "D", "dtype": "date"}},
    }
    return _table(event_cells(spark, sf_dir), "EV", section)


@query("grid_table_pivot", f"""
WITH {LINES_SQL}, head AS (
  SELECT workbook_id, max(CASE WHEN r = 2 THEN e END) AS status2, max(CASE WHEN r = 1 THEN b END) AS top_price FROM li GROUP BY 1)
SELECT workbook_id, r AS "row", a AS qty, CAST(trunc(b) AS BIGINT) AS whole_price, d AS flag, f AS shipped,
       status2, top_price, 'std' AS recon_type
FROM li JOIN head USING (workbook_id)
""")
def grid_table_pivot(spark, sf_dir):
    """Typed columns, one column from a fixed row, section metadata, an injected column."""
    section = {
        "data_start_row": 1, "data_end_row": LAST_ROW,
        "metadata": {"top_price": {"row": 1, "col": "B", "dtype": "float"}, "qty": {"row": 9, "col": "Z"}},
        "columns": {
            "qty": {"col": "A", "dtype": "float"},
            "whole_price": {"col": "B", "dtype": "int"},
            "flag": {"col": "D", "dtype": "string"},
            "shipped": {"col": "F", "dtype": "date"},
            "status2": {"col": "E", "row": 2, "dtype": "string"},
        },
    }
    settings = {"inject_columns": {"recon_type": "std", "qty": "not used"}}
    return _table(line_cells(spark, sf_dir), "LI", section, settings)


@query("grid_skip_rows", f"""
WITH {EVENTS_SQL}
SELECT workbook_id, r AS "row", a AS kind, c AS who FROM ev WHERE a NOT IN ('click', 'view')
""")
def grid_skip_rows(spark, sf_dir):
    """Rows whose skip column holds one of the skip values are left out."""
    section = {
        "data_start_row": 1, "end_row": LAST_ROW, "skip_col": "A", "skip_if_value": ["Click", " VIEW"],
        "columns": {"kind": {"col": "A", "dtype": "string"}, "who": {"col": "C", "dtype": "int"}},
    }
    return _table(event_cells(spark, sf_dir), "EV", section)


def _range_rule(columns):
    document = {"sheets": {"LI": {"tables": {"t": {"locator": {"range": "B1:E5"}, "columns": columns}}}}}
    return read_mapping(document).tables[0]


@query("grid_header_range", f"""
WITH {LINES_SQL}, body AS (SELECT * FROM li WHERE r BETWEEN 2 AND 5),
live AS (SELECT workbook_id, count(d) > 0 AS has_flag FROM body GROUP BY 1)
SELECT workbook_id, r AS "row", b AS price, c AS discount,
       CASE WHEN has_flag THEN d ELSE e END AS third, CASE WHEN has_flag THEN e END AS fourth
FROM body JOIN live USING (workbook_id)
""")
def grid_header_range(spark, sf_dir):
    """Range with a header row, columns matched by position after empty ones are gone."""
    columns = {
        "price": {"dtype": "float"}, "discount": {"dtype": "float"}, "third": {"dtype": "string"},
        "fourth": {"dtype": "string"},
    }
    return tables.header_range(line_cells(spark, sf_dir), _range_rule(columns))


@query("grid_header_names", f"""
WITH {LINES_SQL}, head AS (
  SELECT workbook_id, max(CASE WHEN r = 1 THEN CAST(b AS VARCHAR) END) AS hb, max(CASE WHEN r = 1 THEN CAST(c AS VARCHAR) END) AS hc,
         max(CASE WHEN r = 1 THEN d END) AS hd, max(CASE WHEN r = 1 THEN e END) AS he FROM li GROUP BY 1),
body AS (SELECT * FROM li WHERE r BETWEEN 2 AND 5),
live AS (SELECT workbook_id, count(d) > 0 AS has_flag FROM body GROUP BY 1)
SELECT workbook_id, r AS "row", 1 AS position, coalesce(hb, 'Column_2') AS header, CAST(b AS VARCHAR) AS value
FROM body JOIN head USING (workbook_id)
UNION ALL
SELECT workbook_id, r, 2, coalesce(hc, 'Column_3'), CAST(c AS VARCHAR) FROM body JOIN head USING (workbook_id)
UNION ALL
SELECT workbook_id, r, 3, coalesce(hd, 'Column_4'), d
FROM body JOIN head USING (workbook_id) JOIN live USING (workbook_id) WHERE has_flag
UNION ALL
SELECT workbook_id, r, CASE WHEN has_flag THEN 4 ELSE 3 END, coalesce(he, 'Column_5'), e
FROM body JOIN head USING (workbook_id) JOIN live USING (workbook_id)
""")
def grid_header_names(spark, sf_dir):
    """The same range in long form under its own header texts."""
    return tables.header_range(line_cells(spark, sf_dir), _range_rule({}))


@query("grid_many_tables", f"""
WITH {LINES_SQL}, {EVENTS_SQL}
SELECT workbook_id, 'lines/top' AS table_key, count(*) AS n_rows, sum(CAST(trunc(a) AS BIGINT))::BIGINT AS total
FROM li WHERE r <= 2 GROUP BY 1
UNION ALL
SELECT workbook_id, 'lines/rest', count(*), sum(CAST(trunc(b) AS BIGINT))::BIGINT FROM li WHERE r BETWEEN 3 AND 7 GROUP BY 1
UNION ALL
SELECT workbook_id, 'events/all', count(*), sum(c)::BIGINT FROM ev GROUP BY 1
""")
def grid_many_tables(spark, sf_dir):
    """Three tables of two sheets extracted in one pass over all cells."""
    def block(first, last, col, key):
        return {"data_start_row": first, "end_row": last, "db_table": key, "columns": {"v": {"col": col, "dtype": "int"}}}

    document = {"workbook": {}, "sheets": {
        "l": {"sheet_name": "LI", "sections": {"a": block(1, 2, "A", "lines/top"), "b": block(3, 7, "B", "lines/rest")}},
        "e": {"sheet_name": "EV", "sections": {"c": block(1, 200, "C", "events/all")}},
    }}
    rules = read_mapping(document)
    cells = line_cells(spark, sf_dir).unionByName(event_cells(spark, sf_dir))
    records = materialize(tables.table_records(cells, rules.tables), "records")
    found = tables.all_tables(cells, records, rules.tables, rules.scalars, rules.sheets)
    parts = [
        df.groupBy("workbook_id").agg(F.count("*").alias("n_rows"), F.sum("v").alias("total")).withColumn(
            "table_key", F.lit(key))
        for key, df in found.items()
    ]
    return tables.union_by_name(parts)


@query("sheet_presence", """
WITH books AS (
  SELECT o_orderkey, o_totalprice > 400000 AS big, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_lines FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS workbook_id,
       concat_ws('|', CASE WHEN NOT has_lines THEN 'Lines' END, CASE WHEN NOT big THEN 'Big' END) AS missing_sheets,
       CASE WHEN has_lines THEN '' ELSE 'line' END AS missing_tables, has_lines AND big AS structure_ok
FROM books
""")
def sheet_presence(spark, sf_dir):
    """Required sheets and tables that a workbook lacks."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    books = orders.join(lines.withColumn("has_lines", F.lit(True)), "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("workbook_id"),
        F.array_compact(F.array(
            F.lit("Orders"), F.when(F.col("has_lines"), "Lines"), F.when(F.col("o_totalprice") > 400000, "Big"),
        )).alias("sheets"),
        F.array_compact(F.array(F.lit("order"), F.when(F.col("has_lines"), "line"))).alias("tables"),
    )
    checked = structure_check(books, ["Orders", "Lines", "Big"], ["order", "line"])
    return checked.select(
        "workbook_id", F.array_join("missing_sheets", "|").alias("missing_sheets"),
        F.array_join("missing_tables", "|").alias("missing_tables"), "structure_ok",
    )


@query("required_missing", f"""
WITH {EVENTS_SQL}, v AS (SELECT workbook_id, max(CASE WHEN r = 10 THEN b END) AS v10, max(CASE WHEN r = 11 THEN b END) AS v11 FROM ev GROUP BY 1)
SELECT workbook_id, 'EV' AS sheet_id, 'required value missing: _legacy.ten' AS error FROM v WHERE v10 IS NULL
""")
def required_missing(spark, sf_dir):
    """Errors for required values that are blank; optional ones give none."""
    cells = event_cells(spark, sf_dir)
    fields = {
        "ten": {"row": 10, "col": "B", "dtype": "float", "required": True},
        "eleven": {"row": 11, "col": "B", "dtype": "float", "required": True, "optional": True},
    }
    rules = read_mapping({"sheets": {"EV": {"fields": fields}}})
    return missing_required(scalar_records(books_of(cells), cells, rules.scalars))


LONG_ROWS = 20_000


def long_cells(spark, sf_dir):
    """One workbook per 20,000 places of order key and line number, which give the row.

    A quantity, B ``end`` on one late row, AZ (column 52) a label beside the row number.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    place = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = lines.select(
        F.floor(place / LONG_ROWS).cast("string").alias("workbook_id"), F.lit("LONG").alias("sheet"),
        (F.pmod(place, F.lit(LONG_ROWS)) + 1).cast("int").alias("row"), "q", "l_linenumber")
    return long_form(rows, [
        (1, "float", F.col("q").cast("string")),
        (2, "text", F.when(F.col("row") == LONG_ROWS - 4, "end").otherwise("go on")),
        (52, "text", F.when(F.col("l_linenumber") == 7, "far label")),
        (53, "text", F.col("row").cast("string")),
    ])


LONG_SQL = """lg AS (
  SELECT CAST(p // 20000 AS VARCHAR) AS workbook_id, CAST(p % 20000 + 1 AS INTEGER) AS r, q, n FROM (
    SELECT l_orderkey * 8 + l_linenumber AS p, l_linenumber AS n, max(l_quantity) AS q FROM lineitem GROUP BY ALL))"""


@query("grid_rows_long", f"""
WITH {LONG_SQL}, stop AS (SELECT workbook_id, coalesce(min(CASE WHEN r = 19996 THEN r END), 1 << 30) AS r FROM lg GROUP BY 1)
SELECT lg.workbook_id, lg.r AS "row", q AS qty FROM lg JOIN stop USING (workbook_id) WHERE lg.r < stop.r
""")
def grid_rows_long(spark, sf_dir):
    """Rows up to a label that may stand beyond row 10,000; without it to the end of the sheet."""
    section = {"end_condition": {"type": "label_row", "col": "B", "label": "end"}, "columns": {"qty": {"col": "A", "dtype": "float"}}}
    return _table(long_cells(spark, sf_dir), "LONG", section)


@query("grid_label_far", f"""
WITH {LONG_SQL}, hit AS (SELECT workbook_id, min(r) FILTER (n = 7 AND r >= 200) AS r FROM lg GROUP BY 1)
SELECT workbook_id, 'far' AS name, CAST(r AS VARCHAR) AS value FROM hit
""")
def grid_label_far(spark, sf_dir):
    """A label beyond row 100 and column 50, with no window given but a first row."""
    fields = {"far": {"locator": {"find": {"text": "far label", "start_row": 200}}, "dtype": "int"}}
    return _scalars(long_cells(spark, sf_dir), fields, "LONG")


@query("grid_label_many", f"""
WITH {EVENTS_SQL}, cell AS (
  SELECT workbook_id, r, 1 AS col, a AS raw FROM ev WHERE a IS NOT NULL
  UNION ALL SELECT workbook_id, r, 2, CAST(b AS VARCHAR) FROM ev WHERE b IS NOT NULL
  UNION ALL SELECT workbook_id, r, 3, CAST(c AS VARCHAR) FROM ev WHERE c IS NOT NULL
  UNION ALL SELECT workbook_id, r, 4, d FROM ev WHERE d IS NOT NULL
), piece AS (
  SELECT DISTINCT workbook_id, r, col, substr(raw, i, size) AS text
  FROM (SELECT *, unnest(range(1, len(raw) + 1)) AS i FROM cell WHERE NOT (col IN (2, 3) AND TRY_CAST(raw AS DOUBLE) = 0)), range(1, 6) AS sizes(size)
  WHERE i + size - 1 <= len(raw)
), hit AS (
  SELECT workbook_id, CAST(text AS INTEGER) AS seq, min({{'r': r, 'c': col}}) AS spot FROM piece
  WHERE regexp_full_match(text, '[1-9][0-9]{{0,4}}|0') GROUP BY ALL
)
SELECT hit.workbook_id, seq, raw FROM hit LEFT JOIN cell ON cell.workbook_id = hit.workbook_id AND r = spot.r AND col = spot.c + 1
""")
def grid_label_many(spark, sf_dir):
    """100,000 label rules over one sheet: right neighbour of the first cell that holds a number."""
    rules = [
        {"seq": n, "sheet_name": "EV", "text": str(n), "first_row": 1, "last_row": LAST_ROW, "last_col": 100, "offset": 1} for n in range(100_000)]
    return scalars.label_hits(event_cells(spark, sf_dir), rules).select("workbook_id", "seq", F.col("cell.raw").alias("raw"))


@query("grid_section_metadata", f"""
WITH {EVENTS_SQL}, books AS (SELECT DISTINCT workbook_id FROM ev), stop AS (
  SELECT workbook_id, coalesce(min(CASE WHEN r BETWEEN 2 AND 4 AND a IS NULL THEN r END), 5) AS r FROM ev GROUP BY 1),
m AS (
  SELECT books.workbook_id, max(CASE WHEN ev.r = 1 THEN a END) AS top, coalesce(max(CASE WHEN ev.r = 3 THEN b END), -1.5) AS third
  FROM books JOIN ev USING (workbook_id) GROUP BY 1)
SELECT 'plain' AS part, ev.workbook_id, ev.r AS "row", c AS who, top, third, CAST(7 AS BIGINT) AS absent
FROM ev JOIN m USING (workbook_id) WHERE ev.r >= 5
UNION ALL
SELECT 'range', ev.workbook_id, ev.r, c, top, third, 7
FROM ev JOIN m USING (workbook_id) WHERE ev.r >= 11
""")
def grid_section_metadata(spark, sf_dir):
    """Metadata of a section in the rows of its tables: from a cell, with a default where
    the cell is blank, and one that no cell gives; for a plain and for a range table."""
    metadata = {
        "top": {"row": 1, "col": "A"}, "third": {"row": 3, "col": "B", "dtype": "float", "default": -1.5},
        "absent": {"row": 5000, "col": "Z", "dtype": "int", "default": 7},
    }
    columns = {"who": {"col": "C", "dtype": "int"}}
    document = {"workbook": {}, "sheets": {"EV": {"sections": {
        "plain": {"db_table": "plain", "data_start_row": 5, "end_row": LAST_ROW, "metadata": metadata, "columns": columns},
        "range": {"db_table": "range", "locator": {"range": "C10:C200"}, "metadata": metadata, "columns": columns}}}}}
    rules = read_mapping(document)
    cells = event_cells(spark, sf_dir)
    found = tables.all_tables(cells, tables.table_records(cells, rules.tables, rules.scalars), rules.tables, rules.scalars, rules.sheets)
    parts = [found[name].select(F.lit(name).alias("part"), "workbook_id", "row", "who", "top", "third", "absent") for name in ("plain", "range")]
    return parts[0].unionByName(parts[1])
