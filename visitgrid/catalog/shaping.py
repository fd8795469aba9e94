"""Queries on records, fields, names, types and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import numbering, records, routing, typing
from ..operators.overlay import overlay
from ..operators.scalars import scalar_records
from ..operators.tables import union_by_name
from ..plans.mapping import read_mapping
from ..session import materialize
from . import query
from .inputs import EVENTS_SQL, LINES_SQL, books_of, event_cells, line_cells, table

_DOCUMENT = {"workbook": {}, "sheets": {
    "lines": {"sheet_name": "LI", "inject_columns": {"recon_type": "std"}, "sections": {
        "a": {"db_table": "meta/lines", "v": {"row": 1, "col": "A", "dtype": "float"}, "flag": {"row": 1, "col": "D"},
              "named_results": {"best": {"row": 2, "col": "B", "dtype": "float"}}},
        "b": {"db_table": "meta/lines", "v": {"row": 3, "col": "A", "dtype": "int"}, "pass_fail": {"row": 4, "col": "E"}},
    }},
    "events": {"sheet_name": "EV", "sections": {
        "c": {"db_table": "meta/events", "v": {"row": 1, "col": "B", "dtype": "float"}, "metadata": {"m": {"row": 2, "col": "A"}}},
        "d": {"v": {"row": 2, "col": "C", "dtype": "int"}},
    }},
}}


def _records(spark, sf_dir):
    rules = read_mapping(_DOCUMENT)
    cells = line_cells(spark, sf_dir).unionByName(event_cells(spark, sf_dir))
    inject = {s["sheet_id"]: s["inject"] for s in rules.sheets if s["inject"]}
    return scalar_records(books_of(cells), cells, rules.scalars, inject=inject)


_RECORDS_SQL = f"""{LINES_SQL}, {EVENTS_SQL},
lw AS (SELECT workbook_id, max(CASE WHEN r = 1 THEN a END) AS a1, max(CASE WHEN r = 1 THEN d END) AS d1, max(CASE WHEN r = 2 THEN b END) AS b2,
              max(CASE WHEN r = 3 THEN a END) AS a3, max(CASE WHEN r = 4 THEN e END) AS e4 FROM li GROUP BY 1),
ew AS (SELECT workbook_id, max(CASE WHEN r = 1 THEN b END) AS b1, max(CASE WHEN r = 2 THEN a END) AS a2, max(CASE WHEN r = 2 THEN c END) AS c2 FROM ev GROUP BY 1),
rec AS (
  SELECT workbook_id, 'lines' AS sheet_id, 'a' AS section_id, 'meta/lines' AS db_table, 'v' AS name, 'field' AS kind, CAST(a1 AS VARCHAR) AS value, 'std' AS recon_type, 0 AS seq FROM lw
  UNION ALL SELECT workbook_id, 'lines', 'a', 'meta/lines', 'flag', 'field', d1, 'std', 1 FROM lw
  UNION ALL SELECT workbook_id, 'lines', 'a', 'meta/lines', 'best', 'named_result', CAST(b2 AS VARCHAR), 'std', 2 FROM lw
  UNION ALL SELECT workbook_id, 'lines', 'b', 'meta/lines', 'v', 'field', CAST(CAST(a3 AS BIGINT) AS VARCHAR), 'std', 3 FROM lw
  UNION ALL SELECT workbook_id, 'lines', 'b', 'meta/lines', 'pass_fail', 'result_scalar', e4, 'std', 4 FROM lw
  UNION ALL SELECT workbook_id, 'events', 'c', 'meta/events', 'm', 'metadata', a2, NULL, 5 FROM ew
  UNION ALL SELECT workbook_id, 'events', 'c', 'meta/events', 'v', 'field', CAST(b1 AS VARCHAR), NULL, 6 FROM ew
  UNION ALL SELECT workbook_id, 'events', 'd', NULL, 'v', 'field', CAST(c2 AS VARCHAR), NULL, 7 FROM ew)"""


@query("scalar_records_long", f"""
WITH {_RECORDS_SQL} SELECT workbook_id, sheet_id, section_id, db_table, name, kind, value, recon_type FROM rec
""")
def scalar_records_long(spark, sf_dir):
    """One record per scalar, with its place, kind and injected context."""
    return _records(spark, sf_dir).select(
        "workbook_id", "sheet_id", "section_id", "db_table", "name", "kind", "value", "recon_type")


@query("scalar_wide", f"""
WITH {_RECORDS_SQL}
SELECT workbook_id, db_table, sheet_id AS source_sheet_id, CASE sheet_id WHEN 'lines' THEN 'LI' ELSE 'EV' END AS source_sheet_name,
       section_id AS source_section_id, max(CASE WHEN name = 'v' THEN value END) AS v, max(CASE WHEN name = 'flag' THEN value END) AS flag,
       max(CASE WHEN name = 'pass_fail' THEN value END) AS pass_fail, max(recon_type) AS recon_type
FROM rec WHERE kind IN ('field', 'result_scalar') AND db_table IS NOT NULL
  AND NOT (db_table = 'meta/lines' AND CAST(workbook_id AS BIGINT) % 5 = 0)
GROUP BY ALL
""")
def scalar_wide(spark, sf_dir):
    """One wide row per section; tables that already have rows are left out."""
    rows = materialize(_records(spark, sf_dir), "records")
    filled = rows.where((F.col("db_table") == "meta/lines") & (F.col("workbook_id").cast("bigint") % 5 == 0))
    return records.single_value_rows(rows, ["v", "flag", "pass_fail"], filled, ["recon_type"])


#: Tables of the query below.
SCALAR_TABLES = 20


@query("scalar_tables", f"""
SELECT CAST(event_id // 40 AS VARCHAR) AS workbook_id, 'meta/t' || CAST(event_id % {SCALAR_TABLES} AS VARCHAR) AS db_table,
  count(*) AS n, arg_max(CAST(value AS VARCHAR), event_id) FILTER (event_type = 'click') AS click,
  arg_max(CAST(value AS VARCHAR), event_id) FILTER (event_type = 'view') AS view, min(ts::DATE) AS day
FROM events WHERE NOT (event_id % {SCALAR_TABLES} = 3 AND event_id // 40 % 2 = 0) GROUP BY 1, 2
""")
def scalar_tables(spark, sf_dir):
    """Twenty tables that consist of scalars only, from one aggregate over the records."""
    events = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 40).cast("string").alias("workbook_id"), F.col("event_id").alias("seq"),
        F.concat(F.lit("meta/t"), (F.col("event_id") % SCALAR_TABLES).cast("string")).alias("db_table"), F.lit("s").alias("sheet_id"),
        F.lit("S").alias("sheet_name"), F.lit("x").alias("section_id"), F.lit("field").alias("kind"), F.col("event_type").alias("name"),
        F.col("value").cast("string").alias("value"))
    days = table(spark, sf_dir, "events").groupBy(
        F.floor(F.col("event_id") / 40).cast("string").alias("workbook_id"), F.concat(F.lit("meta/t"), (F.col("event_id") % SCALAR_TABLES).cast("string")).alias("db_table")).agg(
        F.count("*").alias("n"), F.min(F.col("ts").cast("date")).alias("day"))
    filled = events.where((F.col("db_table") == "meta/t3") & (F.col("workbook_id").cast("bigint") % 2 == 0))
    maps = records.single_value_maps(events, filled)
    return maps.join(days, ["workbook_id", "db_table"]).select(
        "workbook_id", "db_table", "n", *[F.try_element_at("values", F.lit(c)).alias(c) for c in ("click", "view")], "day")


@query("field_names", f"""
WITH {_RECORDS_SQL}
SELECT workbook_id, value, CASE seq WHEN 0 THEN 'v' WHEN 1 THEN 'flag' WHEN 2 THEN 'a.best' WHEN 3 THEN 'v_2'
         WHEN 6 THEN CASE WHEN workbook_id IN (SELECT workbook_id FROM lw) THEN 'v_3' ELSE 'v' END
         WHEN 7 THEN CASE WHEN workbook_id IN (SELECT workbook_id FROM lw) THEN 'v_2_2' ELSE 'v_2' END END AS name
FROM rec WHERE seq NOT IN (4, 5)
""")
def field_names(spark, sf_dir):
    """Field names with repeats suffixed in reading order, per sheet and then per workbook."""
    return records.field_names(_records(spark, sf_dir)).select("workbook_id", "name", "value")


@query("fields_wide", """
SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'click') AS click, arg_max(value, event_id) FILTER (event_type = 'view') AS view,
       arg_max(value, event_id) FILTER (event_type = 'error') AS error, arg_min(ts, event_id) AS ts
FROM events GROUP BY 1
""")
def fields_wide(spark, sf_dir):
    """Last value per name and first context value, one row per key."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("name"), "value", "event_id", "ts")
    return records.pivot_last(events, ["user_id"], ["click", "view", "error"], "event_id", ["ts"])


@query("fallback_fields", f"""
WITH {_RECORDS_SQL} SELECT workbook_id, 'flag' AS name, value FROM rec WHERE name = 'flag'
UNION ALL SELECT workbook_id, 'a.best', value FROM rec WHERE name = 'best'
""")
def fallback_fields(spark, sf_dir):
    """Where no candidate table exists, fields whose name holds one of some words."""
    fields = records.field_names(_records(spark, sf_dir))
    return records.named_fields(fields, ("fla", "best")).select("workbook_id", "name", "value")


@query("union_by_name", """
SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status, CAST(NULL AS INTEGER) AS line, CAST(o_custkey AS VARCHAR) AS code FROM orders
UNION ALL
SELECT l_orderkey, l_extendedprice, NULL, l_linenumber, l_returnflag FROM lineitem
""")
def union_of_tables(spark, sf_dir):
    """Tables with different columns; a column of two types becomes text."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("code"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("code"))
    return union_by_name([orders, lines])


def _overlay_sql(template: str) -> str:
    return f"""
WITH parent AS (SELECT {template} AS template_id, 'a.' || p_type || '.' || CAST(p_partkey AS VARCHAR) AS path, p_name AS value, p_partkey, p_type FROM part)
SELECT template_id, path, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE value END AS value
FROM parent WHERE NOT (p_type = 'SMALL' AND template_id % 10 = 0) AND p_partkey % 5 <> 1
UNION ALL
SELECT template_id, path || '.x', 'deep' FROM parent WHERE p_partkey % 5 = 1 AND NOT (p_type = 'SMALL' AND template_id % 10 = 0)
UNION ALL
SELECT DISTINCT template_id, 'a.SMALL', 'leaf' FROM parent WHERE template_id % 10 = 0
"""


def _overlaid(spark, sf_dir, template):
    parent = table(spark, sf_dir, "part").select(
        template.alias("template_id"),
        F.concat_ws(".", F.lit("a"), "p_type", F.col("p_partkey").cast("string")).alias("path"),
        F.col("p_name").alias("value"), "p_partkey", "p_type")
    cut = (F.col("p_type") == "SMALL") & (F.col("template_id") % 10 == 0)
    open_rows = parent.where(~cut)
    changed = open_rows.where("p_partkey % 5 = 0").select("template_id", "path", F.col("p_type").alias("value"))
    deeper = open_rows.where("p_partkey % 5 = 1").select("template_id", F.concat("path", F.lit(".x")).alias("path"), F.lit("deep").alias("value"))
    leaf = parent.where("template_id % 10 = 0").select("template_id", F.lit("a.SMALL").alias("path"), F.lit("leaf").alias("value")).distinct()
    child = changed.unionByName(deeper).unionByName(leaf)
    return overlay(parent.select("template_id", "path", "value"), child)


@query("spec_overlay", _overlay_sql("p_size"))
def spec_overlay(spark, sf_dir):
    """Child settings over parent settings: leaf over leaf, leaf over branch, branch over leaf."""
    return _overlaid(spark, sf_dir, F.col("p_size"))


@query("spec_overlay_hot", _overlay_sql("CASE WHEN p_partkey % 10 < 8 THEN 20 ELSE p_size END"))
def spec_overlay_hot(spark, sf_dir):
    """The same where one template holds most of the leaves."""
    return _overlaid(spark, sf_dir, F.when(F.col("p_partkey") % 10 < 8, 20).otherwise(F.col("p_size")))


@query("standardize_names", """
SELECT p_partkey, replace(replace(replace(p_name, ' ', '_') || '_' || p_brand, '.', '_'), '-', '_') || '_mm_x' AS name FROM part
""")
def standardize_names(spark, sf_dir):
    """Column-name form of the text export."""
    raw = F.concat(F.col("p_name"), F.lit("-"), F.col("p_brand"), F.lit(".(mm)/x"))
    return table(spark, sf_dir, "part").select("p_partkey", names.standardize_col(raw).alias("name")).withColumn(
        "name", F.replace("name", F.lit("__"), F.lit("_")))


@query("sanitize_names", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'e' || replace(p_name, ' ', '_') || '_oAEss' WHEN 1 THEN 'c_' || CAST(p_partkey AS VARCHAR) || '_' || replace(p_name, ' ', '_')
                  WHEN 2 THEN 'column' ELSE replace(p_name, ' ', '_') || '_fi2_EAkgzVIII' END AS name
FROM part
""")
def sanitize_names(spark, sf_dir):
    """ASCII identifiers from names with accents, digits, signs, ligatures, other scripts, or nothing usable."""
    kind, name = F.col("p_partkey") % 4, F.col("p_name")
    raw = (
        F.when(kind == 0, F.concat(F.lit(" é"), name, F.lit(" % öÅËss ")))
        .when(kind == 1, F.concat(F.col("p_partkey").cast("string"), F.lit("--"), name))
        .when(kind == 2, "µ/Ø").otherwise(F.concat(F.lit("_"), name, F.lit("__ﬁ²_Ệ𝐀㎏Ωｚ漢Ⅷ_")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", names.sanitize_col(raw).alias("name"))


@query("name_numbering", """
WITH t AS (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)
SELECT p_partkey, p_name, CASE WHEN n = 1 THEN p_name ELSE p_name || '_' || CAST(n AS VARCHAR) END AS unique_name FROM t
""")
def name_numbering(spark, sf_dir):
    """Repeats of a name numbered in order, however many rows share it."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return numbering.number_names(parts, "p_name", ["p_partkey"], "unique_name")


@query("table_stems", """
WITH t AS (SELECT DISTINCT p_type || sep || replace(p_brand, '#', ' ') AS table_name, p_type || '_' || replace(p_brand, '#', '_') AS stem
           FROM part, (VALUES ('/'), ('\\'), (' ')) s(sep)),
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY table_name) AS n FROM t)
SELECT table_name, CASE WHEN n = 1 THEN stem ELSE stem || '_' || CAST(n AS VARCHAR) END AS file_stem FROM n
""")
def table_stems(spark, sf_dir):
    """File stems of table names; tables that share a stem are numbered."""
    brand = F.replace("p_brand", F.lit("#"), F.lit(" "))
    found = table(spark, sf_dir, "part").select(
        F.explode(F.array(*[F.concat(F.col("p_type"), F.lit(sep), brand) for sep in ("/", "\\", " ")])).alias("table_name")
    ).distinct()
    stems = found.withColumn("stem", names.table_stem_col(F.col("table_name")))
    return numbering.number_names(stems, "stem", ["table_name"], "file_stem").select("table_name", "file_stem")


@query("route_tables", """
WITH t AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'ctdi_32_kv' WHEN 'LARGE' THEN 'geometry_overscan' WHEN 'PROMO' THEN 'noise'
                  WHEN 'MEDIUM' THEN 'protocols' ELSE 'own/' || p_brand || ':x y' END AS name FROM part)
SELECT p_partkey, name,
       CASE name WHEN 'ctdi_32_kv' THEN 'CTDI_32cm' WHEN 'geometry_overscan' THEN 'buisspanning_geometrie' WHEN 'noise' THEN 'Ruis_Detectorrij' ELSE 'Extracted_Tables' END AS folder,
       CASE name WHEN 'ctdi_32_kv' THEN 'CTDI_32_KV' WHEN 'geometry_overscan' THEN 'Geometry_Overscan' WHEN 'noise' THEN 'Noise'
            ELSE replace(replace(replace(name, '/', '__'), ':', '_'), ' ', '_') END AS file,
       CASE name WHEN 'geometry_overscan' THEN 'geometry_geometry_overscan' WHEN 'noise' THEN 'noise_noise' WHEN 'protocols' THEN 'protocols' ELSE '' END AS targets
FROM t
""")
def route_tables(spark, sf_dir):
    """Folder, file and extra Parquet targets by table name."""
    kind = F.col("p_type")
    name = (
        F.when(kind == "SMALL", "ctdi_32_kv").when(kind == "LARGE", "geometry_overscan").when(kind == "PROMO", "noise")
        .when(kind == "MEDIUM", "protocols").otherwise(F.concat(F.lit("own/"), F.col("p_brand"), F.lit(":x y")))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    folder, file = routing.text_target_cols(F.col("name"))
    return parts.select("p_partkey", "name", folder.alias("folder"), file.alias("file"),
                        F.array_join(routing.parquet_targets_col(F.col("name")), "|").alias("targets"))


def _customer_text(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), "c_name",
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal").cast("string")).alias("balance"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")), "dd/MM/yyyy").alias("open_date"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("2020-01-01").alias("mixed_date"))


@query("infer_types", """
SELECT 'code' AS column_name, count(*) AS filled, 0::BIGINT AS not_numeric, 'double' AS inferred FROM customer
UNION ALL SELECT 'c_name', count(c_name), count(c_name), 'string' FROM customer
UNION ALL SELECT 'balance', count(*) FILTER (c_custkey % 9 <> 0), 0, 'double' FROM customer
UNION ALL SELECT 'open_date', count(*), count(*), 'timestamp_ntz' FROM customer
UNION ALL SELECT 'mixed_date', count(*), count(*), 'string' FROM customer
""")
def infer_types(spark, sf_dir):
    """What every text column could be typed as, in one pass over the table."""
    return typing.type_profile(_customer_text(spark, sf_dir))


@query("inferred_table", """
SELECT CAST(c_custkey AS DOUBLE) AS code, c_name, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS balance,
       CAST(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER) AS TIMESTAMP) AS open_date,
       CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '2020-01-01' END AS mixed_date
FROM customer
""")
def inferred_table(spark, sf_dir):
    """The same table with the types its values allow."""
    return typing.with_inferred_types(_customer_text(spark, sf_dir))


@query("distinct_ratio", """
SELECT 'o_orderstatus' AS column_name, count(DISTINCT o_orderstatus) AS distinct_values, count(*) AS rows, TRUE AS is_category FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), count(*), TRUE FROM orders
UNION ALL SELECT 'code', count(DISTINCT o_orderkey), count(*), FALSE FROM orders
""")
def distinct_ratio(spark, sf_dir):
    """Distinct values over rows of every text column."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", F.col("o_orderkey").cast("string").alias("code"))
    return typing.distinct_ratio(orders)


@query("table_info", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(*)::INTEGER FROM (DESCRIBE {t})) AS n_columns, "
    f"(SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS columns"
    for t in ("orders", "customer", "lineitem", "part", "events", "documents", "conversations")))
def table_info(spark, sf_dir):
    """Rows and columns of the stored tables."""
    found = ("orders", "customer", "lineitem", "part", "events", "documents", "conversations")
    info = typing.table_info({name: table(spark, sf_dir, name) for name in found})
    return info.select("table_name", "n_rows", "n_columns", "columns")


@query("export_prepare", """
SELECT event_id, user_id AS "QAID", '{"k":' || regexp_extract(props, '(\\d+)', 1) || ',"kinds":["' || event_type || '"]}' AS details_1,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS hospital_id
FROM events
""")
def export_prepare(spark, sf_dir):
    """Nested values as JSON, id columns whole, column names made plain."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("QAID"),
        F.struct(F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"), F.array("event_type").alias("kinds")).alias("details (1)"),
        F.when(F.col("event_id") % 3 == 0, "none").otherwise(F.col("value").cast("string")).alias("hospital_id"))
    return typing.prepare_export(events)


@query("sentinel_to_null", """
SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber END AS n, CASE WHEN l_quantity > 10 THEN l_quantity END AS q, l_returnflag AS flag FROM lineitem
""")
def sentinel_to_null(spark, sf_dir):
    """The stored stand-in for "none" becomes null in numeric columns."""
    none = F.lit(typing.NONE_NUMBER)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(F.col("l_linenumber") % 2 == 1, F.col("l_linenumber")).otherwise(none).alias("n"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).otherwise(none.cast("double")).alias("q"), F.col("l_returnflag").alias("flag"))
    return typing.none_number_to_null(lines)


@query("filtered_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND CAST(o_custkey AS VARCHAR) = '77'
""")
def filtered_rows(spark, sf_dir):
    """``column=value`` filters on text and number columns."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return typing.where_equal(orders, ["o_orderstatus=F", "o_custkey=77", "no filter"])
