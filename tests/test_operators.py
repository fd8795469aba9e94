"""Operators against plain Python on small data, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F

from visitgrid.operators import frames, numbering, records, tables
from visitgrid.operators.overlay import overlay, setting
from visitgrid.operators.scalars import label_hits, scalar_records
from visitgrid.operators.typing import prepare_export, where_equal, with_inferred_types
from visitgrid.plans.mapping import cell_address, column_number, range_bounds, read_mapping
from visitgrid.session import scratch_path
from visitgrid.sinks import writers
from visitgrid.sources.tables import TableStore

CELLS = "workbook_id string, sheet string, row int, col int, ctype string, raw string"


@pytest.mark.parametrize("seed", range(4))
def test_numbering_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "c"])), rng.randrange(40), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "k string, v int, id int").repartition(5)
    got = {r["id"]: r["n"] for r in numbering.number_rows(frame, ["v", "id"], ["k"], "n", slices=16, hot_rows=200).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        for i, row in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]), start=1):
            want[row[2]] = i
    assert got == want
    overall = {r["id"]: r["n"] for r in numbering.number_rows(frame, ["v", "id"], out="n", slices=16).collect()}
    assert overall == {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: r[1:]), start=1)}


@pytest.mark.parametrize("key", [("k",), ()])
def test_numbering_of_copies_and_ties(spark, key):
    rng = random.Random(3)
    rows = [("hot", 5, "same") if rng.random() < 0.4 else (rng.choice(["hot", "a", None]), rng.choice([5, 6]), str(i)) for i in range(800)]
    frame = spark.createDataFrame(rows, "k string, v int, t string").repartition(4)
    got = [tuple(r) for r in numbering.number_rows(frame, ["v"], key, "n", slices=16, hot_rows=200).collect()]
    assert sorted(map(repr, (g[:3] for g in got))) == sorted(map(repr, rows))
    groups = {}
    for k, v, _, n in got:
        groups.setdefault(k if key else 0, []).append((n, v))
    for found in groups.values():
        found.sort()
        assert [n for n, _ in found] == list(range(1, len(found) + 1))
        assert [v for _, v in found] == sorted(v for _, v in found)


def test_numbering_spreads_a_hot_key(spark):
    frame = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    plan = numbering.number_rows(frame, ["id"], ["k"], "n", slices=16, hot_rows=1000)
    hot = plan.where("k = 'hot'")
    assert hot.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 6667, 6667)
    assert frame.sparkSession.range(0).count() == 0 and numbering.number_rows(frame.where("false"), ["id"]).count() == 0


def test_numbering_spreads_copies_with_nested_columns(spark):
    """Equal rows, nested columns among them, are dealt out over ranges; the plan names none of the ranges."""
    frame = spark.range(6000).select(F.array(F.lit(1)).alias("v"), F.create_map(F.lit("k"), F.lit(2)).alias("m"), F.lit("same").alias("t")).repartition(3)
    got = numbering.number_rows(frame, ["t"], out="n", slices=500)
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 6000, 6000)
    files = spark.read.parquet(*got.inputFiles()).groupBy(F.input_file_name()).count()
    assert files.count() > 100 and files.agg(F.max("count")).first()[0] < 200
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 5000


def test_path_order_is_by_parts(spark):
    paths = ["/in/a-b/1", "/in/a/b/1", "/in/a/1", "/in/a.b/1", "/in/a", "/in/a b/1", "/in/A/1", "/in/a/b-c", "/in/é/1"]
    got = {r["source_path"]: r["qaid"] for r in numbering.visit_ids(spark.createDataFrame([(p,) for p in paths], "source_path string"), base=7).collect()}
    assert got == {p: n for n, p in enumerate(sorted(paths, key=lambda p: p.split("/")), 8)}


def test_row_ranges(spark):
    rng = random.Random(5)
    cells, grid = [], {}
    for book in ("w1", "w2", "w3"):
        for row in range(1, 40):
            for col in (1, 2, 3):
                if rng.random() < 0.85:
                    text = rng.choice(["1", "2", "stop", " ", "7"])
                    cells.append((book, "S", row, col, "text", text))
                    grid[book, row, col] = text
    frame = spark.createDataFrame(cells, CELLS)

    def filled(book, row, col):
        return grid.get((book, row, col), "").strip() != ""

    def section(name, **rule):
        return {"db_table": name, **rule, "columns": {"x": {"col": "B"}, "y": {"col": "C"}}}

    document = {"workbook": {}, "sheets": {"s": {"sheet_name": "S", "sections": {
        "blank": section("blank", data_start_row=3, end_condition={"type": "empty_cell", "col": "A"}),
        "label": section("label", data_start_row=2, end_condition={"type": "label_row", "col": "A", "label": "Stop "}),
        "fixed": section("fixed", data_start_row=5, end_row=9, skip_col="A", skip_if_value="7"),
        "count": section("count", data_start_row=38, end_condition={"type": "n_rows", "n": 5}),
        "open": section("open", data_start_row=30, end_condition={"type": "label_row", "col": "A", "label": "none"}),
    }}}}
    rules = read_mapping(document)
    found = tables.table_records(frame, rules.tables)
    names = {t["table_id"]: t["table_key"] for t in rules.tables}
    got = {(r["workbook_id"], names[r["table_id"]], r["row"]) for r in found.collect()}
    want = set()
    for book in ("w1", "w2", "w3"):
        spans = {"fixed": range(5, 10), "count": range(38, 43), "open": range(30, 40)}
        spans["blank"] = range(3, next((r for r in range(3, 41) if not filled(book, r, 1))))
        spans["label"] = range(2, next((r for r in range(2, 41) if grid.get((book, r, 1)) == "stop"), 41))
        for name, span in spans.items():
            for row in span:
                if name == "fixed" and grid.get((book, row, 1)) == "7":
                    continue
                if filled(book, row, 2) or filled(book, row, 3):
                    want.add((book, name, row))
    assert got == want


def test_records_of_packed_rows_are_those_of_their_cells(spark):
    """Stop, skip and fixed columns, metadata, blank cells, a row in pieces and a file given
    twice; rows meet their tables without a shuffle of the cells."""
    rng = random.Random(11)
    cells, packed = [], []
    for book in ("w1", "w2", None, "w1"):
        for sheet in ("S", "T"):
            for row in (*range(1, 30), 7):
                found = [(col, rng.choice(["int", "text"]), rng.choice(["1", "2", "stop", " ", "\u00a0", "7"])) for col in range(1, 6) if rng.random() < 0.8]
                cells += [(book, sheet, row, *c) for c in found]
                packed.append((book, sheet, row, found))
    columns = {"x": {"col": "B"}, "y": {"col": "C", "row": 4}, "z": {"col": "E"}}
    document = {"workbook": {}, "sheets": {"s": {"sheet_name": "S", "sections": {
        "blank": {"data_start_row": 3, "end_condition": {"type": "empty_cell", "col": "A"}, "columns": columns},
        "label": {"data_start_row": 2, "end_condition": {"type": "label_row", "col": "A", "label": "Stop "}, "columns": columns},
        "fixed": {"data_start_row": 5, "end_row": 19, "skip_col": "A", "skip_if_value": "7", "columns": columns, "metadata": {"m": {"row": 2, "col": "D"}}}}},
        "t": {"sheet_name": "T", "sections": {"open": {"data_start_row": 8, "end_row": 40, "columns": {"x": {"col": "D"}}}}}}}
    rules = read_mapping(document)
    flat = tables.table_records(spark.createDataFrame(cells, CELLS), rules.tables, rules.scalars)
    rows = spark.createDataFrame(packed, "workbook_id string, sheet string, row int, cells array<struct<col: int, ctype: string, raw: string>>")
    found = tables.table_records(rows, rules.tables, rules.scalars)
    assert found.columns == flat.columns and {r["table_id"] for r in found.collect()} == {t["table_id"] for t in rules.tables}
    assert sorted(map(repr, found.collect())) == sorted(map(repr, flat.collect()))
    assert tables.table_records(rows.where("false"), rules.tables, rules.scalars).count() == 0


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_tasks_of_wide_rows_grow_with_the_records(spark, monkeypatch, broadcast):
    """More records make more tasks, not larger ones; join and aggregate share their shuffle."""
    monkeypatch.setattr(records, "RECORDS_PER_TASK", 10)
    items = [(None if w == 7 else f"w{w}", s, None if w == 9 else f"t{w % 2}", "s", "S", "x", "field", "ab"[s % 2], None if s == 2 else str(w * s)) for w in range(40) for s in range(5)]
    frame = spark.createDataFrame(
        items * 2, "workbook_id string, seq int, db_table string, sheet_id string, sheet_name string, section_id string, kind string, name string, value string")
    filled = frame.where("workbook_id in ('w3', 'w4') and db_table = 't1'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        wide = records.single_value_rows(frame, ["a", "b"], filled)
        got = sorted(repr(tuple(r)) for r in wide.collect())
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(None if w == 7 else f"w{w}", f"t{w % 2}", "s", "S", "x", str(w * 4), str(w * 3)) for w in range(40) if w not in (3, 9)]
    assert got == sorted(map(repr, want))
    assert ", 39), REPARTITION_BY_NUM" in plan and plan.index("Join") < plan.index("REPARTITION_BY_NUM")


def test_fixed_column_counts_only_in_its_row(spark):
    cells = [("w", "S", 3, 2, "int", "5"), ("w", "S", 1, 1, "int", "1")]
    document = {"workbook": {}, "sheets": {"s": {"sheet_name": "S", "sections": {"t": {
        "data_start_row": 1, "end_row": 4, "columns": {"a": {"col": 1, "dtype": "int"}, "f": {"col": "B", "row": 3, "dtype": "int"}}}}}}}
    rules = read_mapping(document)
    rows = tables.typed_table(tables.table_records(spark.createDataFrame(cells, CELLS), rules.tables), rules.tables[0])
    assert sorted((r["row"], r["a"], r["f"]) for r in rows.collect()) == [(1, 1, 5), (3, None, 5)]


def test_label_search_ignores_falsy_cells(spark):
    cells = [("w", "S", 1, 1, "int", "0"), ("w", "S", 1, 2, "text", "no"), ("w", "S", 2, 1, "text", "a0b"), ("w", "S", 2, 2, "int", "9"),
             ("w", "S", 20_001, 1, "text", "late"), ("w", "S", 20_001, 2, "int", "3"), ("w", "S", 1, 510, "text", "far"), ("w", "S", 1, 511, "int", "4")]
    rules = read_mapping({"sheets": {"S": {"fields": {n: {"name": n} for n in ("0", "late", "far")}}}}).scalars
    got = {rules[r["seq"]]["name"]: r["cell"]["raw"] for r in label_hits(spark.createDataFrame(cells, CELLS), rules).collect()}
    assert got == {"0": "9", "late": "3", "far": "4"}


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_label_index_equals_brute_force(spark, monkeypatch, limit):
    """Many rules, short, long, empty and non-Latin texts; with and without a broadcast."""
    monkeypatch.setattr(frames, "MAX_RULE_BYTES", limit)
    rng = random.Random(8)
    texts = ["", "a", "ab", "abc", "é漢", "漢字😀", "cab", "zz", "1", "0"] + ["".join(rng.choices("abc 1", k=rng.randint(1, 6))) for _ in range(60)]
    cells = {(b, s, r, c): "".join(rng.choices("abcé漢字😀 01", k=rng.randint(0, 9))) for b in "vw" for s in "ST" for r in range(1, 9) for c in range(1, 5) if rng.random() < 0.8}
    rules = [
        {"seq": n, "sheet_name": "ST"[n % 2], "text": t, "first_row": 1 + n % 3, "last_row": 5 + n % 4, "last_col": 2 + n % 3, "offset": n % 3 - 1}
        for n, t in enumerate(texts)]
    got = {(r["workbook_id"], r["seq"]): r["cell"] and r["cell"]["raw"] for r in label_hits(
        spark.createDataFrame([(*k, "text", v) for k, v in cells.items()], CELLS), rules).collect()}
    want = {}
    for book in "vw":
        for rule in rules:
            at = [k for k, v in cells.items() if k[:2] == (book, rule["sheet_name"]) and rule["first_row"] <= k[2] <= rule["last_row"] and k[3] <= rule["last_col"] and v and rule["text"] in v]
            if at:
                _, sheet, row, col = min(at)
                want[book, rule["seq"]] = cells.get((book, sheet, row, col + rule["offset"]))
    assert got == want


def test_field_names_by_sheet_then_workbook(spark):
    """Names of interleaved sheets, against the rule applied field by field."""
    rng = random.Random(2)
    rows, want = [], {}
    for book in range(12):
        own = [(seq, f"s{rng.randrange(3)}", rng.choice(["a", "a_2", "b"]), rng.choice(["field", "named_result", "other"])) for seq in range(9) if rng.random() < 0.8]
        own = own if book % 3 else [(seq, "s0", "a", "field") for seq in range(5)]
        rows += [(str(book), seq, sheet, "sec", name, kind, f"v{seq}") for seq, sheet, name, kind in own]
        sheets = {}
        for seq, sheet, name, kind in own:
            if kind != "other":
                sheets.setdefault(sheet, []).append((seq, f"sec.{name}" if kind == "named_result" else name))

        def free(names):
            out = []
            for name in names:
                out.append(name if name not in out else next(f"{name}_{i}" for i in range(2, 99) if f"{name}_{i}" not in out))
            return out

        flat = free([n for items in sheets.values() for n in free([name for _, name in items])])
        want |= {(str(book), seq): name for (seq, _), name in zip([x for items in sheets.values() for x in items], flat)}
    frame = spark.createDataFrame(rows, "workbook_id string, seq int, sheet_id string, section_id string, name string, kind string, value string").repartition(3)
    got = {(r["workbook_id"], r["seq"]): (r["name"], r["value"]) for r in records.field_names(frame).collect()}
    assert got == {k: (name, f"v{k[1]}") for k, name in want.items()}


def test_absent_sheet_gives_no_records(spark):
    books = spark.createDataFrame([("w", ["S"]), ("v", ["T"])], "workbook_id string, sheets array<string>")
    cells = spark.createDataFrame([("w", "S", 1, 1, "text", "x")], CELLS)
    rules = read_mapping({"sheets": {"S": {"fields": {"f": {"row": 1, "col": 1, "normalize": {"case": "upper"}}, "g": {"row": 2, "col": 1, "default": "d"}}}}})
    rows = scalar_records(books, cells, rules.scalars)
    assert sorted((r["workbook_id"], r["name"], r["value"]) for r in rows.collect()) == [("w", "f", "X"), ("w", "g", "d")]
    assert records.fields_map(records.field_names(rows)).first()["n_fields"] == 2


def test_mapping():
    assert [column_number(c) for c in ("A", "Z", "AA", "AH", "7", 3, None)] == [1, 26, 27, 34, 7, 3, None]
    assert cell_address("E13") == (13, 5) and cell_address("x") is None and range_bounds("B2:D9") == (2, 2, 9, 4)
    document = {"workbook": {"version": "6.8"}, "sheets": {"s": {"sheet_name": "S", "sections": {"a": {
        "db_table": "t", "columns": {"c": {"col": "B"}}, "summary_table": {"columns": {"d": {"col": "C"}}},
        "x": {"row": 1, "col": "A"}, "pass_fail": {"row": 2, "col": "A"}, "totaal": {"p": {"row": 3, "col": 1}},
        "group": {"q": {"row": 4, "col": 1}, "note": "n"}, "inner": {"columns": {"e": {"col": 5}}, "db_table": "own"},
        "deviation": {"cols": ["A"]}, "anchor_text": "z", "bhpa_criterion": {"row": 1, "col": 1}}}, "loose": {"row": 9, "col": 2}}}}
    rules = read_mapping(document)
    assert [(s["name"], s["kind"], s["section_id"]) for s in rules.scalars] == [
        ("x", "field", "a"), ("pass_fail", "result_scalar", "a"), ("p", "totaal", "a"), ("q", "group", "a"), ("loose", "field", "_sheet")]
    assert [(t["table_name"], t["table_key"], t["stop"]) for t in rules.tables] == [
        ("a", "t", "blank"), ("a__summary_table", "t", "blank"), ("a__inner", "own", "blank")]
    assert rules.version == "6.8"


def test_overlay(spark):
    schema = "template_id int, path string, value string"
    parent = spark.createDataFrame([(1, "a.b", "1"), (1, "a.c", "2"), (1, "d", "3"), (2, "a.b", "4")], schema)
    child = spark.createDataFrame([(1, "a", "leaf"), (1, "d.e", "deep")], schema)
    got = sorted(tuple(r) for r in overlay(parent, child).select("template_id", "path", "value").collect())
    assert got == [(1, "a", "leaf"), (1, "d.e", "deep"), (2, "a.b", "4")]
    assert setting(parent, "a").count() == 3


def test_union_turns_mixed_types_to_text(spark):
    one, two = spark.createDataFrame([(1.5, "k")], "x double, y string"), spark.createDataFrame([("nvt",)], "x string")
    assert sorted(r["x"] for r in tables.union_by_name([one, two]).collect()) == ["1.5", "nvt"]


def test_store(spark):
    store = TableStore(spark, scratch_path(spark, "store"))
    assert "T" not in store and store.get("T", "ID int").count() == 0
    store.put("T", spark.createDataFrame([(1, "a")], "ID int, v string"))
    store.load_reference("T", spark.createDataFrame([(1, "z"), (2, "b"), (2, "c")], "ID int, v string"))
    assert sorted(tuple(r) for r in store.get("T").collect()) == [(1, "a"), (2, "b"), (2, "c")]
    assert store.names() == ["T"] and store.select("T", "v = 'b'").count() == 1


def test_same_partition_keeps_both_visits(spark):
    root = scratch_path(spark, "visits")
    for qaid in (1, 2):
        frame = spark.createDataFrame([(qaid, "2024", None)], "qaid int, year string, hospital string").fillna("unknown")
        writers.write_partitioned(frame, root, ("year", "hospital"))
    assert sorted(r["qaid"] for r in spark.read.parquet(root).collect()) == [1, 2]


def test_types_and_filters(spark):
    frame = spark.createDataFrame([("1", "03/04/2024", "x", 5), ("2,", None, "y", 6)], "a string, test_date string, t string, n int")
    typed = dict(with_inferred_types(frame).dtypes)
    assert typed == {"a": "string", "test_date": "timestamp_ntz", "t": "string", "n": "int"}
    assert where_equal(frame, ["n=5", "t=x"]).count() == 1
    assert prepare_export(frame.withColumn("l (x)", F.array("n"))).first()["l_x"] == "[5]"


def test_field_names_need_no_shuffle_of_workbooks_by_their_list(spark):
    """Most workbooks have the same list, so one task would get them all."""
    rows = spark.createDataFrame([(f"w{n}", n % 3, "s", "x", "field", "f", "1") for n in range(30)],
                                 "workbook_id string, seq int, sheet_id string, section_id string, kind string, name string, value string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        named = records.field_names(rows)
        assert named.count() == 30 and "BroadcastHashJoin" in named._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
