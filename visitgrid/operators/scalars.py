"""Scalar extraction: cells found by address, label or name, in long form.

Input tables
  workbooks  workbook_id, sheets array<string>, ...
  cells      workbook_id, sheet, row, col, ctype, raw   (one row per filled cell)
  names      workbook_id, name, sheet, row, col         (defined names)

The rule tables are broadcast, so cells that no rule asks for never leave their
task; what is shuffled is at most one hit per (workbook, rule).
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import convert
from ..functions.normalize import normalize
from ..functions.text import is_blank, strip
from ..plans.mapping import LIST_TYPES
from .frames import rule_frame


def _cell() -> Column:
    return F.struct("ctype", "raw")


def truthy(cells: DataFrame) -> Column:
    """Cells a label search looks at: not zero, not false, not empty."""
    number = F.when(F.col("ctype").isin("int", "float"), F.col("raw").try_cast("double"))
    return F.when(number.isNotNull(), number != 0).when(
        F.col("ctype") == "bool", F.lower("raw") == "true"
    ).otherwise(F.col("raw") != "")


def point_hits(cells: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """Cells at fixed addresses: (workbook_id, seq, cell)."""
    spec = rule_frame(
        cells.sparkSession,
        [{"seq": r["seq"], "sheet": r["sheet_name"], "row": r["row"], "col": r["col"]} for r in rules],
        "seq int, sheet string, row int, col int",
    )
    rows = [r["row"] for r in rules]
    near = cells.where(F.col("row").between(min(rows), max(rows)))  # before the cells of packed rows are laid out
    return near.join(spec, ["sheet", "row", "col"]).select("workbook_id", "seq", _cell().alias("cell"))


#: Characters of the piece by which a label text is looked up; shorter texts by all of them.
_GRAM = 3


def _grams(texts: Sequence[str]) -> dict[str, str]:
    """For each text the piece of it that the fewest texts have."""
    pieces = {t: {t[i : i + _GRAM] for i in range(max(1, len(t) - _GRAM + 1))} for t in set(texts)}
    shared = Counter(g for found in pieces.values() for g in found)
    return {t: min(found, key=lambda g: (shared[g], g)) for t, found in pieces.items()}


def label_hits(cells: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """Neighbour of the first cell, in row-major order, that contains a text.

    Rules give the search window.  Each rule stands in an index under a rare piece of its
    text; the pieces of a cell's text are looked up there, and what is found is verified.
    So the work of a cell depends on its length, not on the number of rules.  The first
    hit is a minimum of (row, col), which is combined before the shuffle.  A workbook
    without a hit gives no row; a hit whose neighbour is empty gives a null cell.
    """
    grams = _grams([r["text"] for r in rules])
    index = rule_frame(
        cells.sparkSession,
        [
            {
                "gram": grams[r["text"]], "seq": r["seq"], "sheet": r["sheet_name"], "text": r["text"], "first_row": r["first_row"],
                "last_row": r["last_row"], "last_col": r["last_col"], "offset": r["offset"],
            }
            for r in rules
        ],
        "gram string, seq int, sheet string, text string, first_row int, last_row int, last_col int, offset int",
    )
    low = min(r["first_row"] for r in rules)
    high = max(r["last_row"] for r in rules)
    right = max(r["last_col"] + max(r["offset"], 0) for r in rules)
    window = cells.where(F.col("row").between(low, high) & (F.col("col") <= right))

    sizes = sorted({len(g) for g in grams.values()})
    pieces = window.where(truthy(window)).withColumn("size", F.explode(F.array(*map(F.lit, sizes)))).where(F.length("raw") >= F.col("size"))
    last = F.when(F.col("size") == 0, 1).otherwise(F.length("raw") - F.col("size") + 1)  # every text holds the empty one, once
    pieces = pieces.withColumn("at", F.explode(F.sequence(F.lit(1), last))).withColumn("gram", F.expr("substring(raw, at, size)"))
    inside = F.col("row").between(F.col("first_row"), F.col("last_row")) & (F.col("col") <= F.col("last_col"))
    first = (
        pieces.join(index, ["sheet", "gram"]).where(inside & F.col("raw").contains(F.col("text")))
        .groupBy("workbook_id", "sheet", "seq", "offset")
        .agg(F.min(F.struct("row", "col")).alias("at"))
        .select("workbook_id", "sheet", "seq", F.col("at.row").alias("row"), (F.col("at.col") + F.col("offset")).alias("col"))
    )
    return first.join(window, ["workbook_id", "sheet", "row", "col"], "left").select(
        "workbook_id", "seq", F.when(F.col("raw").isNotNull(), _cell()).alias("cell")
    )


def name_hits(cells: DataFrame, names: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """Cells behind defined names; an empty target still counts as found."""
    spec = rule_frame(
        cells.sparkSession,
        [{"seq": r["seq"], "name": r["text"]} for r in rules],
        "seq int, name string",
    )
    wanted = names.join(spec, "name").select("workbook_id", "seq", "sheet", "row", "col")
    return wanted.join(cells, ["workbook_id", "sheet", "row", "col"], "left").select(
        "workbook_id", "seq", F.when(F.col("raw").isNotNull(), _cell()).alias("cell")
    )


def list_items(cells: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """Lists read down a column until its first blank cell, as JSON text.

    A list is bounded by the first and last row of its rule, so the array built per
    (workbook, rule) is too.
    """
    spec = rule_frame(
        cells.sparkSession,
        [
            {
                "seq": r["seq"], "sheet": r["sheet_name"], "col": col, "first_row": r["first_row"], "last_row": r["last_row"],
                "is_key": is_key, "plain": r["dtype"] == "list_of_string", "coded": r["code_col"] is not None,
            }
            for r in rules
            for col, is_key in ((r["col"], True), (r["code_col"], False))
            if col is not None
        ],
        "seq int, sheet string, col int, first_row int, last_row int, is_key boolean, plain boolean, coded boolean",
    )
    items = (
        cells.where(~is_blank(F.col("raw"))).alias("c")
        .join(
            spec.alias("s"),
            (F.col("c.sheet") == F.col("s.sheet")) & (F.col("c.col") == F.col("s.col"))
            & F.col("c.row").between(F.col("s.first_row"), F.col("s.last_row")),
        )
        .groupBy("workbook_id", "seq", "first_row", "plain", "coded", "row")
        .agg(
            F.max(F.when(F.col("is_key"), strip(F.col("raw")))).alias("nom"),
            F.max(F.when(~F.col("is_key"), strip(F.col("raw")))).alias("riziv"),
        )
        .where("nom is not null")
        .groupBy("workbook_id", "seq", "first_row", "plain", "coded")
        .agg(F.array_sort(F.collect_list(F.struct("row", "nom", "riziv"))).alias("items"))
    )
    prefix = F.filter("items", lambda x, i: x["row"] == F.col("first_row") + i)
    named = F.when(
        F.col("coded"),
        F.to_json(F.transform(prefix, lambda x: F.struct(x["nom"].alias("nom"), x["riziv"].alias("riziv"))),
                  {"ignoreNullFields": "false"}),
    ).otherwise(F.to_json(F.transform(prefix, lambda x: F.struct(x["nom"].alias("nom")))))
    plain = F.to_json(F.transform(prefix, lambda x: x["nom"]))
    text = F.when(F.col("plain"), plain).otherwise(named)
    return items.select(
        "workbook_id", "seq", F.struct(F.lit("list").alias("ctype"), text.alias("raw")).alias("cell")
    )


def scalar_hits(cells: DataFrame, rules: Sequence[dict], names: DataFrame | None = None) -> DataFrame:
    """All hits as (workbook_id, seq, rank, cell); a lower rank wins."""
    parts = []

    def add(hits: DataFrame, rank: int) -> None:
        parts.append(hits.withColumn("rank", F.lit(rank)))

    by_how = {how: [r for r in rules if r["how"] == how] for how in ("point", "find", "name", "list")}
    if by_how["point"]:
        add(point_hits(cells, by_how["point"]), 0)
    if by_how["find"] or by_how["name"]:
        add(label_hits(cells, by_how["find"] + by_how["name"]), 1)
    if by_how["name"] and names is not None:
        add(name_hits(cells, names, by_how["name"]), 0)
    if by_how["list"]:
        add(list_items(cells, by_how["list"]), 0)
    if not parts:
        return cells.select(
            "workbook_id", F.lit(None).cast("int").alias("seq"), _cell().alias("cell"), F.lit(0).alias("rank")
        ).where("false")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


SCALAR_RULE_SCHEMA = (
    "seq int, sheet_id string, sheet_name string, section_id string, db_table string, name string, "
    "kind string, dtype string, `row` int, col string, `default` string, required boolean, "
    "locale_safe boolean, bool_map map<string,boolean>"
)


def scalar_records(
    workbooks: DataFrame,
    cells: DataFrame,
    rules: Sequence[dict],
    names: DataFrame | None = None,
    inject: dict[str, dict] | None = None,
) -> DataFrame:
    """One record per (workbook, rule) of every sheet the workbook has.

    Hits are first packed into one map per workbook (its size is the number of
    rules), joined to the workbooks, and the rules of the present sheets are then
    laid out next to the map: one shuffle of hits, no join per rule.
    """
    spark = cells.sparkSession
    hits = scalar_hits(cells, rules, names)
    if {r["how"] for r in rules} & {"name"}:  # only a name can be found in two ways
        hits = hits.groupBy("workbook_id", "seq").agg(F.min_by("cell", "rank").alias("cell"))
    found = hits.groupBy("workbook_id").agg(
        F.map_from_entries(F.collect_set(F.struct("seq", "cell"))).alias("found")
    )
    spec = rule_frame(
        spark,
        [
            {
                **{k: r[k] for k in ("seq", "sheet_id", "sheet_name", "section_id", "db_table", "name", "kind", "dtype")},
                "row": r["row_label"], "col": r["col_label"], "required": r["required"],
                "default": None if r["default"] is None else str(r["default"]),
                "locale_safe": r["locale_safe"], "bool_map": r["bool_map"],
            }
            for r in rules
        ],
        SCALAR_RULE_SCHEMA,
    )
    present = workbooks.join(found, "workbook_id", "left").select(
        "workbook_id", "found", F.explode("sheets").alias("sheet_name")
    )
    joined = present.join(spec, "sheet_name").withColumn("cell", F.try_element_at("found", F.col("seq")))
    is_list = F.col("dtype").isin(*LIST_TYPES)
    raw = F.coalesce("cell.raw", F.when(is_list, F.lit("[]")), F.col("default"))
    joined = joined.withColumn("_raw", raw).withColumn("_ctype", F.coalesce("cell.ctype", F.lit("text")))
    by_settings: dict[str, list[dict]] = {}
    for rule in rules:
        if rule["normalize"]:
            by_settings.setdefault(json.dumps(rule["normalize"], sort_keys=True, default=str), []).append(rule)
    tidy = F.col("_raw")
    for same in by_settings.values():  # one branch per kind of settings, in one projection
        wanted = F.col("seq").isin([r["seq"] for r in same]) & ~is_blank(F.col("_raw"))
        tidy = F.when(wanted, normalize(F.col("_raw"), same[0]["normalize"])).otherwise(tidy)
    joined = joined.withColumn("_raw", tidy)
    value = F.when(is_list, F.col("_raw")).otherwise(
        convert.convert_long(
            F.col("_raw"), F.col("_ctype"), F.col("dtype"), {r["dtype"] for r in rules}, F.col("locale_safe"), F.col("bool_map")
        )
    )
    records = joined.select(
        "workbook_id", "seq", "sheet_id", "sheet_name", "section_id", "db_table", "name", "kind", "dtype",
        "row", "col", value.alias("value"), "required",
    )
    context = sorted({key for values in (inject or {}).values() for key in values})
    for key in context:
        fill = F.lit(None).cast("string")
        for sheet_id, values in inject.items():
            if key in values:
                fill = F.when(F.col("sheet_id") == sheet_id, F.lit(str(values[key]))).otherwise(fill)
        records = records.withColumn(key, fill)
    return records


def missing_required(records: DataFrame) -> DataFrame:
    """Error rows for required scalars without a value."""
    message = F.concat(F.lit("required value missing: "), F.col("section_id"), F.lit("."), F.col("name"))
    return records.where(F.col("required") & F.col("value").isNull()).select(
        "workbook_id", "sheet_id", message.alias("error")
    )
