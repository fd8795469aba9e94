"""Table extraction: row ranges of many tables in one pass over the cells.

Every column of a table gets a slot number.  Cells meet the (broadcast) slot table
on (sheet, column), are shuffled once by workbook and become one record per row.  Stop rules, skip rules and fixed-row columns are window expressions over
that same distribution, so no second shuffle is needed.  A sheet is read to its end; its
format bounds the rows of a window group.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import convert
from ..functions.normalize import normalize
from ..functions.text import is_blank, norm, strip
from ..plans.mapping import LAST_ROW, LIST_TYPES
from .frames import rule_frame

_KEYS = ("workbook_id", "table_id", "row")
SLOT_SCHEMA = "table_id int, sheet string, col int, first_row int, last_row int, slot int, role string"


def _last_row(rule: dict) -> int:
    return LAST_ROW if rule["last_row"] is None else rule["last_row"]


def _slots(rule: dict, metadata: Sequence[dict]) -> list[dict]:
    first, last = rule["first_row"], _last_row(rule)
    base = {"table_id": rule["table_id"], "sheet": rule["sheet_name"], "first_row": first, "last_row": last}
    rows = []
    for slot, column in enumerate(rule["columns"]):
        at = column["fixed_row"]
        if column["col"] is None:
            continue
        if at is None:
            rows.append({**base, "col": column["col"], "slot": slot, "role": "value"})
        else:
            rows.append({**base, "col": column["col"], "slot": slot, "role": "fixed", "first_row": at, "last_row": at})
    for i, point in enumerate(metadata):
        if point["how"] == "point":
            rows.append({**base, "col": point["col"], "slot": len(rule["columns"]) + i, "role": "meta",
                         "first_row": point["row"], "last_row": point["row"]})
    if rule["stop"] in ("blank", "label"):
        rows.append({**base, "col": rule["stop_col"], "slot": -1, "role": "stop"})
    if rule["skip_col"] is not None:
        rows.append({**base, "col": rule["skip_col"], "slot": -1, "role": "skip"})
    return rows


def section_metadata(rule: dict, scalars: Sequence[dict]) -> list[dict]:
    """Metadata scalars of a table's section whose name is no column of the table."""
    own = {c["name"] for c in rule["columns"]}
    return [
        s for s in scalars
        if s["kind"] == "metadata" and s["sheet_id"] == rule["sheet_id"]
        and s["section_id"] == rule["section_id"] and s["name"] not in own
    ]


def _cell_records(cells: DataFrame, slots: Sequence[dict], width: int, roles: set[str]) -> DataFrame:
    """Records of cells, which may stand in any order: a shuffle brings those of a row together."""
    spec = rule_frame(cells.sparkSession, slots, SLOT_SCHEMA)
    hits = (
        cells.where(~is_blank(F.col("raw"))).alias("c")
        .join(
            spec.alias("s"),
            (F.col("c.sheet") == F.col("s.sheet")) & (F.col("c.col") == F.col("s.col"))
            & F.col("c.row").between(F.col("s.first_row"), F.col("s.last_row")),
        )
        .select("workbook_id", "table_id", "row", "slot", "role", F.struct("ctype", "raw").alias("cell"))
    )
    # Cells are unique, so combining before the shuffle would only sort them twice.  A
    # workbook's share is bounded by its rules, and later joins on the visit find the
    # rows already distributed by workbook.
    hits = hits.repartition("workbook_id")

    def pick(slot: int) -> Column:
        return F.max(F.when((F.col("slot") == slot) & F.col("role").isin("value", "fixed", "meta"), F.col("cell")))

    text = norm(F.col("cell.raw"))
    own_row = F.col("role").isin("value", "fixed")
    aggregates = [pick(i).alias(f"s{i}") for i in range(width)]
    aggregates.append(F.max(own_row).alias("_data"))
    if "stop" in roles:
        aggregates.append(F.max(F.when(F.col("role") == "stop", text)).alias("_stop"))
    if "skip" in roles:
        aggregates.append(F.max(F.when(F.col("role") == "skip", text)).alias("_skip"))
    return hits.groupBy(*_KEYS).agg(*aggregates)


_ADDRESS = "struct<col: int, first_row: int, last_row: int>"


def _row_hits(rows: DataFrame, slots: Sequence[dict], width: int, roles: set[str], blank_from: dict[int, int]) -> DataFrame:
    """Records of the rows of a scan by row: (workbook_id, table_id, row, s0 .. sN, _data,
    and _stop and _skip where they are asked for).

    A row meets each table of its sheet once and gives its record there and then, so what
    is shuffled is a record and not its cells.  ``blank_from`` has the first row of tables
    that end at a blank cell: what stands below an empty row is none of theirs.
    """
    if dict(rows.dtypes)["cells"].startswith("array"):  # one array of whole cells; nothing is known of the rows above
        parts = [F.col(f"cells.{part}").alias(f"{part}s") for part in ("col", "ctype", "raw")]
        rows = rows.withColumn("cells", F.struct(*parts, F.lit(None).cast("int").alias("since")))
    specs: dict[int, dict] = {}
    for s in slots:
        spec = specs.setdefault(s["table_id"], {
            "table_id": s["table_id"], "sheet": s["sheet"], "low": s["first_row"], "high": s["last_row"], "own": [False] * width,
            "at": [None] * width, "stop": None, "skip": None, "blank_from": blank_from.get(s["table_id"])})
        spec["low"], spec["high"] = min(spec["low"], s["first_row"]), max(spec["high"], s["last_row"])
        address = {k: s[k] for k in ("col", "first_row", "last_row")}
        if s["role"] in ("stop", "skip"):
            spec[s["role"]] = address
        else:
            spec["at"][s["slot"]], spec["own"][s["slot"]] = address, s["role"] in ("value", "fixed")
    rules = rule_frame(
        rows.sparkSession, list(specs.values()),
        f"table_id int, sheet string, low int, high int, own array<boolean>, at array<{_ADDRESS}>, stop {_ADDRESS}, skip {_ADDRESS}, blank_from int")
    met = rows.alias("c").join(
        rules.alias("s"), (F.col("c.sheet") == F.col("s.sheet")) & F.col("c.row").between(F.col("s.low"), F.col("s.high"))
        & (F.col("s.blank_from").isNull() | F.coalesce(F.col("c.cells.since") <= F.col("s.blank_from"), F.lit(True))))

    # One step after the other, so that each cell is looked up and told from a blank one once.
    addresses = {f"s{i}": F.col("at")[i] for i in range(width)} | {f"_{role}": F.col(role) for role in ("stop", "skip") if role in roles}
    near = {n: F.array_position("cells.cols", at["col"]) for n, at in addresses.items()}
    if roles & {"fixed", "meta"}:  # others have the rows of their table, which the join has tested
        near = {n: F.when(F.col("row").between(addresses[n]["first_row"], addresses[n]["last_row"]), at) for n, at in near.items()}
    keys = ["workbook_id", "table_id", "row"] + (["own"] if "meta" in roles else [])
    placed = met.select(*keys, "cells", *[at.cast("int").alias(n) for n, at in near.items()])  # columns ascend: one stands there once

    def part(name: str, n: str) -> Column:
        return F.get(f"cells.{name}", F.col(n) - 1)

    found = placed.select(
        *keys, *[part("raws", n).alias(n) for n in addresses], *[part("ctypes", f"s{i}").alias(f"_type{i}") for i in range(width)])
    picked = [F.when(~is_blank(F.col(f"s{i}")), F.struct(F.col(f"_type{i}").alias("ctype"), F.col(f"s{i}").alias("raw"))) for i in range(width)]
    names = list(addresses)
    texts = [F.when(~is_blank(F.col(n)), norm(F.col(n))).alias(n) for n in names[width:]]
    hits = found.select(*keys, *[cell.alias(f"s{i}") for i, cell in enumerate(picked)], *texts, F.monotonically_increasing_id().alias("_at"))
    data = [F.col(f"s{i}").isNotNull() for i in range(width)]
    data = [F.col("own")[i] & filled for i, filled in enumerate(data)] if "meta" in roles else data
    # A condition that names ``_at`` stays above the steps; else they would be done for it once more.
    kept = F.coalesce(*[F.when(F.col(n).isNotNull(), True) for n in names]) & (F.col("_at") >= 0)
    return hits.where(kept).select("workbook_id", "table_id", "row", functools.reduce(operator.or_, data).alias("_data"), *names)


def table_records(cells: DataFrame, tables: Sequence[dict], scalars: Sequence[dict] = ()) -> DataFrame:
    """(workbook_id, table_id, row, s0 .. sN) for all given tables at once, from cells or
    from the rows of a scan by row."""
    tables = [t for t in tables if t["stop"] != "range"]
    slots = [s for t in tables for s in _slots(t, section_metadata(t, scalars))]
    width = 1 + max((s["slot"] for s in slots), default=0)
    roles = {s["role"] for s in slots}
    carried = bool(roles & {"fixed", "meta"})
    if "cells" in cells.columns:
        far = {s["table_id"] for s in slots if s["role"] in ("fixed", "meta")}  # their cells may stand anywhere
        blank_from = {t["table_id"]: t["first_row"] for t in tables if t["stop"] == "blank" and t["table_id"] not in far}
        hits = _row_hits(cells, slots, width, roles, blank_from).repartition("workbook_id")
        records = hits.groupBy(*_KEYS).agg(*[F.max(n).alias(n) for n in hits.columns if n not in _KEYS])
    else:
        records = _cell_records(cells, slots, width, roles)

    whole = Window.partitionBy("workbook_id", "table_id").orderBy("row")
    running = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    keep = F.col("_data")

    def tables_with(test) -> list[int]:
        return [t["table_id"] for t in tables if test(t)]

    windows: dict[str, Column] = {}  # evaluated together: one window operator
    if "stop" in roles:
        labels = {}
        for t in tables:
            if t["stop"] == "label":
                labels.setdefault(t["stop_label"], []).append(t["table_id"])
        at_label = F.lit(False)
        for label, ids in labels.items():
            at_label = at_label | (F.col("table_id").isin(ids) & F.coalesce(F.col("_stop") == label, F.lit(False)))
        windows["_seen"] = F.count("_stop").over(running)
        windows["_ended"] = F.max(at_label).over(running)
        starts = {}
        for t in tables:
            if t["stop"] == "blank":
                starts.setdefault(t["first_row"], []).append(t["table_id"])
        for first, ids in starts.items():
            keep = keep & (~F.col("table_id").isin(ids) | (F.col("_seen") == F.col("row") - F.lit(first - 1)))
        keep = keep & ~F.col("_ended")
    carried_slots: dict[int, list[int]] = {}
    for s in slots:
        if s["role"] in ("fixed", "meta"):
            carried_slots.setdefault(s["slot"], []).append(s["table_id"])
    for slot, ids in carried_slots.items():
        name = f"s{slot}"
        spread = F.max(F.when(F.col("table_id").isin(ids), F.col(name))).over(everything)
        windows[name] = F.when(F.col("table_id").isin(ids), spread).otherwise(F.col(name))
    if windows:
        records = records.withColumns(windows)
    if carried:
        bounds: dict[tuple[int, int], list[int]] = {}
        for t in tables:
            bounds.setdefault((t["first_row"], _last_row(t)), []).append(t["table_id"])
        inside = F.lit(False)
        for (first, last), ids in bounds.items():
            inside = inside | (F.col("table_id").isin(ids) & F.col("row").between(first, last))
        keep = keep & inside
    if "skip" in roles:
        for t in tables:
            if t["skip_col"] is not None:
                skipped = F.coalesce(F.col("_skip"), F.lit("")).isin(t["skip_values"])
                keep = keep & ~((F.col("table_id") == t["table_id"]) & skipped)
    return records.where(keep).select(*_KEYS, *[f"s{i}" for i in range(width)])


def _typed(cell: Column | None, column: dict) -> Column:
    """Value of a cell by the column's settings; a blank one takes the default."""
    raw = F.lit(None).cast("string") if cell is None else cell["raw"]
    ctype = F.lit(None).cast("string") if cell is None else cell["ctype"]
    if column.get("default") is not None:
        raw = F.when(~is_blank(raw), raw).otherwise(F.lit(str(column["default"])))
        ctype = F.coalesce(ctype, F.lit("text"))
    if column["normalize"]:
        raw = F.when(~is_blank(raw), normalize(raw, column["normalize"]))
    return convert.convert(raw, ctype, column["dtype"], column["locale_safe"], column["bool_map"])


def _with_found_metadata(rows: DataFrame, metadata: Sequence[dict], values: DataFrame | None) -> DataFrame:
    """Adds metadata that stands at no fixed cell (lists, label and name searches) from
    the scalar records: one row per workbook is joined."""
    if not metadata:
        return rows
    if values is None:  # no records at hand: lists are empty, others have their default
        constants = {m["name"]: F.lit("[]") if m["dtype"] in LIST_TYPES else _typed(None, m) for m in metadata}
        return rows.withColumns(constants)
    own = values.where(F.col("seq").isin([m["seq"] for m in metadata])).groupBy("workbook_id").agg(
        *[F.max(F.when(F.col("seq") == m["seq"], F.col("value"))).alias(f"_m{i}") for i, m in enumerate(metadata)])
    joined = rows.join(own, "workbook_id", "left")
    columns = {}
    for i, m in enumerate(metadata):
        found = F.col(f"_m{i}")
        plain = {**m, "normalize": None, "default": None}
        columns[m["name"]] = found if m["dtype"] in LIST_TYPES else _typed(F.struct(F.lit("text").alias("ctype"), found.alias("raw")), plain)
    return joined.withColumns(columns).drop(*[f"_m{i}" for i in range(len(metadata))])


def _at_a_cell(scalar: dict) -> bool:
    return scalar["how"] == "point"


def typed_table(
    records: DataFrame, rule: dict, scalars: Sequence[dict] = (), inject: dict | None = None, values: DataFrame | None = None
) -> DataFrame:
    """Typed rows of one table: a narrow projection of its records.

    ``values`` are the scalar records; they give the section's metadata that stands at no
    fixed cell.
    """
    metadata = section_metadata(rule, scalars)
    out = []
    for slot, column in enumerate([*rule["columns"], *metadata]):
        if not _at_a_cell({"how": "point", **column}):
            continue
        cell = F.col(f"s{slot}") if column["col"] is not None and f"s{slot}" in records.columns else None
        out.append(_typed(cell, column).alias(column["name"]))
    rows = records.where(F.col("table_id") == rule["table_id"]).select("workbook_id", "row", *out)
    rows = _with_found_metadata(rows, [m for m in metadata if not _at_a_cell(m)], values)
    return rows.select("*", *[F.lit(v).alias(k) for k, v in (inject or {}).items() if k not in rows.columns])


def range_metadata(rows: DataFrame, cells: DataFrame, rule: dict, scalars: Sequence[dict], values: DataFrame | None = None) -> DataFrame:
    """Adds the section's metadata to the rows of a range table: a lookup of a few cells
    per workbook, joined by workbook."""
    metadata = [m for m in section_metadata(rule, scalars) if m["name"] not in rows.columns]
    points = [m for m in metadata if _at_a_cell(m)]
    if points:
        at = {(m["row"], m["col"]) for m in points}
        wanted = functools.reduce(operator.or_, [(F.col("row") == r) & (F.col("col") == c) for r, c in sorted(at)])
        cell = F.struct("ctype", "raw")
        found = cells.where((F.col("sheet") == rule["sheet_name"]) & wanted & ~is_blank(F.col("raw"))).groupBy("workbook_id").agg(
            *[F.max(F.when((F.col("row") == m["row"]) & (F.col("col") == m["col"]), cell)).alias(f"_p{i}") for i, m in enumerate(points)])
        rows = rows.join(found, "workbook_id", "left").withColumns(
            {m["name"]: _typed(F.col(f"_p{i}"), m) for i, m in enumerate(points)}).drop(*[f"_p{i}" for i in range(len(points))])
    return _with_found_metadata(rows, [m for m in metadata if not _at_a_cell(m)], values)


def header_range(cells: DataFrame, rule: dict) -> DataFrame:
    """Range with a header row: rows without data and columns without any value go,
    the surviving columns are matched to the configured ones by position.

    Without configured columns the result is long: (row, position, header, value).
    The group per workbook is bounded by the range.
    """
    left, right, top, bottom = rule["first_col"], rule["last_col"], rule["first_row"], rule["last_row"]
    spots = range(left, right + 1)
    box = cells.where(
        (F.col("sheet") == rule["sheet_name"]) & F.col("row").between(top, bottom) & F.col("col").between(left, right)
    ).repartition("workbook_id")
    cell = F.struct("ctype", "raw")
    rows = box.groupBy("workbook_id", "row").agg(
        *[F.max(F.when(F.col("col") == c, cell)).alias(f"c{c}") for c in spots],
        F.max(~is_blank(F.col("raw"))).alias("_data"),
    )
    every = Window.partitionBy("workbook_id")
    body = F.col("_data") & (F.col("row") > top)
    flags = {f"_live{c}": F.max(body & F.col(f"c{c}").isNotNull()).over(every) for c in spots}
    heads = {f"_head{c}": F.max(F.when(F.col("row") == top, F.col(f"c{c}.raw"))).over(every) for c in spots}
    kept = rows.withColumns({**flags, **heads}).where(body)
    packed = F.filter(
        F.array(*[
            F.struct(
                F.col(f"_live{c}").alias("live"),
                F.coalesce(strip(F.col(f"_head{c}")), F.lit(f"Column_{c}")).alias("header"),
                F.col(f"c{c}").alias("cell"),
            )
            for c in spots
        ]),
        lambda x: x["live"],
    )
    kept = kept.select("workbook_id", "row", packed.alias("packed"))
    if not rule["columns"]:
        return kept.select("workbook_id", "row", F.posexplode("packed").alias("position", "item")).select(
            "workbook_id", "row", (F.col("position") + 1).alias("position"),
            F.col("item.header").alias("header"), F.col("item.cell.raw").alias("value"),
        )
    out = []
    for i, column in enumerate(rule["columns"]):
        item = F.get("packed", i)["cell"]
        raw = item["raw"]
        if column["normalize"]:
            raw = F.when(~is_blank(raw), normalize(raw, column["normalize"]))
        value = convert.convert(raw, item["ctype"], column["dtype"], column["locale_safe"], column["bool_map"])
        out.append(value.alias(column["name"]))
    return kept.select("workbook_id", "row", *out)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with different columns; what one lacks is null.

    A column that is text in one table and typed in another becomes text: a silent
    cast of text to a number would fail the whole job under ANSI mode.
    """
    types: dict[str, set[str]] = {}
    for frame in frames:
        for name, dtype in frame.dtypes:
            types.setdefault(name, set()).add(dtype)
    mixed = {name for name, found in types.items() if len(found) > 1 and "string" in found}
    out = None
    for frame in frames:
        plain = {n: F.col(f"`{n}`").cast("string") for n in frame.columns if n in mixed}
        part = frame.withColumns(plain) if plain else frame
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def all_tables(
    cells: DataFrame, records: DataFrame, tables: Sequence[dict], scalars: Sequence[dict], sheets: Sequence[dict],
    values: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Table key -> rows, the sheets that feed one key being unioned by name."""
    inject = {s["sheet_id"]: s["inject"] for s in sheets if s["extract"]}
    grouped: dict[str, list[DataFrame]] = {}
    for rule in tables:
        if rule["sheet_id"] not in inject:
            continue
        if rule["stop"] == "range":
            rows = range_metadata(header_range(cells, rule), cells, rule, scalars, values)
            for key, value in inject[rule["sheet_id"]].items():
                rows = rows if key in rows.columns else rows.withColumn(key, F.lit(value))
        else:
            rows = typed_table(records, rule, scalars, inject[rule["sheet_id"]], values)
        rows = rows.withColumn("sheet_id", F.lit(rule["sheet_id"])) if "sheet_id" not in rows.columns else rows
        grouped.setdefault(rule["table_key"], []).append(rows)
    return {key: union_by_name(frames) for key, frames in grouped.items()}
