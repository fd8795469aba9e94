"""Row numbers, overall or per key, without putting a large key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: A key with more rows than this is numbered over several tasks.
HOT_ROWS = 1_000_000
#: ``monotonically_increasing_id`` has the partition above these bits, the place in it below.
_PLACE_BITS = 33
_TIE, _SALT, _AT, _RANGE = "_nested_text", "_copy", "_at", "_range"
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def _by_ranges(df: DataFrame, keys: Sequence[str], out: str, slices: int | None) -> DataFrame:
    """Add ``out`` = 1, 2, 3 ... over all rows in the order of ``keys``.

    Rows are dealt out by ranges of their keys and sorted within each; a row's number is
    its place in its range and the number of rows in all ranges before it.  That offset
    table has a row for each range.  A random last key spreads equal rows over ranges.  Both
    the salted and the sorted rows are written, so a lost executor changes neither.
    """
    salted = materialize(df.withColumn(_SALT, F.rand()), "numbering-salted")
    order = [*keys, _SALT]
    ranged = salted.repartitionByRange(slices, *order) if slices else salted.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).drop(_SALT).withColumn(_AT, F.monotonically_increasing_id())
    placed = materialize(placed, "numbering-ranges").withColumn(_RANGE, F.shiftright(_AT, _PLACE_BITS))
    before = F.sum("_rows").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    sizes = placed.groupBy(_RANGE).agg(F.count(_AT).alias("_rows")).withColumn("_before", F.coalesce(before, F.lit(0)))
    place = F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(F.broadcast(sizes.drop("_rows")), _RANGE).withColumn(out, place + 1 + F.col("_before")).drop(_RANGE, _AT, "_before")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "row_no",
    slices: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``out`` = 1, 2, 3 ... in ascending order of ``order_by`` within each key.

    Without a key, and for keys of more than ``hot_rows`` rows, rows are numbered by
    ranges (``_by_ranges``); such a key's numbers then start at that of its first row.  All
    other keys are numbered by a window.  ``slices`` is the number of ranges; without it
    the session's shuffle partitions and adaptive execution set it.

    The other columns always extend the order, nested ones by their JSON text, so the
    order is total up to rows that are equal in all columns, and which of those gets which
    number makes no difference.
    """
    wanted_columns = [*df.columns, out]
    nested = [f.name for f in df.schema if isinstance(f.dataType, _NESTED)]
    if nested:
        df = df.withColumn(_TIE, F.to_json(F.struct(*nested)))
    keys = [*partition_by, *order_by]
    keys += [c for c in df.columns if c not in keys and c not in nested]
    if not partition_by:
        return _by_ranges(df, keys, out, slices).select(*wanted_columns)

    window = Window.partitionBy(*partition_by).orderBy(*keys)
    plain = F.row_number().over(window).cast("bigint")
    sizes = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    hot = materialize(sizes.select(*partition_by), "numbering-hot-keys")
    if hot.isEmpty():
        return df.withColumn(out, plain).select(*wanted_columns)

    def same(right: str):
        return [F.col(f"d.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in partition_by]

    rows, large = df.alias("d"), hot.alias("h")
    small = rows.join(large, same("h"), "left_anti").withColumn(out, plain)
    ranked = _by_ranges(rows.join(large, same("h"), "left_semi"), keys, "_overall", slices)
    first = ranked.groupBy(*partition_by).agg(F.min("_overall").alias("_first"))  # a row for each hot key
    ranked = ranked.alias("d").join(first.alias("f"), same("f")).select("d.*", (F.col("_overall") - F.col("_first") + 1).alias(out))
    return small.select(*wanted_columns).unionByName(ranked.select(*wanted_columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by a total order, as a partially combined aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
    )


def visit_ids(paths: DataFrame, path: str = "source_path", out: str = "qaid", base: int = 0) -> DataFrame:
    """Visit id = position in path order, after ``base``.

    Paths are ordered by their parts: the separator sorts before any other character.
    """
    parts = paths.withColumn("_parts", F.translate(path, "/", "\x01"))
    return number_rows(parts, ["_parts"], out=out).withColumn(out, F.col(out) + F.lit(base)).drop("_parts")


def next_id_base(visits: DataFrame, column: str = "ID") -> int:
    """Largest id in use (0 when there is none): new ids start after it."""
    return visits.agg(F.max(column)).first()[0] or 0


def number_names(df: DataFrame, name: str, order_by: Sequence[str], out: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Repeats of a name, in order, become ``name_2``, ``name_3`` ..."""
    numbered = number_rows(df, order_by, [*partition_by, name], out="_nth")
    label = F.concat(F.col(name), F.lit("_"), F.col("_nth").cast("string"))
    return numbered.withColumn(out, F.when(F.col("_nth") == 1, F.col(name)).otherwise(label)).drop("_nth")
