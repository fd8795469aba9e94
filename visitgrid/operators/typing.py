"""Type inference over whole tables, and preparation of columns for export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import as_int_or_null, parse_date_text, parse_number
from ..functions.names import sanitized
from ..functions.text import strip

# Columns that are whole numbers in every export, the number that
# stands for "none" in stored tables, and the share below which a text column
# counts as a category.
WHOLE_NUMBER_COLUMNS = ("QAID", "hospital_id", "system_id", "n_fields", "n_tables", "n_named_results")
NONE_NUMBER = -123456789
CATEGORY_SHARE = 0.5


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _is_time_name(name: str) -> bool:
    return "date" in name.lower() or "time" in name.lower()


def type_profile(df: DataFrame) -> DataFrame:
    """One row per text column: does every value parse as a number or a date?

    All columns are profiled in one aggregate with one output row.
    """
    aggregates = []
    for name in _text_columns(df):
        value = F.col(f"`{name}`")
        aggregates.append(F.struct(
            F.lit(name).alias("column_name"),
            F.count(value).alias("filled"),
            F.count_if(value.isNotNull() & parse_number(strip(value)).isNull()).alias("not_numeric"),
            (F.count_if(value.isNotNull() & parse_date_text(value).isNull()) if _is_time_name(name)
             else F.count(value)).alias("not_date"),
        ))
    if not aggregates:
        raise ValueError("the table has no text column")
    profile = df.agg(F.array(*aggregates).alias("p")).select(F.inline("p"))
    kind = (
        F.when(F.col("not_numeric") == 0, "double").when(F.col("not_date") == 0, "timestamp_ntz").otherwise("string")
    )
    return profile.select("column_name", "filled", "not_numeric", kind.alias("inferred"))


def with_inferred_types(df: DataFrame) -> DataFrame:
    """Cast text columns whose every value is a number, or a date in a date column."""
    found = {r["column_name"]: r["inferred"] for r in type_profile(df).collect()} if _text_columns(df) else {}
    casts = {}
    for name, kind in found.items():
        value = F.col(f"`{name}`")
        if kind == "double":
            casts[name] = parse_number(strip(value))
        elif kind == "timestamp_ntz":
            casts[name] = parse_date_text(value)
    return df.withColumns(casts) if casts else df


def distinct_ratio(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values over rows per column, and whether it counts as a category.

    One distinct count per column is unpivoted first: rows are combined on
    (column, value) before the shuffle, so a frequent value costs one row per task.
    """
    names = list(columns or _text_columns(df))
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("string").alias("value")) for n in names
    ])).alias("p")).select("p.*")
    per_value = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    ratio = F.col("distinct_values") / F.col("rows")
    return (
        per_value.groupBy("column_name")
        .agg(F.count("value").alias("distinct_values"), F.sum("n").alias("rows"))
        .withColumn("is_category", ratio < CATEGORY_SHARE)
    )


def table_info(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and types per table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            F.lit(",".join(df.columns)).alias("columns"),
            F.lit(",".join(t for _, t in df.dtypes)).alias("dtypes"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def export_value(name: str, dtype: T.DataType) -> Column:
    """Export form of a column: nested values as JSON, id columns whole numbers."""
    value = F.col(f"`{name}`")
    if name in WHOLE_NUMBER_COLUMNS:
        return as_int_or_null(value.cast("string")).alias(name)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"}).alias(name)
    return value.alias(name)


def prepare_export(df: DataFrame) -> DataFrame:
    named = sanitized(df)
    return named.select(*[export_value(f.name, f.dataType) for f in named.schema])


def none_number_to_null(df: DataFrame) -> DataFrame:
    """The stored stand-in for "none" becomes null in every numeric column."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({n: F.when(F.col(f"`{n}`") != NONE_NUMBER, F.col(f"`{n}`")) for n in numeric})


def where_equal(df: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``column=value`` filters, all of which must hold; values compare as text."""
    for text in filters:
        name, sep, value = text.partition("=")
        if sep:
            df = df.where(F.col(f"`{name}`").cast("string") == value)
    return df
