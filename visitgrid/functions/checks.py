"""Validation rules as boolean columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .convert import parse_number
from .text import strip

# Inclusive limits per dose quantity and per phantom material.
DOSE_LIMITS = {
    "ctdi_vol": (0, 200),
    "dlp": (0, 5000),
    "dose_central": (0, 1000),
    "kv": (70, 150),
    "mas": (10, 1000),
}
HU_LIMITS = {
    "air": (-1000, -900),
    "water": (-10, 10),
    "pmp": (-250, -150),
    "ldpe": (-120, -80),
    "polystyrene": (-50, -20),
    "acrylic": (100, 140),
    "delrin": (300, 380),
    "teflon": (900, 1100),
}


def in_range(number: Column, low: float, high: float) -> Column:
    """Inclusive range; NaN and null are outside (Spark sorts NaN above all numbers)."""
    return F.coalesce(~F.isnan(number) & number.between(low, high), F.lit(False))


def text_in_range(text: Column, low: float, high: float) -> Column:
    return in_range(parse_number(strip(text)), low, high)


def matches(text: Column, pattern: str) -> Column:
    """Regex anchored at the start; a pattern that does not compile fails all rows."""
    try:
        re.compile(pattern)
    except re.error:
        return F.lit(False)
    return text.rlike(f"^(?:{pattern})")


def length_between(text: Column, bounds: Mapping[str, int]) -> Column:
    ok = F.length(text) >= F.lit(bounds.get("min", 0))
    return ok & (F.length(text) <= F.lit(bounds["max"])) if "max" in bounds else ok


def check(value: Column, rule: Mapping, numeric: bool = False) -> Column:
    """Apply the first entry of a rule; null is valid unless the rule says required."""
    kind, arg = next(iter(rule.items()))
    text = value.cast("string")
    if kind == "range":
        usable = isinstance(arg, Sequence) and not isinstance(arg, str) and len(arg) == 2
        if not usable:
            ok = F.lit(False)
        else:
            ok = in_range(value.cast("double"), *arg) if numeric else text_in_range(text, *arg)
    elif kind == "in":
        ok = value.isin(*arg)
    elif kind == "regex":
        ok = matches(text, arg)
    elif kind == "length":
        ok = length_between(text, arg)
    elif kind == "required":
        ok = text != ""
    else:
        ok = F.lit(True)
    return F.when(value.isNull(), F.lit(not rule.get("required", False))).otherwise(ok)


def with_checks(df: DataFrame, rules: Sequence[tuple[str, str, Mapping, bool]], out: str = "checks") -> DataFrame:
    """Add ``array<struct(field, rule, ok)>`` for rules (column, label, rule, numeric)."""
    items = [
        F.struct(
            F.lit(column).alias("field"),
            F.lit(label).alias("rule"),
            check(F.col(column), rule, numeric).alias("ok"),
        )
        for column, label, rule, numeric in rules
    ]
    return df.withColumn(out, F.array(*items))


def within_limits(value: Column, kind: Column, limits: Mapping[str, tuple[float, float]]) -> Column:
    """Inclusive limits looked up by kind; an unknown kind is always fine."""
    chain = None
    for name, (low, high) in limits.items():
        ok = in_range(value, low, high)
        chain = F.when(kind == name, ok) if chain is None else chain.when(kind == name, ok)
    return chain.otherwise(True)
