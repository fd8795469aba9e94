"""Unit conversion by fixed factor tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factor per named conversion and per (from, to) pair.
FACTORS = {
    "mGy_to_cGy": 0.1,
    "cGy_to_mGy": 10,
    "mGy_to_Gy": 0.001,
    "Gy_to_mGy": 1000,
    "cm_to_mm": 10,
    "mm_to_cm": 0.1,
    "mAs_to_As": 0.001,
    "As_to_mAs": 1000,
}
DOSE_FACTORS = {
    ("mGy", "cGy"): 0.1,
    ("cGy", "mGy"): 10,
    ("mGy", "Gy"): 0.001,
    ("Gy", "mGy"): 1000,
    ("mGy.cm", "Gy.cm"): 0.001,
    ("Gy.cm", "mGy.cm"): 1000,
}


def hu_to_linear(value: Column) -> Column:
    """Hounsfield units -> simplified linear attenuation coefficient."""
    return (value / 1000) * 0.2 + 0.2


def convert_unit(value: Column, conversion: Column) -> Column:
    """Number times the factor of the named conversion; unknown names change nothing."""
    chain = F.when(conversion == "hu_to_linear", hu_to_linear(value))
    for name, factor in FACTORS.items():
        chain = chain.when(conversion == name, value * F.lit(float(factor)))
    return chain.otherwise(value)


def convert_unit_text(text: Column, conversion: Column, parse) -> Column:
    """Text form: what is not a number, or has no known conversion, stays as written."""
    number = parse(text)
    known = conversion.isin("hu_to_linear", *FACTORS)
    return F.when(number.isNotNull() & known, convert_unit(number, conversion).cast("string")).otherwise(text)


def convert_dose(value: Column, unit_from: Column, unit_to: Column) -> Column:
    chain = None
    for (source, target), factor in DOSE_FACTORS.items():
        hit = (unit_from == source) & (unit_to == target)
        scaled = value * F.lit(float(factor))
        chain = F.when(hit, scaled) if chain is None else chain.when(hit, scaled)
    return chain.otherwise(value)
