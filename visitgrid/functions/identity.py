"""Visit identity: numbers read from references and file names, and the visit year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import PLAIN_NUMBER_TEXT, as_int_or_null
from .text import base_name, first_present, strip

# How the site, the device number and the system number are written.
DEVICE_PATTERN = r"(?iU)(\d+)\s*CT\b"
HOSPITAL_PATTERN = r"(?iU)\bQC0*(\d+)_"
SYSTEM_PATTERN = r"(?i)_\d{3,}CT[-_ ]*[A-Za-z]*?(\d+)\s*(?:\.[^.]+)?$"


def _drop_leading_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, r"^0+(?=\d)", "")


def _digits(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", _drop_leading_zeros(found))


def normalize_device_number(value: Column) -> Column:
    """Canonical device number: a whole number without leading zeros, else the
    digits before ``CT``, else null."""
    text = strip(value.cast("string"))
    number = F.when(text.rlike(PLAIN_NUMBER_TEXT), text.try_cast("double"))
    whole = number == F.floor(number)
    as_text = F.when(whole, number.try_cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
    return F.when(number.isNotNull(), as_text).otherwise(_digits(text, DEVICE_PATTERN))


def derive_device_number(*candidates: Column) -> Column:
    """First candidate (fields, references, file name) that gives a device number."""
    return F.coalesce(*[normalize_device_number(c) for c in candidates])


def batch_device_number(references: list[Column], path: Column) -> Column:
    """Batch rule: the first reference that is present, then the file name."""
    return F.coalesce(
        normalize_device_number(first_present(*references)), normalize_device_number(base_name(path))
    )


def hospital_id(path: Column, *fields: Column) -> Column:
    """File name first, then the first field that is present."""
    from_name = _digits(base_name(path), HOSPITAL_PATTERN).try_cast("bigint")
    return F.coalesce(from_name, as_int_or_null(first_present(*fields))) if fields else from_name


def system_id(path: Column, *fields: Column) -> Column:
    """First field that is present, then the file name."""
    from_name = _digits(base_name(path), SYSTEM_PATTERN).try_cast("bigint")
    return F.coalesce(as_int_or_null(first_present(*fields)), from_name) if fields else from_name


def visit_year(date_text: Column, processed_text: Column) -> Column:
    """Year used for partitioning, from the test date or the processing stamp."""
    return F.coalesce(
        F.when(date_text.contains("-"), F.split(date_text, "-")[0]).when(
            date_text.contains("/"), F.element_at(F.split(date_text, "/"), -1)
        ),
        F.when(processed_text != "", F.substring(processed_text, 1, 4)),
        F.year(F.current_date()).cast("string"),
    )
