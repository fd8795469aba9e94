"""Typing of cell values.

A cell travels as two columns: ``raw`` (its exact text) and ``ctype`` (``int``,
``float``, ``bool``, ``date``, ``time`` or ``text``).  ``ctype`` may be left out
for plain text columns.  Every function gives null instead of failing, so one bad
cell never stops a job that runs with ANSI mode on.  Expressions are kept small:
they are repeated per column and have to fit into generated code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank, norm, strip

NUMBER_TEXT = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)$"
_USUAL_NUMBER = r"^-?[0-9]+(?:\.[0-9]+)?\z"  # this spelling skips all clean-up
PLAIN_NUMBER_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"

# The words for true and false.
TRUE_WORDS = ("true", "1", "yes", "y", "ja", "oui", "vrai")
FALSE_WORDS = ("false", "0", "no", "n", "nee", "non", "faux")

EXCEL_DAY_ZERO = "1899-12-30 00:00:00"
_DAY_MS = 86_400_000


def parse_number(text: Column) -> Column:
    """Strict number text -> double.

    Spark alone would also read ``12d`` and ``0x1p3``, hence the pattern before
    the cast.
    """
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def to_float(raw: Column, locale_safe: Column | bool = False) -> Column:
    """Cell -> double; a percent sign is dropped, a lone decimal comma is a point.

    Text without a number (``nvt``, ``n/a`` ...) is null, and so is text with both a
    point and a comma: it ends up with two points.
    """
    bare = strip(F.replace(raw, F.lit("%"), F.lit("")))
    loose = bare.contains(",")
    if isinstance(locale_safe, Column):
        loose = loose | locale_safe
    elif locale_safe:
        loose = F.lit(True)
    cleaned = parse_number(F.when(loose, F.translate(bare, ",  ", ".")).otherwise(bare))
    return F.when(raw.rlike(_USUAL_NUMBER), raw.try_cast("double")).otherwise(cleaned)


def truncate(number: Column) -> Column:
    """Double -> bigint toward zero; NaN, infinite and too large give null."""
    return number.try_cast("bigint")


def to_int(raw: Column, locale_safe: Column | bool = False) -> Column:
    return truncate(to_float(raw, locale_safe))


def to_bool(
    raw: Column,
    ctype: Column | None = None,
    bool_map: Mapping[str, bool] | Column | None = None,
) -> Column:
    """Cell -> boolean: own words first, then the fixed word lists, else null.

    Number cells are compared by their text, so 1 is true and 1.0 is not.
    """
    word = norm(raw)
    value = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if isinstance(bool_map, Column):
        value = F.coalesce(F.try_element_at(bool_map, word), value)
    elif bool_map:
        words = {str(k).strip().lower(): bool(v) for k, v in bool_map.items()}
        yes, no = [k for k, v in words.items() if v], [k for k, v in words.items() if not v]
        value = F.when(word.isin(yes), True).when(word.isin(no), False).otherwise(value)
    if ctype is not None:
        value = F.when(ctype == "bool", word == "true").otherwise(value)
        of_bool = ctype == "bool"  # as truth cells are spelled by the scan
        return F.when(of_bool & (raw == "True"), True).when(of_bool & (raw == "False"), False).when(raw.isNotNull(), value)
    return F.when(raw.isNotNull(), value)


# --- dates ------------------------------------------------------------------

# English month names, as far as a date text may use them.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = "(" + "|".join(MONTHS) + r")(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\.?"
_END = r"(?=$|[t ])"
_WORD_REWRITES = (
    (rf"^(\d{{1,2}})[-/. ]+{_MONTH}[-/., ]+(\d{{4}})$", "$3-$2-$1"),
    (rf"^{_MONTH}[ ]+(\d{{1,2}}),? +(\d{{4}})$", "$3-$1-$2"),
)
_NUMBER_REWRITES = (  # to year-month-day; what one has rewritten the others leave alone
    (rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){_END}", "$1-$2-$3"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_END}", "$1-$2-$3"),
    (rf"^(\d{{1,2}})[-/. ](\d{{1,2}})[-/. ](\d{{4}}){_END}", "$3-$2-$1"),
    (rf"^(\d{{1,2}})[-/. ](\d{{1,2}})[-/. ]([7-9]\d|69){_END}", "19$3-$2-$1"),
    (rf"^(\d{{1,2}})[-/. ](\d{{1,2}})[-/. ](\d{{2}}){_END}", "20$3-$2-$1"),
    (rf"^(\d{{4}})-(1[3-9]|2\d|3[01])-(0?[1-9]|1[0-2]){_END}", "$1-$3-$2"),
    (r"(\d)t(\d)", "$1 $2"),
)
_WHOLE_DAY = r"^\d{4}-\d{2}-\d{2} 00:00:00\z"
_PLAIN_ISO = r"^\d{4}-(?:0\d|1[0-2])-\d{2}$"  # the common spelling skips all rewriting
_DATE_SHAPE = r"^\d{4}(?:-\d{1,2}(?:-\d{1,2}(?: .*)?)?)?$"


def parse_date_text(raw: Column) -> Column:
    """Day-first date text -> timestamp without zone, null when it is not a date.

    A date whose month number is too large is read month-first.  The rewrites are one
    chain, so the input is not repeated in the expression.
    """
    plain = raw.rlike(_PLAIN_ISO)
    text = F.lower(strip(raw))
    for pattern, order in _WORD_REWRITES:
        text = F.regexp_replace(text, pattern, order)
    for number, name in enumerate(MONTHS, start=1):
        text = F.replace(text, F.lit(f"-{name}-"), F.lit(f"-{number}-"))
    for pattern, order in _NUMBER_REWRITES:
        text = F.regexp_replace(text, pattern, order)
    usual = F.when(plain, raw).otherwise(F.regexp_extract(text, _DATE_SHAPE, 0))
    return usual.try_cast("timestamp_ntz")


def iso_stamp(ts: Column) -> Column:
    """Zone-free timestamp -> ``YYYY-MM-DDTHH:MM:SS[.ffffff]``."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    padded = F.regexp_replace(text, r"(\.\d+)$", "$1000000")
    return F.regexp_replace(padded, r"(\.\d{6})\d+$", "$1")


def serial_stamp(serial: Column) -> Column:
    """Excel day number -> zone-free timestamp; the missing leap day of 1900 is skipped."""
    ms = F.bround(serial * _DAY_MS, 0).try_cast("bigint")
    days = F.floor(ms / _DAY_MS) + F.when((serial > 0) & (serial < 60), 1).otherwise(0)
    step = F.make_dt_interval(days=days.cast("int"), secs=(F.pmod(ms, F.lit(_DAY_MS)) / 1000).cast("decimal(18,6)"))
    return F.when(serial.between(-693593, 2958465), F.lit(EXCEL_DAY_ZERO).cast("timestamp_ntz") + step)


def _temporal_text(raw: Column, ctype: Column | None, with_time: bool) -> Column:
    def shown(ts: Column) -> Column:
        return iso_stamp(ts) if with_time else ts.cast("date").cast("string")

    if ctype is None:
        return F.coalesce(shown(parse_date_text(raw)), raw)
    is_number = ctype.isin("int", "float", "bool")
    serial = F.when(ctype == "bool", (F.lower(raw) == "true").cast("double")).otherwise(raw.try_cast("double"))
    only_clock = is_number & (serial >= 0) & (serial < 0.999999994)
    stamp = (
        F.when(is_number, serial_stamp(serial))
        .when(ctype == "date", raw.try_cast("timestamp_ntz"))
        .when(ctype == "text", parse_date_text(raw))
    )
    return F.when(only_clock, F.substring(iso_stamp(serial_stamp(serial)), 12, 15)).otherwise(
        F.coalesce(shown(stamp), F.when(~is_number, raw))
    )


def to_date(raw: Column, ctype: Column | None = None) -> Column:
    """Cell -> ISO date text; text that is no date is kept as it is."""
    if ctype is None:
        return _temporal_text(raw, ctype, with_time=False)
    # Days as the scan spells them, and texts in the usual spelling.  The way of all others is
    # long; within a function of an array it is no part of the generated code, which the JVM
    # compiles only up to a size.
    usual = ((ctype == "date") & raw.rlike(_WHOLE_DAY)) | ((ctype == "text") & raw.rlike(_PLAIN_ISO))
    day = F.when(usual, F.substring(raw, 1, 10).try_cast("date")).cast("string")
    cell = F.array(F.struct(raw.alias("raw"), ctype.alias("ctype")))
    return F.coalesce(day, F.get(F.transform(cell, lambda x: _temporal_text(x["raw"], x["ctype"], with_time=False)), 0))


def to_datetime(raw: Column, ctype: Column | None = None) -> Column:
    """Cell -> ISO date-time text; text that is no date is kept as it is."""
    return _temporal_text(raw, ctype, with_time=True)


# --- tolerant casts -----------------------------------------------------------


def safe_float(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(parse_number(strip(text)), F.lit(default))


def safe_int(text: Column, default: int = 0) -> Column:
    return F.coalesce(truncate(parse_number(strip(text))), F.lit(default).cast("bigint"))


def as_int_or_null(text: Column) -> Column:
    """Number text -> bigint by truncation, anything else null."""
    return truncate(parse_number(strip(text)))


# --- dispatch by declared type --------------------------------------------------

FLOAT_TYPES = ("float", "number")
STRING_TYPES = ("string", "str")
BOOL_TYPES = ("bool", "boolean")


def convert(raw: Column, ctype: Column | None, dtype: str, locale_safe=False, bool_map=None) -> Column:
    """Typed column for one declared dtype (the dtype is known on the driver)."""
    if dtype in FLOAT_TYPES:
        return to_float(raw, locale_safe)
    if dtype == "int":
        return to_int(raw, locale_safe)
    filled = F.when(~is_blank(raw), raw)
    if dtype in STRING_TYPES:
        return strip(filled)
    if dtype in BOOL_TYPES:
        return to_bool(filled, ctype, bool_map)
    if dtype == "date":
        return to_date(filled, ctype)
    if dtype == "datetime":
        return to_datetime(filled, ctype)
    return filled


def convert_long(raw: Column, ctype: Column, dtype: Column, dtypes: set[str], locale_safe: Column, bool_map: Column) -> Column:
    """Text form of the typed value where the dtype is itself a column.

    ``dtypes`` are the dtypes that occur, so that only their branches are built.
    """
    forms = {
        **{t: lambda: to_float(raw, locale_safe).cast("string") for t in FLOAT_TYPES},
        **{t: lambda: strip(raw) for t in STRING_TYPES},
        **{t: lambda: to_bool(raw, ctype, bool_map).cast("string") for t in BOOL_TYPES},
        "int": lambda: to_int(raw, locale_safe).cast("string"),
        "date": lambda: to_date(raw, ctype),
        "datetime": lambda: to_datetime(raw, ctype),
    }
    chain = F.when(strip(raw) == "", None)
    for name in sorted(dtypes & forms.keys()):
        chain = chain.when(dtype == name, forms[name]())
    return chain.otherwise(raw)
