"""Text helpers shared by all cleaning functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that count as white space at the edge of a cell text.
EDGE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing white space, not only spaces."""
    return F.btrim(c, F.lit(EDGE_SPACE))


def norm(c: Column) -> Column:
    """Comparison form of a cell text: stripped and lower-cased, null becomes ''."""
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null and for text that holds only white space.

    A text that begins with a visible ASCII character is told by that character.
    """
    return c.isNull() | (~((c >= "!") & (c < "\x7f")) & (strip(c) == ""))


def title_case(c: Column) -> Column:
    """Capitalise each run of letters: "o'neil mc-donald" -> "O'Neil Mc-Donald".

    ``initcap`` only looks at white space, so a marked space is put before each
    run of cased letters and taken out again.
    """
    marked = F.regexp_replace(c, r"([\p{Lu}\p{Ll}\p{Lt}]+)", "\u0001 $1")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def capitalize(c: Column) -> Column:
    rest = F.substring(c, F.lit(2), F.length(c))
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(rest))


def clean_file_name(c: Column) -> Column:
    """Replace characters that file systems refuse by underscores."""
    bad = '<>:"/\\|?*'
    return F.translate(c, bad, "_" * len(bad))


def hash16(c: Column) -> Column:
    """First 16 hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(c.cast("binary"), 256), 1, 16)


def sheet_list_hash(sheets: Column) -> Column:
    """Fingerprint of a workbook: hash of its sheet names joined by a pipe."""
    return hash16(F.concat_ws("|", sheets))


def base_name(path: Column) -> Column:
    """Last part of a path; back slashes count as separators."""
    return F.element_at(F.split(F.regexp_replace(path, r"\\", "/"), "/"), -1)


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor the empty text."""
    return F.coalesce(*[F.when(c != "", c) for c in cols])
