"""Names of columns, tables and files.

Column names of a DataFrame are few and known on the driver; names that are data
are handled by the Column forms.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def standardize(name: str) -> str:
    """``-``, space, ``.`` and ``/`` become ``_``; brackets go."""
    return name.translate(str.maketrans({" ": "_", "-": "_", ".": "_", "/": "_", "(": None, ")": None}))


def standardize_col(c: Column) -> Column:
    return F.translate(c, " -./()", "____")


def sanitize(name: str) -> str:
    """ASCII identifier: accents dropped, other runs ``_``, ``c_`` before a digit."""
    plain = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode()
    words = re.sub(r"_+", "_", re.sub(r"\W+", "_", plain.strip(), flags=re.ASCII)).strip("_") or "column"
    return "c_" + words if words[0].isdigit() else words


@functools.cache
def _fold_tables() -> list[tuple[str, str]]:
    """Tables for ``translate``, one for each place of a result: a character whose
    compatibility decomposition leaves ASCII to what stands there, worked out by rule over
    all of Unicode.  What has nothing at that place stands last, so it is dropped."""
    folded = {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        ascii_form = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if ascii_form:
            folded[chr(code)] = ascii_form
    tables = []
    for place in range(max(map(len, folded.values()))):
        there = {char: form[place] for char, form in folded.items() if len(form) > place}
        gone = [char for char, form in folded.items() if len(form) <= place]
        tables.append(("".join(there) + "".join(gone), "".join(there.values())))
    return tables


def sanitize_col(c: Column) -> Column:
    """Column form of :func:`sanitize`."""
    tables = _fold_tables()

    def spelt(char: Column) -> Column:
        return F.when(char.rlike(r"^[\x00-\x7F]"), char).otherwise(F.concat(*[F.translate(char, *table) for table in tables]))

    # one pass over the characters, and only in names that hold one beyond ASCII; each place
    # of a spelling is looked up in a table, and what has no ASCII form goes afterwards
    outside = c.rlike(r"[^\x00-\x7F]")
    folded = F.regexp_replace(F.array_join(F.transform(F.split(c, ""), spelt), ""), r"[^\x00-\x7F]", "")
    plain = F.trim(F.when(outside, folded).otherwise(c))
    words = F.regexp_replace(F.regexp_replace(plain, r"[^0-9A-Za-z_]+|_+", "_"), "_+", "_")
    named = F.regexp_replace(F.regexp_replace(words, "^_|_$", ""), "^$", "column")
    return F.regexp_replace(named, "^([0-9])", "c_$1")  # each step once: an expression that is used twice is worked out twice


def unique(names: Iterable[str]) -> list[str]:
    """Repeated names get ``_2``, ``_3`` by their count."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def sanitize_all(names: Iterable[str]) -> list[str]:
    return unique(sanitize(name) for name in names)


def standardized(df: DataFrame) -> DataFrame:
    return df.toDF(*[standardize(name) for name in df.columns])


def sanitized(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_all(df.columns))


def table_file_name(name: str) -> str:
    return re.sub(r"[ :]", "_", re.sub(r"[/\\]", "__", name))


def table_file_name_col(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[/\\]", "__"), "[ :]", "_")


def table_stem_col(c: Column) -> Column:
    return sanitize_col(F.translate(c, "/\\", "__"))


def table_stems(names: Iterable[str]) -> dict[str, str]:
    """File stem per table name; a stem that another table holds gets a free suffix."""
    owner: dict[str, str] = {}
    for name in dict.fromkeys(names):
        stem = sanitize(re.sub(r"[/\\]", "_", name))
        tries = [stem] + [f"{stem}_{i}" for i in range(2, len(owner) + 3)]
        owner[next(t for t in tries if t not in owner)] = name
    return {name: stem for stem, name in owner.items()}


def suffix_repeats(names: Iterable[str]) -> list[str]:
    """Each repeat gets the first free number from 2 on, counting names already given out."""
    taken: set[str] = set()
    tried: dict[str, int] = {}
    out = []
    for name in names:
        given, number = name, tried.get(name, 1)
        while given in taken:
            number += 1
            given = f"{name}_{number}"
        tried[name] = number
        taken.add(given)
        out.append(given)
    return out
