"""Value normalization declared per field: map, regex, trim, case."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capitalize, strip, title_case

# Vendor spellings and the words of the plain boolean rule.
VENDOR_NAMES = {
    "siemens": "Siemens",
    "ge": "GE Healthcare",
    "general electric": "GE Healthcare",
    "philips": "Philips",
    "canon": "Canon",
    "toshiba": "Toshiba",
    "hitachi": "Hitachi",
}
TRUE_TEXTS = ("true", "1", "yes", "y", "oui", "vrai")
FALSE_TEXTS = ("false", "0", "no", "n", "non", "faux")


def _compiles(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def starts_with_pattern(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Regex test anchored at the start of the text."""
    return c.rlike(("(?i)" if ignore_case else "") + f"^(?:{pattern})")


def _java_replacement(replacement: str) -> str:
    """Back-references ``\\1`` and ``\\g<1>`` become ``$1``; a dollar sign is literal."""
    out = replacement.replace("$", "\\$")
    return re.sub(r"\\g<(\d+)>|\\(\d)", lambda m: "$" + (m.group(1) or m.group(2)), out)


def apply_map(c: Column, mapping: Mapping[str, str]) -> Column:
    """First matching entry wins; patterns are ``^...`` or hold ``.*``, others are
    compared without case.  No match: the ``default`` entry, else the input."""
    text = strip(c)
    chain = None
    for key, value in mapping.items():
        if key.startswith("^") or ".*" in key:
            if not _compiles(key):
                continue
            hit = starts_with_pattern(text, key, ignore_case=True)
        else:
            hit = F.lower(text) == key.lower()
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    rest = F.lit(mapping["default"]) if "default" in mapping else c
    return rest if chain is None else chain.otherwise(rest)


def apply_regex(c: Column, pattern: str | None, replacement: str = "") -> Column:
    """Where the pattern matches at the start, replace all its occurrences."""
    if not pattern or not replacement or not _compiles(pattern):
        return c
    return F.when(
        starts_with_pattern(c, pattern), F.regexp_replace(c, pattern, _java_replacement(replacement))
    ).otherwise(c)


def apply_case(c: Column, case: str) -> Column:
    forms = {"upper": F.upper, "lower": F.lower, "title": title_case, "capitalize": capitalize}
    return forms[case](c) if case in forms else c


def normalize(c: Column, rule: Mapping) -> Column:
    """The whole chain: null -> default; map, regex, trim, case in this order."""
    out = c
    if "map" in rule:
        out = apply_map(out, rule["map"])
    if "regex" in rule:
        out = apply_regex(out, rule["regex"].get("pattern"), rule["regex"].get("replacement", ""))
    if rule.get("trim"):
        out = strip(out)
    if "case" in rule:
        out = apply_case(out, rule["case"])
    return F.when(c.isNull(), F.lit(rule.get("default"))).otherwise(out)


def vendor_name(c: Column) -> Column:
    """Canonical vendor spelling; an unknown vendor stays as it is."""
    word = strip(F.lower(c))
    chain = None
    for key, value in VENDOR_NAMES.items():
        chain = F.when(word == key, value) if chain is None else chain.when(word == key, value)
    return chain.otherwise(c)


def boolean_text(c: Column) -> Column:
    """Text -> boolean; other non-empty text counts as true."""
    word = strip(F.lower(c))
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False).otherwise(c != "")


def boolean_number(c: Column) -> Column:
    return c != 0
