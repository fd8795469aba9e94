"""Inheritance of settings: a child document laid over its parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlay(parent: DataFrame, child: DataFrame, keys: tuple[str, ...] = ("template_id",)) -> DataFrame:
    """Deep merge of two path/value tables (dotted paths, one row per leaf).

    The child's leaf wins.  Where the child replaces a branch by a leaf the parent's
    leaves below it go; where it replaces a leaf by a branch the parent's leaf goes.
    Branches of the parent are made distinct in each task before they meet the child's
    paths, so the root of a template with very many leaves is no hot key; what the leaves
    are joined with then are only the branches that the child does replace.
    """
    def prefixes(path, last):
        parts = F.split(path, r"\.")
        return F.transform(
            F.sequence(F.lit(1), last(parts)), lambda n: F.array_join(F.slice(parts, 1, n), ".")
        )

    on = list(keys)
    deep = parent.select(*on, "path").where(F.col("path").contains("."))
    above = deep.select(*on, "path", F.explode(prefixes(F.col("path"), lambda p: F.size(p) - 1)).alias("prefix"))
    replaced = above.select(*on, "prefix").distinct().join(child.select(*on, F.col("path").alias("prefix")).distinct(), [*on, "prefix"], "left_semi")
    hidden_below = above.join(replaced, [*on, "prefix"], "left_semi").select(*on, "path")
    child_prefixes = child.select(*on, F.explode(prefixes(F.col("path"), F.size)).alias("path")).distinct()
    hidden_leaf = parent.select(*on, "path").join(child_prefixes, [*on, "path"], "left_semi")
    hidden = hidden_below.unionByName(hidden_leaf).distinct()
    kept = parent.join(hidden, [*on, "path"], "left_anti")
    return kept.unionByName(child.select(*kept.columns))


def setting(df: DataFrame, path: str) -> DataFrame:
    """Value (or all values of the branch) at a dotted path."""
    return df.where((F.col("path") == path) | F.col("path").startswith(path + "."))
