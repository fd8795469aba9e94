"""Connected components of an edge list, by joins that halve distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``id``, ``comp``: the smallest id reachable, for every id in ``edges`` (``a``, ``b``).

    Each round every node is tied to the smallest node among its neighbours and itself
    (first for larger neighbours, then for smaller ones), until nothing changes: the rest
    are stars around the smallest ids.  Only aggregates and joins on keys: a node with
    very many edges is never gathered in one place.  Loops and repeated edges do no harm.
    """
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while True:
        # Larger neighbours of a node go to the smallest of its neighbourhood.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), label)
        # Smaller neighbours of a node and itself go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = materialize(small.where("a <> b").distinct(), label)
        moved = small.join(links, ["a", "b"], "left_anti").limit(1).count() or links.join(small, ["a", "b"], "left_anti").limit(1).count()
        links = small
        if not moved:
            break
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("comp"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(roots).distinct()
