"""Registered queries with their SQL, by area."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A query over the given tables and, where SQL can say it, the same in SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under a name."""

    def register(run):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(run, sql)
        return run

    return register


def load_catalog() -> dict[str, Query]:
    from . import auditing, cleaning, exports, grids, shaping, visiting, workbooks  # noqa: F401

    return CATALOG
