"""Registry of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veldcube.plans.cube import Cube, report
from veldcube.plans.oracle import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_SPECS: dict[str, tuple] = {}


def query(name: str, select: str | None = None, doubles: str = "", **local: str):
    """Register a builder Cube -> DataFrame under `name`; `select` is its SQL (CTE name or SELECT)."""

    def register(build: Callable[[Cube], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: report(build(Cube(spark, sf_dir)))
        _SPECS[name] = (build, select, doubles, local)
        if select is not None:
            SQL[name] = sql(select, doubles, **local)
        return build

    return register


def over(name: str, base: str, cube: type[Cube], **tables: str) -> None:
    """Register the builder of `base` under `name` over another cube; `tables` replaces CTEs of its SQL."""
    build, select, doubles, local = _SPECS[base]
    QUERIES[name] = lambda spark, sf_dir: report(build(cube(spark, sf_dir)))
    SQL[name] = sql(select, doubles, **{**local, **tables})
