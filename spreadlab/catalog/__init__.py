"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab.fixtures import Tables, sql

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def rounded(c: Column | str) -> Column:
    """Six digits, for comparing floating results of two engines.

    Means of prices are often exact halves in the seventh digit, where the last
    bit decides; the tiny shift, also in the SQL, moves the border away from
    them.
    """
    return F.round((F.col(f"`{c}`") if isinstance(c, str) else c) + 1.37e-9, 6)


def query(name: str, views: str = "", check: str | None = None):
    """Register a query; ``check`` is SQL over the named adapter views."""
    def register(build):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = build
        if check:
            _SQL[name] = sql(views, check)
        return build
    return register


def _load():
    from spreadlab.catalog import (  # noqa: F401  (registration by import)
        aggregates, filters, identifiers, jobs, joins, ordering, projections, quality, sinks,
        sources, streams, views)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(build):
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: bind(build) for name, build in _QUERIES.items()}


def all_checks() -> dict[str, str]:
    _load()
    return dict(_SQL)
