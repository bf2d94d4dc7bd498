"""Named queries with the plain SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function; ``sql`` is left out where SQL cannot say the same."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is defined twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return register


def load_all() -> None:
    from larkspur.queries import (  # noqa: F401
        basics,
        customer,
        encoding,
        evaluation,
        funnel,
        invariants,
        modelling,
        optimise,
        panel,
        profiling,
        tables,
    )
