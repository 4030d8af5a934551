"""Queries by name and, beside each, the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.adapters import duckdb_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    """Register a query under its function's name; the oracle goes on from the shared views unless views is off."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = f"{duckdb_views()}{' ' if oracle.lstrip().startswith('select') else ', '}{oracle}" if views else oracle
        return f

    return add
