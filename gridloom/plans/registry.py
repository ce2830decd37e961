"""All registered queries of the map engine: name -> callable and name -> SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from gridloom.sources.derived import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Registers a query under its function's name; sql reads the tables and the named views of sources.derived."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = with_views(views.split(), sql) if views else sql.strip()
        return f

    return add


for _module in ("surface_queries", "join_queries", "merge_queries", "journal_queries", "focal_queries", "scalar_queries", "graph_queries", "rule_queries", "stream_queries", "coverage_queries", "block_queries", "polygon_queries", "ground_queries", "roof_queries", "street_queries", "atlas_queries"):
    import_module(f"gridloom.plans.{_module}")
