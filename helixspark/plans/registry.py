"""Registry of named queries: a Spark plan and, where SQL can say it, the oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. Every query reads the driver tables
(through the fixture views of ``plans.fixtures``), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    oracle: str | None


_QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = Query(name, fn, oracle)
        return fn

    return deco


MODULES = (
    "q_variants", "q_runs", "q_validation", "q_expression", "q_taxonomy",
    "q_msa", "q_structure", "q_alignments", "q_catalog", "q_sources", "q_stats", "q_streaming",
)


def _load_all() -> None:
    # Importing the modules fills the registry.
    import importlib

    for m in MODULES:
        importlib.import_module(f"helixspark.plans.{m}")


def all_queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)
