"""Named queries: each is (build(spark, sf_dir) -> DataFrame, oracle SQL or
None).  Queries read the whole shared tables through the adapter views;
oracle SQL is an independent DuckDB formulation over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills REGISTRY
    from . import q_reviews, q_keywords, q_paid, q_projections, q_visibility, q_links, q_traffic  # noqa: F401
    from . import q_cards, q_typing, q_dashboard, q_io  # noqa: F401
    return REGISTRY
