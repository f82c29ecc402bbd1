"""Registry of the queries run against the driver tables: each is a function
``(spark, sf_dir) -> DataFrame`` plus, where SQL can express it, the DuckDB
oracle text producing the same columns."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from . import q_reshape, q_profile, q_clean, q_rank, q_stats, q_models, q_sources, q_compose, q_more  # noqa: F401
