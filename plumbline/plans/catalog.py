"""Registered queries: Spark plan + DuckDB oracle SQL per operator group.

Each entry maps a name to ``(spark_fn(spark, sf_dir) -> DataFrame, sql)``.
``sql`` is None where no exact SQL twin exists (the test suite then checks
the operator against a brute-force computation on a small fixture).
Modules under ``plumbline.plans`` register their queries here on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # import for side effect: each module registers its queries
    from plumbline.plans import (  # noqa: F401
        q_clean,
        q_entity,
        q_files,
        q_grid,
        q_eval,
        q_knn,
        q_model,
        q_profile,
        q_text,
    )
    return REGISTRY
