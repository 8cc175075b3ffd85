"""Registry of named query plans over the driver tables.

Each plan is ``fn(spark, sf_dir) -> DataFrame``; where the result is
expressible in ANSI SQL, an equivalent DuckDB query is registered beside it
(tables are views named after the parquet files).  Column names are aliased
identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PlanFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, PlanFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[PlanFn], PlanFn]:
    def deco(fn: PlanFn) -> PlanFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate plan {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, PlanFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # importing the modules registers their plans
    from event_ml.plans import (  # noqa: F401
        explore_plans,
        feature_plans,
        metric_plans,
        model_plans,
        pipeline_plans,
        quality_plans,
        sink_plans,
        split_plans,
        threshold_plans,
    )
