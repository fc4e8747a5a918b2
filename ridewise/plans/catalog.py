"""Registry of named queries.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame. ``sql`` is
the DuckDB twin over the same parquet tables (``None`` for model outputs and
iterative operators, which get a rows-only check plus invariant tests).
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ridewise.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class QuerySpec:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...] = field(default_factory=tuple)
    heavy: bool = False      # model fitting / iterative: excluded from the quick bench


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None, ops: tuple[str, ...] = (), heavy: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)      # Python workers must import ridewise
            return fn(spark, sf_dir)

        REGISTRY[name] = QuerySpec(name, run, sql, tuple(ops), heavy)
        return fn
    return deco


def load_all() -> dict[str, QuerySpec]:
    """Import every query module (registration happens at import)."""
    from ridewise.plans import (q_kpi, q_rules, q_geo, q_ml_eval, q_matching,  # noqa: F401
                                q_models, q_stream, q_io)
    return REGISTRY
