"""Query registry shared by ``__spark_entry__``, ``bench.py`` and the tests."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

PLAN_MODULES = (
    "kestrel.plans.mileage",
    "kestrel.plans.relational",
    "kestrel.plans.scalars",
    "kestrel.plans.scans",
    "kestrel.plans.documents",
    "kestrel.plans.streams",
    "kestrel.plans.recommend",
    "kestrel.plans.churn",
    "kestrel.plans.refresh",
    "kestrel.plans.state",
)


def query(name: str, oracle: str | None = None):
    """Register ``fn`` as query ``name``; ``oracle`` is its DuckDB SQL, if any.

    The registered callable pins the session time zone to UTC first: the
    driver tables hold zone-less timestamps and the oracle reads them as such.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)
