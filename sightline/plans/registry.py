"""Name -> job and name -> oracle SQL registries behind ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a job ``(spark, sf_dir) -> DataFrame`` and, when the result is
    expressible in SQL, its independent DuckDB text."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate job name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def once_per_session(job):
    """A composed job writes several tables and each has a query of its own:
    within one Spark application the job runs once per input."""
    done: dict[tuple, object] = {}

    def run(spark, sf):
        key = (spark.sparkContext.applicationId, sf)
        if key not in done:
            done[key] = job(spark, sf)
        return done[key]
    return run


def load_all() -> None:
    from . import catalog, catalog_maintenance, catalog_streaming  # noqa: F401
