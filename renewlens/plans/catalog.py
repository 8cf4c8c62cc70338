"""Query catalogue: name -> Spark callable (spark, sf_dir) -> DataFrame, and
name -> DuckDB oracle SQL over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from renewlens.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """One ``Tables`` (and its lazily built adapters) per folder, kept on the session: it goes with it."""
    kept = vars(spark).setdefault("_renewlens_tables", {})
    key = sf_dir.rstrip("/")
    if key not in kept:
        kept[key] = Tables(spark, sf_dir)
    return kept[key]


def register(name: str, sql: str | None = None):
    """Register a query taking ``Tables`` (adapters on ``t.adapters``)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables_for(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    from renewlens.plans import (  # noqa: F401
        q_calendar, q_declared, q_geo, q_history, q_io, q_models, q_periods, q_profile,
    )
