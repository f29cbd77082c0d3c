"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver tables of ``sf_dir`` (through the fixture views)
and runs one operator of the inventory over all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import FIXTURES, fixture, register_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (None: rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixture(spark, sf_dir, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_sql(fixtures: tuple[str, ...], steps: list[tuple[str, str]], final: str) -> str:
    """Oracle text: fixture CTEs (dependency order), extra steps, final select."""
    ordered: list[str] = []

    def add(n):
        for d in FIXTURES[n][2]:
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in fixtures:
        add(n)
    ctes = [f"{n} AS ({FIXTURES[n][1]})" for n in ordered] + [f"{n} AS ({s})" for n, s in steps]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + final


def load_all() -> None:
    """Import every query module so they register."""
    from . import q_files, q_scores, q_usage, q_reports, q_rubric, q_enrich, q_sinks, q_solutions, q_requests  # noqa: F401


__all__ = ["QUERIES", "ORACLES", "query", "fx", "table", "with_sql", "load_all", "register_tables"]
