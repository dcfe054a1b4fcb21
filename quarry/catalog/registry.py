"""Registry of catalog queries: each runs library operators over the test tables and may carry
an equivalent SQL text that an independent engine (DuckDB) runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def tag(sf_dir: str) -> str:
    """A stable short name for a data directory (stage folders of catalog queries)."""
    import hashlib
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:12]


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def load_all() -> None:
    """Import every catalog module so its queries register."""
    import importlib
    import pkgutil

    import quarry.catalog as pkg
    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            importlib.import_module(f"quarry.catalog.{m.name}")
