"""Registry of named queries (Spark callables) and their DuckDB oracles.

``register(name, oracle_sql)`` adds a ``(spark, sf_dir) -> DataFrame``
callable. The star schema is built once per session and input folder and
reused by every query that reads it, as queries on a published warehouse do.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_CACHE: dict[tuple, object] = {}
_LOCK = threading.RLock()


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def memo(kind: str, spark: SparkSession, sf_dir: str, build: Callable[[], object], *extra):
    """Build an artefact (a written table, rendered files, the star schema) once
    per session, input folder and kind. Callers on several threads wait for one
    build instead of repeating it."""
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"), *extra)
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = build()
        return _CACHE[key]


def readings_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of ``sf_dir``, written once a session: several passes read them."""
    from cellstar.operators.keys import stage
    from cellstar.sources import fixtures as fx
    return memo("readings", spark, sf_dir, lambda: stage(fx.readings(spark, sf_dir), "bronze_readings"))


def star_for(spark: SparkSession, sf_dir: str, metadata_lookup: str = "full"):
    """The star schema built from the readings of ``sf_dir`` (once per session)."""
    from cellstar.plans.star import build_star
    from cellstar.sources import fixtures as fx

    def build():
        rd = readings_for(spark, sf_dir)
        return build_star(fx.sheet_rows(rd), fx.dat_rows(rd), fx.metadata_rows(rd),
                          metadata_lookup=metadata_lookup)

    return memo("star", spark, sf_dir, build, metadata_lookup)


def clear_cache() -> None:
    with _LOCK:
        _CACHE.clear()


def load_all() -> None:
    """Import the modules that register queries."""
    from cellstar.plans import registry  # noqa: F401  (first: later modules reuse its oracles)
    from cellstar.plans import registry_ingest, registry_ops, registry_scalar  # noqa: F401
