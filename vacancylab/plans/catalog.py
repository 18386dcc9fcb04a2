"""Registry of the public queries: name -> (Spark builder, DuckDB twin or None).

Every builder takes ``(spark, sf_dir)``, derives the stored test database
from the generated tables of ``sf_dir`` with the library's operators, runs
one operator over the whole tables and returns the lazy DataFrame.  The twin
is the same question asked in SQL over the same raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (q_companies, q_dedup, q_evaluation, q_ingest, q_keywords, q_setops,  # noqa: F401
                   q_regions, q_reports, q_sampling, q_shares)
