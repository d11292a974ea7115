"""Registry of named queries: one Spark plan per operator of the survey,
each paired (where SQL can express it) with an equivalent DuckDB query.

Every query reads the whole test tables of ``sf_dir`` (or tables Spark
derives from them).  Computed doubles are rounded to 6 places on both
sides so the value hashes compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from marquee.plans import queries_batch  # noqa: F401
    from marquee.plans import queries_load  # noqa: F401
    from marquee.plans import queries_model  # noqa: F401
    from marquee.plans import queries_search  # noqa: F401
    from marquee.plans import queries_stream  # noqa: F401
