"""All queries by name, and the SQL of each that has any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.strip()
        return f

    return add


from . import q_assoc, q_dp, q_drift, q_privacy, q_profile, q_report, q_rules, q_synth, q_tstr  # noqa: E402, F401
