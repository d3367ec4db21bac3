"""All queries of the core, by name, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terraloom.plans import polygons, quality, reference, storage

MODULES = (quality, reference, polygons, storage)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _m in MODULES:
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
FLAGSHIP = "dissolve_l2"
