"""The registered queries: each operator on the test tables, twinned with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conforming, ingesting, judging, mapping, reconciling, scoring, vintages

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (conforming, judging, reconciling, scoring, vintages, mapping, ingesting)


def queries() -> dict[str, Query]:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
