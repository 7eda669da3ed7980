"""Queries over the tables, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workloom.plans import data_quality, reference

_PARTS = (reference, data_quality)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
