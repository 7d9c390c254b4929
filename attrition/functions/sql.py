"""Expressions as SQL text.

A whole expression reaches the JVM in one call as text; built from column objects
it takes one call per operator, which dominates the planning time of a wide query.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Iterable[str]) -> str:
    return ", ".join(quote(value) for value in values)


def ratio(part: str, whole: str) -> str:
    """One double division on exact sums, 0 for an empty group."""
    return f"coalesce(try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)), 0D)"


def percent(part: str, whole: str) -> str:
    return ratio(f"({part}) * 100", whole)


def count_if(test: str) -> str:
    return f"count_if({test})"


def named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS `{name}`") for name, text in expressions.items()]


def aggregate(rows: DataFrame, keys: dict[str, str] | list[str], **expressions: str) -> DataFrame:
    """Group by columns, or by named expressions, and aggregate."""
    grouping = named(keys) if isinstance(keys, dict) else list(keys)
    return rows.groupBy(*grouping).agg(*named(expressions))
