"""Small fixed tables, and aggregates that list every domain value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.functions.sql import aggregate, listed, quote


def literal_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A constant relation the optimizer sees as local data."""

    def cell(value):
        return quote(value) if isinstance(value, str) else str(value)

    values = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def over_domain(rows: DataFrame, name: str, key: str, values: list[str], **expressions: str) -> DataFrame:
    """Aggregate by ``key`` and list each value of the domain in its order, 0 where it has no rows.

    Only domain values are grouped, so the right side has at most ``len(values)`` rows.
    """
    domain = literal_table(rows.sparkSession, ["_pos", name], list(enumerate(values)))
    found = aggregate(rows.filter(f"{key} IN ({listed(values)})"), {name: key}, **expressions)
    filled = [f"coalesce({alias}, 0) AS {alias}" for alias in expressions]
    return domain.join(F.broadcast(found), name, "left").orderBy("_pos").selectExpr(name, *filled)
