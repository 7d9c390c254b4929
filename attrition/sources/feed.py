"""The dashboard feed: short column names, 0/1 flags, one-line text, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions.cleansing import bit, one_line


def build_feed(silver: DataFrame, *keep: str) -> DataFrame:
    """The feed's columns, behind those of ``keep``."""
    columns = [*keep]
    for alias, source in schemas.FEED_COLUMNS.items():
        value = source
        if source in schemas.FLAG_COLUMNS:
            value = bit(source)
        elif source in schemas.TEXT_WIDTHS and alias != "id":
            value = one_line(source)
        columns.append(f"{value} AS {alias}")
    return silver.selectExpr(*columns)


def write_feed(feed: DataFrame, path: str) -> int:
    """One JSON record per line, NULLs spelled out; returns the row count seen by the writer."""
    seen = Observation()
    watched = feed.observe(seen, F.count(F.lit(1)).alias("rows"))
    watched.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]
