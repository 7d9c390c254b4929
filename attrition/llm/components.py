"""Connected components of a link table, by alternating large-star and small-star steps.

Each step hangs a node's neighbours on the smallest of them; every link stays
inside its component, and after a few rounds each component is a star around
its smallest node. Steps are joins on written tables, which adaptive execution
can split when one node has a large part of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.scratch import store


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Loops, repeats and either direction are allowed; links with a null end are none.
    Without links there are no rows.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = store(links.where("a <> b").select(high, low).distinct(), "links")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select("b", "a"))
        least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = store(large.distinct(), "links")
        least = store(current.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = current.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = store(small.union(least).distinct(), "links")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Number of links and a sum over them that changes when any link does."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
