"""Dense surrogate keys without a global sort.

Rows are spread over hash buckets of their full content, numbered inside the
bucket, and shifted by the running total of the bucket sizes. The only
unpartitioned window sees one row per bucket, at most ``16 ** digits``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row that are numbered together; part of the rule that decides key values.
COPIES_PER_ROW = 10_000


def content_key(columns: list[str]) -> str:
    """SQL text of a key that differs whenever any column differs; NULL is told from text by
    its lack of a length."""
    texts = [f"CAST(`{name}` AS STRING)" for name in columns]
    return "concat(" + ", ".join(f"coalesce(concat(length({t}), ':', {t}), '-')" for t in texts) + ")"


def with_key(
    df: DataFrame,
    name: str,
    columns: list[str] | None = None,
    *,
    distinct: bool = False,
    once: bool = False,
    digits: int = 4,
    after: int | Column = 0,
    key_type: str = "bigint",
) -> DataFrame:
    """Add ``name`` = ``after`` + 1..N.

    Unless the rows are known to be distinct, exact copies are first collapsed to
    a count (map-side), cut into runs of ``COPIES_PER_ROW`` that hash to buckets of
    their own, and only expanded once their key range is known, so a row that
    repeats many times never lands in one task.

    With ``once`` copies of a row count as one. They meet in their bucket, so the rows are
    shuffled a single time, and dealt, collapsed and numbered from there.
    """
    columns = columns or df.columns
    kept = [f"`{c}`" for c in df.columns]
    # The content text decides the bucket and is dropped: only the columns themselves are shuffled and sorted.
    key = content_key(columns)
    first = f"substring(md5({key}), 1, {digits})"
    if once:
        rows = df.selectExpr(*kept, f"{first} AS _bucket").repartition("_bucket").distinct().selectExpr("*", "1L AS _n", "0L AS _run")
        distinct = True
    elif distinct:
        rows = df.selectExpr(*kept, "0L AS _run", "1L AS _n", f"{first} AS _bucket")
    else:
        # A row's own bucket is worked out before its copies are collapsed, so that neither the sizes
        # nor the numbering hash the content again; only further runs do.
        rows = (
            df.selectExpr(*kept, f"{first} AS _first")
            .groupBy(*kept, "_first")
            .agg(F.expr("count(1) AS _copies"))
            # Runs are listed in two steps, so that no array grows with the copies of a row.
            .selectExpr("*", f"(_copies - 1) div {COPIES_PER_ROW} AS _runs")
            .selectExpr("*", f"explode(sequence(0L, _runs div {COPIES_PER_ROW})) AS _lot")
            .selectExpr(
                "*", f"explode(sequence(_lot * {COPIES_PER_ROW}, least((_lot + 1) * {COPIES_PER_ROW} - 1, _runs))) AS _run"
            )
            .selectExpr(
                *kept,
                "_run",
                f"least({COPIES_PER_ROW}L, _copies - _run * {COPIES_PER_ROW}) AS _n",
                f"CASE WHEN _run = 0 THEN _first ELSE substring(md5(concat({key}, '#', _run)), 1, {digits}) END AS _bucket",
            )
        )
    sizes = rows.groupBy("_bucket").agg(F.expr("sum(_n) AS _size"))
    offsets = sizes.selectExpr(
        "_bucket",
        """coalesce(sum(_size) OVER (ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS _offset""",
    )
    order = ", ".join(f"`{c}`" for c in columns)
    inside = f"(PARTITION BY _bucket ORDER BY {order}, _run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    numbered = rows.selectExpr("*", f"{'count(1)' if distinct else 'sum(_n)'} OVER {inside} AS _last")
    # One row per bucket: the broadcast side is bounded by 16 ** digits.
    placed = numbered.join(F.broadcast(offsets), "_bucket")
    if isinstance(after, int):
        after = F.lit(after)
    placed = placed.withColumn("_last", after + F.expr("_offset + _last"))
    if distinct:
        value = f"CAST(_last AS {key_type})"
    else:
        value = f"explode(sequence(CAST(_last - _n + 1 AS {key_type}), CAST(_last AS {key_type})))"
    return placed.selectExpr(f"{value} AS `{name}`", *kept)
