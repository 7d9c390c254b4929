"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree (domain, language, source). At each node it is
shared by weight; a child that cannot use its share gives the rest to its
siblings first, and only what the whole branch cannot use goes to the siblings
of the branch. Each leaf then takes that many tokens from its epochs: whole
passes, and a prefix of one more in an order drawn from the seed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import store

# Documents of a leaf that are put in order together, on average.
BUCKET_DOCS = 1024
UNKNOWN = "unknown"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(levels: list[str], weights: dict[tuple[str, ...], int]) -> Column:
    """The weight of a node, given by the names on its path; 1 where none is given."""
    found = F.lit(1)
    for path, weight in weights.items():
        if len(path) == len(levels):
            same = F.lit(True)
            for level, name in zip(levels, path):
                same = same & (F.col(level) == name)
            found = F.when(same, weight).otherwise(found)
    return found.cast("long")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children(..., weight, capacity, budget)`` with ``granted``: the parent's budget by weight, no child over its capacity.

    Children that reach their capacity are a prefix in the order of capacity per weight, so
    two running sums settle them all. Grants are rounded down.
    """
    siblings = Window.partitionBy(*parent)
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    settled = children.withColumns({"left": left, "open": F.sum("weight").over(after)})
    settled = settled.withColumn("full", F.col("capacity") * F.col("open") <= F.col("left") * F.col("weight"))
    settled = settled.withColumns(
        {
            "taken": F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(siblings), F.lit(0)),
            "open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings), F.lit(0)),
        }
    )
    part = F.expr("(budget - taken) * weight div nullif(open, 0)")
    return settled.withColumn("granted", F.when(F.col("full"), F.col("capacity")).otherwise(part)).drop("left", "open", "taken", "full")


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int], budget: Column, epochs: int) -> DataFrame:
    """``leaves(*levels, tokens)`` with ``granted`` tokens, from the root down.

    The tree has a row for each leaf, not for each document; children of one node meet in one window.
    """
    whole = leaves.agg(F.least(F.sum("tokens") * epochs, budget).alias("budget"))
    live = leaves
    for depth in range(len(levels)):  # a leaf below a weight of 0 gets nothing, so it is no capacity of its ancestors
        live = live.where(weight_of(levels[: depth + 1], weights) > 0)
    down = None
    for depth, name in enumerate(levels):
        path = levels[: depth + 1]
        nodes = live.groupBy(*path).agg((F.sum("tokens") * epochs).alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(path, weights))
        nodes = nodes.withColumn("budget", whole.scalar()) if down is None else nodes.join(down, path[:-1])
        down = share_out(nodes, path[:-1], name).select(*path, F.col("granted").alias("budget"))
    return leaves.join(down.withColumnRenamed("budget", "granted"), levels, "left").withColumn(        "granted", F.coalesce("granted", F.lit(0)).cast("long")
    )


def draw(seed: int, epoch: Column, doc_id: Column, keys: Sequence[str] = ()) -> Column:
    """A document's place in an epoch: 60 bits of a hash of its id or, without one, of its ``keys``."""
    name = F.coalesce(doc_id.cast("string"), F.concat_ws(":", *keys) if keys else F.lit(""))
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    weights: dict[tuple[str, ...], int],
    domain: Column,
    share: float = 1.0,
    epochs: int = 2,
    seed: int = 42,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, copies, prefix_tokens`` and ``keys`` of every row of ``docs(doc_id, text, lang, source)``.

    The budget is ``share`` of all tokens (white-space words), and a leaf can be passed
    ``epochs`` times at most. ``copies`` are a document's whole passes, ``prefix_tokens`` how
    many of its first tokens the last, partial pass takes. Null domains, languages and sources
    are the branch ``unknown``; nodes of weight 0 get nothing; texts without words
    count no tokens. Rows with one id follow each other, shorter ones first, then by ``keys``
    (long columns); rows without an id are drawn by these. An empty table gives no rows.
    """
    levels = ["domain", "lang", "source"]
    named = docs.withColumn("domain", domain)
    tokens = store(
        named.select("doc_id", *keys, *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in levels], word_count(F.col("text")).alias("tokens")), "mix-tokens"
    )
    leaves = tokens.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    asked = F.floor(F.sum("tokens") * F.lit(share))
    granted = budgets(leaves, levels, weights, asked, epochs)
    plan = store(
        granted.select(
            *levels,
            F.expr("CASE WHEN tokens > 0 THEN granted div tokens ELSE 0 END").alias("copies"),
            F.expr("CASE WHEN tokens > 0 THEN granted % tokens ELSE 0 END").alias("rest"),
            F.ceil(F.col("docs") / BUCKET_DOCS).alias("buckets"),
        ),
        "mix-plan",
    )
    # The order of a leaf is cut into buckets by hash, so that no task has to order a whole leaf.
    drawn = tokens.join(plan, levels).withColumn("draw", draw(seed, F.col("copies"), F.col("doc_id"), keys))
    drawn = store(drawn.withColumn("bucket", F.expr("shiftright(shiftright(draw, 30) * buckets, 30)")), "mix-drawn")
    sums = drawn.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("in_bucket"))
    up_to = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*levels, "bucket", F.coalesce(F.sum("in_bucket").over(up_to), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*levels, "bucket").orderBy("draw", "doc_id", "tokens", *keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    placed = drawn.join(starts, [*levels, "bucket"]).withColumn("before", before)
    prefix = F.greatest(F.lit(0), F.least("tokens", F.col("rest") - F.col("before")))
    return placed.select("doc_id", *keys, *levels, "tokens", F.col("copies").cast("long"), prefix.cast("long").alias("prefix_tokens"))
