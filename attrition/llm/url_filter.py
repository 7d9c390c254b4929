"""URL filter: a fixed rule list, and a path-template tree per host for what no rule names.

Urls that a rule decides are the labels. Paths are generalised into templates
from the host down, every node of the tree counts the labels below it, similar
sibling branches are pooled, and a template is rejected by the share of blocked
urls of its branches, each smoothed towards the one above it. Only DataFrame
functions are used; pages are reduced to template counts before anything is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import ascii_lower, store

# (host, path, verdict), as the contract states them.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# Segments that name one page: numbers, long hexadecimal names, dates, each with an optional extension.
VARIABLE = r"^([0-9]+|[0-9a-f]{8,}|[0-9]+[-_][0-9_-]*)(\.[a-z0-9]+)?$"
# A chi-square of one degree of freedom, 5 %: branches within it of their siblings are pooled.
SIMILAR = 3.84


def host_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.char_length(url))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host and path) that fits, as text; block before allow at equal length."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r))
    fits = [
        F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.lit(h + p)) for h, p, _ in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("string")) if fits else F.lit(None).cast("string")


def template(path: Column, max_depth: int) -> Column:
    """Segments of a path, variable ones as ``*``; what lies deeper than ``max_depth`` is one ``**``."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    short = F.slice(parts, 1, max_depth)
    general = F.transform(short, lambda s: F.when(s.rlike(VARIABLE), F.regexp_replace(s, r"^[^.]*", "*")).otherwise(s))
    return F.when(F.size(parts) > max_depth, F.concat(general, F.array(F.lit("**")))).otherwise(general)


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | None = None,
    max_children: int = 64,
    max_depth: int = 16,
    weight: float = 4.0,
    prior: float = 0.2,
    reject_at: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every row of ``pages(page_id, url)``.

    A null url, or one without ``://``, has empty host and path, fits no rule and is
    judged as the template of the empty path. Rows that repeat a page stay as they are.
    ``purity`` is the blocked share of the template's branch, smoothed by ``weight`` rows
    of the smoothed share of the rest of the branch above, and so on up to the host, which is
    smoothed towards ``prior``; each label counts at one level. A branch without labels has
    the share of the one above it, and a host without labels the prior: the share of all
    labels says which urls the rules are about, not how other hosts are. Segments below ``max_depth`` are one
    ``**``, so the rounds over the levels are bounded. An empty table gives no rows.
    """
    rules = RULES if rules is None else rules
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    blocked = [h + p for h, p, v in rules if v == "block"]
    by_rule = F.when(F.col("rule").isNotNull(), F.when(F.col("rule").isin(blocked), "block").otherwise("allow"))
    judged = judged.withColumn("by_rule", by_rule).withColumn("shape", template(F.col("path"), max_depth))

    counts = judged.groupBy("host", "shape").agg(
        F.count("rule").alias("labelled"), F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked")
    )
    leaves = generalise(store(counts, "url-shapes"), max_children)
    tree = leaves.join(purity(leaves, weight, prior), ["host", "node"]).select(
        "host", "shape", F.substring("node", F.lit(2), F.char_length("node")).alias("template"), "purity"
    )
    return judged.join(tree, ["host", "shape"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("purity") >= reject_at, "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )


def generalise(counts: DataFrame, max_children: int) -> DataFrame:
    """``counts`` with ``node``, the shape's template after a slash for each segment.

    Level by level, names below a prefix that has more than ``max_children`` of them become
    wildcards, and the next level is counted below the prefixes that result. So a node has
    ``max_children`` children at most.
    """
    depth = counts.agg(F.max(F.size("shape"))).first()[0] or 0
    tree = counts.withColumn("node", F.lit(""))
    for at in range(depth):
        name = F.get("shape", F.lit(at))
        named = tree.where(name.isNotNull()).select("host", "node", name.alias("name")).distinct()
        wide = named.groupBy("host", "node").agg(F.count("*").alias("names")).where(F.col("names") > max_children)
        wide = store(wide, "url-wide")
        if wide.isEmpty():
            kept = name
        else:
            tree, kept = tree.join(wide, ["host", "node"], "left"), F.when(F.col("names").isNotNull(), "*").otherwise(name)
        tree = tree.withColumn("node", F.when(name.isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), kept))).drop("names")
    return store(tree, "url-tree")


def purity(leaves: DataFrame, weight: float, prior: float) -> DataFrame:
    """``host, node, purity`` of every template: its branches' pooled counts, folded from the host down."""
    whole = leaves.groupBy("host", "node").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    names = F.split(F.col("node"), "/", -1)  # begins with an empty name, the host
    chain = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, F.lit(1), i), "/"))
    steps = whole.select("host", F.col("node").alias("template"), "n", "b", F.posexplode(chain).alias("depth", "node"))

    nodes = steps.groupBy("host", "depth", "node").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    above = F.when(F.col("depth") > 0, F.regexp_replace("node", "/[^/]*$", "")).otherwise("")
    siblings = Window.partitionBy("host", "depth", "above")
    nodes = nodes.withColumn("above", above).withColumns({"n_all": F.sum("n").over(siblings), "b_all": F.sum("b").over(siblings)})
    share = F.col("b_all") / F.nullif("n_all", F.lit(0))
    off = F.col("b") - F.col("n") * share
    same = (F.col("n") > 0) & (off * off <= SIMILAR * F.col("n") * share * (1 - share))
    nodes = nodes.withColumn("same", F.coalesce(same, F.lit(False)))
    pooled = {c: F.when(F.col("same"), F.sum(F.when(F.col("same"), F.col(c))).over(siblings)).otherwise(F.col(c)) for c in ("n", "b")}
    branches = nodes.select("host", "depth", "node", pooled["n"].alias("n"), pooled["b"].alias("b"))

    met = steps.select("host", "depth", "node", "template").join(branches, ["host", "depth", "node"])
    lines = met.groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("depth", "n", "b"))).alias("line"))
    # From the host down to the template, each label counts once: at the last branch of the line that holds it.

    def own(level: Column, at: Column) -> Column:
        below = F.get("line", at + 1)
        return F.struct(*[(level[c] - F.coalesce(below[c], F.lit(0))).alias(c) for c in ("n", "b")])

    smooth = F.aggregate(F.transform("line", own), F.lit(float(prior)), lambda p, x: (x["b"] + F.lit(weight) * p) / (x["n"] + F.lit(weight)))
    return lines.select("host", F.col("template").alias("node"), smooth.alias("purity"))
