"""Additive cells behind the dashboard pages, kept up to date batch by batch.

A cell is a combination of the six filter fields and the churn reason, or a place; its
sums are all that the page KPIs and the facet counts are made of. A batch writes only the cells
its customers were or are in, as differences: what was stored of them is taken off, what they are now is added. Cells are
the sums of all differences, so reading merges a few small files, however many customers there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions.sql import aggregate, quote
from attrition.operators.filters import DOMAINS, FIELD_VALUES, facets_from
from attrition.plans import kpis
from attrition.plans.kpis import ADDON_TOTAL, CHURNED, SERVICE_COUNTS, STREAMS, known

# The score from which an active customer counts as a high risk; cells are kept for this one.
THRESHOLD = 70
CELL = FIELD_VALUES | {"reason": f"CASE WHEN {CHURNED} THEN {known('reason', 'Unknown')} END"}
PLACE = {name: name for name in ("state", "city", "zip")}
# Sums of a cell: the value a feed row adds, and the type of the sum.
FLAGS = {
    "n": "true",
    "gone": CHURNED,
    "risky": f"NOT {CHURNED} AND score >= {THRESHOLD}",
    "stream": STREAMS,
    "suite": f"{ADDON_TOTAL} > 0",
} | {name: text.removeprefix("count_if(").removesuffix(")") for name, text in SERVICE_COUNTS.items()}
AMOUNTS = {"score": "score", "cltv": "cltv", "addons": ADDON_TOTAL, "monthly": "monthly", "total": "total"}
TYPES = {name: "decimal(38,2)" if name in ("monthly", "total") else "bigint" for name in [*FLAGS, *AMOUNTS]}
KEYS = ["kind", *CELL, *PLACE]


def differences(feed: DataFrame) -> DataFrame:
    """What feed rows that come (``sign`` 1) and go (-1) add to cells and places, from one pass over them."""
    values = {name: f"CAST(coalesce({text}, false) AS INT)" for name, text in FLAGS.items()}
    values |= {name: f"coalesce({text}, 0)" for name, text in AMOUNTS.items()}
    keys = [f"{text} AS {name}" for name, text in (CELL | PLACE).items()]
    rows = feed.selectExpr(*keys, *[f"sign * {text} AS _{name}" for name, text in values.items()])
    sums = [F.expr(f"CAST(sum(_{name}) AS {kind})").alias(name) for name, kind in TYPES.items()]
    grouped = rows.groupingSets([[F.col(c) for c in CELL], [F.col(c) for c in PLACE]], *CELL, *PLACE)
    counted = grouped.agg(F.when(F.grouping("state") == 1, "cell").otherwise("place").alias("kind"), *sums)
    return counted.select(*KEYS, *TYPES)


def merged(parts: DataFrame) -> DataFrame:
    """Cells from differences; those without a customer are none."""
    sums = {name: f"CAST(sum({name}) AS {kind})" for name, kind in TYPES.items()}
    return aggregate(parts, KEYS, **sums).filter("n <> 0")


def _chosen(cells: DataFrame, spec: dict[str, str] | None) -> DataFrame:
    """Cells that pass a filter set of the dashboard."""
    rows = cells.filter("kind = 'cell'")
    for name, value in (spec or {}).items():
        if name not in DOMAINS:
            raise ValueError(f"unknown filter field {name!r}")
        if value != "All":
            rows = rows.filter(f"{name} = {quote(value)}")
    return rows


def _total(name: str) -> str:
    return f"coalesce(sum({name}), 0)"


def overview_sums(cells: DataFrame, spec: dict[str, str] | None = None) -> DataFrame:
    names = {"total": "n", "churners": "gone", "monthly_revenue": "monthly", "_cltv": "cltv", "lifetime_revenue": "total"}
    return aggregate(_chosen(cells, spec), [], **{name: _total(of) for name, of in names.items()})


def kpi_overview(cells: DataFrame, spec: dict[str, str] | None = None) -> DataFrame:
    return kpis.overview_from(overview_sums(cells, spec))


def kpi_churn(cells: DataFrame, spec: dict[str, str] | None = None) -> DataFrame:
    sums = {name: f"sum({name})" for name in ("n", "gone", "score", "risky")}
    by_reason = aggregate(_chosen(cells, spec), ["reason"], **sums, at_risk="sum(CASE WHEN churn = 'Churned' THEN monthly END)")
    return kpis.churn_from(by_reason)


def kpi_services(cells: DataFrame, spec: dict[str, str] | None = None) -> DataFrame:
    names = ["n", "addons", "stream", "suite", *SERVICE_COUNTS]
    return kpis.services_from(aggregate(_chosen(cells, spec), [], **{name: _total(name) for name in names}))


def kpi_revenue(cells: DataFrame, spec: dict[str, str] | None = None) -> DataFrame:
    sums = {"n": _total("n"), "monthly_revenue": _total("monthly"), "lifetime_revenue": _total("total"), "cltv": _total("cltv")}
    for position, name in enumerate(schemas.CONTRACTS):
        sums[f"rev{position}"] = f"coalesce(sum(CASE WHEN contract = {quote(name)} THEN monthly END), 0)"
        sums[f"cnt{position}"] = f"coalesce(sum(CASE WHEN contract = {quote(name)} THEN n END), 0)"
    return kpis.revenue_from(aggregate(_chosen(cells, spec), [], **sums))


def kpi_geography(cells: DataFrame, base: int = 10) -> DataFrame:
    """Places are kept without the filter fields, so this set has no filters."""
    return kpis.geography_from(cells.filter("kind = 'place'").select(*PLACE, "n", "gone"), base)


def facet_counts(cells: DataFrame, spec: dict[str, str]) -> DataFrame:
    return facets_from(aggregate(_chosen(cells, None), list(FIELD_VALUES), n="sum(n)"), spec)
