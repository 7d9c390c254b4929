"""Page KPIs over the feed, dashboard semantics.

Averages divide by the row count (a missing value counts as 0), rates are percent
and 0 on an empty input. Each KPI row is one pass: partial aggregates, then a
single-row combine; top-1 values come from ``min`` over ordered structs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from attrition import schemas
from attrition.functions.derive import FEED_SUBSCRIBED
from attrition.functions.sql import aggregate, percent, quote, ratio

ADDONS = [name for _, name, category, _ in schemas.SERVICES if category == "Add-on"]
CHURNED = "coalesce(churn = 'Yes', false)"
ADDON_TOTAL = "(" + " + ".join(f"CAST({FEED_SUBSCRIBED[name]} AS INT)" for name in ADDONS) + ")"


def known(name: str, missing: str) -> str:
    """Text, or ``missing`` where it is NULL or empty."""
    return f"coalesce(nullif({name}, ''), {quote(missing)})"


def total_of(name: str) -> str:
    return f"coalesce(sum({name}), 0)"


def overview_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """What the overview set is made of, additive over groups."""
    return aggregate(
        rows,
        list(keys),
        total="count(1)",
        churners=f"count_if({CHURNED})",
        monthly_revenue=total_of("monthly"),
        _cltv=total_of("cltv"),
        lifetime_revenue=total_of("total"),
    )


def merge_overview(sums: DataFrame) -> DataFrame:
    """The sums of all groups together."""
    names = ["total", "churners", "monthly_revenue", "_cltv", "lifetime_revenue"]
    return aggregate(sums, [], **{name: total_of(name) for name in names})


def overview_by(rows: DataFrame, *keys: str) -> DataFrame:
    """The overview set for each group, or one row without keys."""
    return overview_from(overview_sums(rows, *keys), *keys)


def overview_from(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.selectExpr(
        *keys,
        "total",
        "churners",
        f"{percent('churners', 'total')} AS churn_rate",
        "monthly_revenue",
        f"{ratio('monthly_revenue', 'total')} AS avg_monthly",
        f"{ratio('_cltv', 'total')} AS avg_cltv",
        "lifetime_revenue",
    )


def kpi_overview(rows: DataFrame) -> DataFrame:
    return overview_by(rows)


def kpi_churn(rows: DataFrame, threshold: int = 70) -> DataFrame:
    return churn_from(churn_sums(rows, threshold))


def churn_sums(rows: DataFrame, threshold: int = 70) -> DataFrame:
    """What the churn set is made of, by reason; active customers have none."""
    return aggregate(
        rows,
        {"reason": f"CASE WHEN {CHURNED} THEN {known('reason', 'Unknown')} END"},
        n="count(1)",
        gone=f"count_if({CHURNED})",
        score="sum(score)",
        risky=f"count_if(NOT {CHURNED} AND score >= {threshold})",
        at_risk=f"sum(CASE WHEN {CHURNED} THEN monthly END)",
    )


def churn_from(by_reason: DataFrame) -> DataFrame:
    sums = aggregate(
        by_reason,
        [],
        total=total_of("n"),
        lost=total_of("gone"),
        scores=total_of("score"),
        high_risk_active=total_of("risky"),
        revenue_at_risk=total_of("at_risk"),
        top="min(CASE WHEN reason IS NOT NULL THEN struct(-gone AS rank, reason, gone) END)",
    )
    return sums.selectExpr(
        "lost AS churned",
        "total - lost AS active",
        f"{percent('lost', 'total')} AS churn_rate",
        f"{ratio('scores', 'total')} AS avg_score",
        "high_risk_active",
        "revenue_at_risk",
        "top.reason AS top_reason",
        "top.gone AS top_reason_count",
    )


# Holders and churned holders of each service: eighteen conditional counts, no unpivot.
SERVICE_COUNTS = {
    name: text
    for position, hit in enumerate(FEED_SUBSCRIBED.values())
    for name, text in (
        (f"n{position}", f"count_if({hit})"),
        (f"gone{position}", f"count_if({hit} AND {CHURNED})"),
    )
}

# Those counts as an array of structs, in catalogue order.
SERVICE_STRUCTS = "array({})".format(
    ", ".join(
        f"struct({position} AS pos, {quote(name)} AS service, {quote(category)} AS category, n{position} AS total, "
        f"gone{position} AS churned, {percent(f'gone{position}', f'n{position}')} AS rate)"
        for position, (_, name, category, _) in enumerate(schemas.SERVICES)
    )
)


def worst_service(services: str) -> str:
    """Highest churn rate; the first in the catalogue on a tie."""
    return f"array_min(transform({services}, s -> struct(-s.rate AS rank, s.pos AS tie, s.service, s.rate, s.total)))"


def best_service(services: str) -> str:
    """Lowest churn rate; the last in the catalogue on a tie."""
    return f"array_min(transform({services}, s -> struct(s.rate AS rank, -s.pos AS tie, s.service, s.rate, s.total)))"


def service_rates(rows: DataFrame) -> DataFrame:
    """One row per service: holders, churned holders, rate."""
    return aggregate(rows, [], **SERVICE_COUNTS).selectExpr(f"inline({SERVICE_STRUCTS})")


STREAMS = f"({FEED_SUBSCRIBED['Streaming TV']} OR {FEED_SUBSCRIBED['Streaming Movies']})"


def kpi_services(rows: DataFrame) -> DataFrame:
    sums = aggregate(
        rows,
        [],
        n="count(1)",
        addons=total_of(ADDON_TOTAL),
        stream=f"count_if({STREAMS})",
        suite=f"count_if({ADDON_TOTAL} > 0)",
        **SERVICE_COUNTS,
    )
    return services_from(sums)


def services_from(sums: DataFrame) -> DataFrame:
    one = sums.selectExpr("n", "addons", "stream", "suite", f"{SERVICE_STRUCTS} AS services")
    ranked = one.selectExpr("*", f"{best_service('services')} AS best", f"{worst_service('services')} AS worst")
    return ranked.selectExpr(
        "aggregate(services, 0L, (acc, s) -> acc + s.total) AS subscriptions",
        f"{ratio('addons', 'n')} AS avg_addons",
        "best.service AS best_service",
        "best.rate AS best_rate",
        "best.total AS best_n",
        "worst.service AS worst_service",
        "worst.rate AS worst_rate",
        "worst.total AS worst_n",
        f"{percent('stream', 'n')} AS streaming_pct",
        "stream AS streaming_n",
        f"{percent('suite', 'n')} AS suite_pct",
        "suite AS suite_n",
    )


def kpi_revenue(rows: DataFrame) -> DataFrame:
    sums = {}
    for position, name in enumerate(schemas.CONTRACTS):
        here = f"contract = {quote(name)}"
        sums[f"rev{position}"] = f"coalesce(sum(CASE WHEN {here} THEN monthly END), 0)"
        sums[f"cnt{position}"] = f"count_if({here})"
    one = aggregate(
        rows,
        [],
        n="count(1)",
        monthly_revenue=total_of("monthly"),
        lifetime_revenue=total_of("total"),
        cltv=total_of("cltv"),
        **sums,
    )
    return revenue_from(one)


def revenue_from(sums: DataFrame) -> DataFrame:
    ranked = [
        f"struct(-rev{position} AS rank, {position} AS pos, {quote(name)} AS contract, rev{position} AS revenue, cnt{position} AS n)"
        for position, name in enumerate(schemas.CONTRACTS)
    ]
    one = sums.selectExpr(
        "monthly_revenue",
        "lifetime_revenue",
        f"{ratio('monthly_revenue', 'n')} AS avg_monthly",
        f"{ratio('cltv', 'n')} AS avg_cltv",
        f"array_min(array({', '.join(ranked)})) AS top",
    )
    return one.selectExpr(
        "monthly_revenue",
        "lifetime_revenue",
        "avg_monthly",
        "avg_cltv",
        "top.contract AS top_contract",
        "top.revenue AS top_contract_revenue",
        "top.n AS top_contract_n",
        "CASE WHEN avg_monthly > 0 THEN avg_cltv / avg_monthly ELSE 0D END AS cltv_multiple",
    )


def kpi_geography(rows: DataFrame, base: int = 10) -> DataFrame:
    """Three groupings from one scan: places are counted together first, then apart."""
    return geography_from(aggregate(rows, ["state", "city", "zip"], n="count(1)", gone=f"count_if({CHURNED})"), base)


def geography_from(places: DataFrame, base: int = 10) -> DataFrame:
    parts = ", ".join(
        [
            f"struct('state' AS kind, {known('state', '')} AS key, {known('state', '')} <> '' AS named)",
            f"struct('city' AS kind, {known('city', 'Unknown')} AS key, {known('city', '')} <> '' AS named)",
            "struct('zip' AS kind, coalesce(zip, '0') AS key, true AS named)",
        ]
    )
    listed = places.selectExpr("n", "gone", f"inline(array({parts}))")
    keyed = aggregate(listed, ["kind", "key"], n="sum(n)", gone="sum(gone)", named="max(named)")
    keyed = keyed.selectExpr("*", f"{percent('gone', 'n')} AS rate")
    one = aggregate(
        keyed,
        [],
        states="count_if(kind = 'state' AND named)",
        cities="count_if(kind = 'city' AND named)",
        zips="count_if(kind = 'zip')",
        top_city="min(CASE WHEN kind = 'city' THEN struct(-n AS rank, key, n, rate) END)",
        top_zip="min(CASE WHEN kind = 'zip' THEN struct(-n AS rank, key, n, rate) END)",
        hot=f"min(CASE WHEN kind = 'city' AND n >= {base} THEN struct(-rate AS rank, -n AS size, key, n, rate) END)",
    )
    return one.selectExpr(
        "states",
        "cities",
        "zips",
        "top_city.key AS top_city",
        "top_city.n AS top_city_n",
        "top_zip.key AS top_zip",
        "top_zip.n AS top_zip_n",
        "top_zip.rate AS top_zip_rate",
        "hot.key AS hot_city",
        "hot.n AS hot_city_n",
        "hot.rate AS hot_city_rate",
    )
