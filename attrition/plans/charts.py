"""Page charts over the feed, dashboard semantics: one hash aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions import derive
from attrition.functions.sql import aggregate, percent, ratio
from attrition.operators.domains import over_domain
from attrition.plans.kpis import ADDON_TOTAL, CHURNED, known, service_rates, total_of

TENURES = [label for label, _, _ in schemas.TENURE_BANDS]
SCORES = [label for label, _, _ in schemas.SCORE_BANDS]
TENURE = derive.tenure_band("tenure")
COUNTS = {"total": "count(1)", "churned": f"count_if({CHURNED})"}
ZIP = "coalesce(zip, '0')"
RATE = f"{percent('churned', 'total')} AS rate"


def share(value: str) -> str:
    """Percent of the whole; the total runs over the handful of domain rows."""
    return f"{percent(value, f'sum({value}) OVER ()')} AS share"


def by_contract(rows: DataFrame) -> DataFrame:
    return over_domain(rows, "contract", "contract", schemas.CONTRACTS, **COUNTS).selectExpr("*", RATE)


def by_tenure(rows: DataFrame) -> DataFrame:
    return over_domain(rows, "band", TENURE, TENURES, **COUNTS).selectExpr("*", RATE)


def by_payment(rows: DataFrame) -> DataFrame:
    out = over_domain(rows, "pay", "pay", schemas.PAYMENTS, **COUNTS)
    return out.selectExpr("*", RATE, f"{derive.short_payment('pay')} AS label")


def monthly_by_tenure(rows: DataFrame) -> DataFrame:
    out = over_domain(rows, "band", TENURE, TENURES, total="count(1)", monthly=total_of("monthly"))
    return out.selectExpr("band", f"{ratio('monthly', 'total')} AS avg_monthly")


def churn_status(rows: DataFrame) -> DataFrame:
    status = f"CASE WHEN {CHURNED} THEN 'Churned' ELSE 'Active' END"
    out = over_domain(rows, "status", status, ["Active", "Churned"], total="count(1)")
    return out.selectExpr("*", share("total"))


def internet_mix(rows: DataFrame) -> DataFrame:
    tier = derive.internet_tier("internet")
    return over_domain(rows, "internet", tier, ["Fiber optic", "DSL", "No"], total="count(1)").selectExpr(
        "*", share("total")
    )


def group_sum(rows: DataFrame, key: str, value: str, name: str = "key") -> DataFrame:
    return aggregate(rows, {name: key}, total=f"sum({value})")


def top_reasons(rows: DataFrame, k: int = 10) -> DataFrame:
    counted = group_sum(rows.filter(CHURNED), known("reason", "Unknown"), "1", "reason")
    return counted.orderBy(F.desc("total"), "reason").limit(k)


def score_histogram(rows: DataFrame) -> DataFrame:
    return over_domain(rows, "band", derive.score_bar("score"), SCORES, total="count(1)")


def service_adoption(rows: DataFrame) -> DataFrame:
    return service_rates(rows).select("service", "total")


def service_churn(rows: DataFrame) -> DataFrame:
    return service_rates(rows).select("service", "total", "churned", "rate")


def category_subscriptions(rows: DataFrame) -> DataFrame:
    """Subscriptions, so a customer counts once per service held."""
    out = aggregate(service_rates(rows), ["category"], subscriptions="sum(total)")
    return out.selectExpr("*", share("subscriptions"))


def addons_by_contract(rows: DataFrame) -> DataFrame:
    out = over_domain(
        rows, "contract", "contract", schemas.CONTRACTS, total="count(1)", addons=f"sum({ADDON_TOTAL})"
    )
    return out.selectExpr("contract", f"{ratio('addons', 'total')} AS avg_addons")


def revenue_by_contract(rows: DataFrame) -> DataFrame:
    return over_domain(rows, "contract", "contract", schemas.CONTRACTS, monthly_revenue=total_of("monthly"))


def cltv_by_tenure(rows: DataFrame) -> DataFrame:
    out = over_domain(rows, "band", TENURE, TENURES, total="count(1)", cltv=total_of("cltv"))
    return out.selectExpr("band", f"{ratio('cltv', 'total')} AS avg_cltv")


def trajectory(rows: DataFrame) -> DataFrame:
    """Average monthly charge per tenure band, active next to churned."""
    out = over_domain(
        rows,
        "band",
        TENURE,
        TENURES,
        active_n=f"count_if(NOT {CHURNED})",
        active_sum=f"sum(CASE WHEN NOT {CHURNED} THEN monthly END)",
        churned_n=f"count_if({CHURNED})",
        churned_sum=f"sum(CASE WHEN {CHURNED} THEN monthly END)",
    )
    return out.selectExpr(
        "band",
        f"{ratio('active_sum', 'active_n')} AS active_avg_monthly",
        f"{ratio('churned_sum', 'churned_n')} AS churned_avg_monthly",
    )


def payment_mix(rows: DataFrame) -> DataFrame:
    out = over_domain(rows, "pay", "pay", schemas.PAYMENTS, total="count(1)")
    return out.selectExpr("*", share("total"), f"{derive.short_payment('pay')} AS label")


def zip_centroids(rows: DataFrame) -> DataFrame:
    """Mean position of each zip; a missing coordinate counts as 0."""
    # By place first, which hashes; the smallest names are then taken from few rows.
    sums = {"lat": total_of("lat"), "lng": total_of("lng"), "n": "count(1)", "churned": f"count_if({CHURNED})"}
    sums |= {"cltv": total_of("cltv"), "revenue": total_of("monthly")}
    places = aggregate(rows, {"zip": ZIP, "city": "nullif(city, '')", "state": "nullif(state, '')"}, **sums)
    sums = aggregate(
        places, ["zip"], city="coalesce(min(city), '?')", state="coalesce(min(state), 'CA')", **{x: f"sum({x})" for x in sums}
    )
    return sums.selectExpr(
        "zip",
        "city",
        "state",
        f"{ratio('lat', 'n')} AS lat",
        f"{ratio('lng', 'n')} AS lng",
        "n",
        "churned",
        f"{percent('churned', 'n')} AS rate",
        f"{ratio('cltv', 'n')} AS avg_cltv",
        "revenue",
    )


def with_radius(zips: DataFrame) -> DataFrame:
    """Bubble radius against the largest ``n``. The window sees one row for each zip code, of
    which five digits allow a hundred thousand; the rows beneath are read once."""
    return zips.selectExpr("*", "6 + 16 * sqrt(CAST(n AS DOUBLE) / CAST(max(n) OVER () AS DOUBLE)) AS radius")


def zip_map(rows: DataFrame) -> DataFrame:
    return with_radius(zip_centroids(rows)).selectExpr("*", f"{derive.dot_level('rate')} AS level")


def map_bounds(rows: DataFrame) -> DataFrame:
    """Corners around the zip centroids; all NULL without rows."""
    return aggregate(zip_centroids(rows), [], south="min(lat)", west="min(lng)", north="max(lat)", east="max(lng)")


def top_cities(rows: DataFrame, k: int = 10) -> DataFrame:
    cities = aggregate(rows, {"city": known("city", "Unknown")}, **COUNTS)
    return cities.orderBy(F.desc("total"), "city").limit(k).selectExpr("city", "total", RATE)


def top_zips(rows: DataFrame, k: int = 10) -> DataFrame:
    places = aggregate(rows, {"zip": ZIP, "city": "nullif(city, '')"}, **COUNTS)
    zips = aggregate(places, ["zip"], city="coalesce(min(city), '?')", **{x: f"sum({x})" for x in COUNTS})
    top = zips.orderBy(F.desc("total"), "zip").limit(k)
    return top.selectExpr("concat_ws(' · ', zip, city) AS label", "total", RATE)
