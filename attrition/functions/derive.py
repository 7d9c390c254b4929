"""Derived columns as SQL text: bands, statuses, service tests."""

from __future__ import annotations

from attrition import schemas
from attrition.functions.sql import quote


def _inside(value: str, low: int | None, high: int | None) -> str:
    if low is None:
        return f"{value} <= {high}"
    if high is None:
        return f"{value} >= {low}"
    return f"{value} BETWEEN {low} AND {high}"


def banded(value: str, bands: list, default: str | None = None) -> str:
    cases = " ".join(f"WHEN {_inside(value, low, high)} THEN {quote(label)}" for label, low, high in bands)
    return f"CASE {cases}{f' ELSE {quote(default)}' if default else ''} END"


def band_order(label: str, bands: list) -> str:
    return f"nullif(array_position(array({', '.join(quote(name) for name, _, _ in bands)}), {label}), 0)"


def internet_tier(internet: str) -> str:
    return f"CASE WHEN {internet} IN ('DSL', 'Fiber optic') THEN {internet} ELSE 'No' END"


def tenure_band(tenure: str) -> str:
    """Dashboard bands; a missing tenure counts as 0, anything unplaced as the last band."""
    return banded(f"coalesce({tenure}, 0)", schemas.TENURE_BANDS, "49-72")


def score_band(score: str) -> str:
    return banded(f"coalesce({score}, 0)", schemas.SCORE_BANDS, "80-100")


def score_bar(score: str) -> str:
    """Histogram variant: a value outside every band is in no bar."""
    return banded(f"coalesce({score}, 0)", schemas.SCORE_BANDS)


def tenure_bucket(tenure: str) -> str:
    return banded(tenure, schemas.TENURE_BUCKETS)


def risk_band(score: str) -> str:
    return banded(score, schemas.RISK_BANDS)


def rate_status(rate: str) -> str:
    """Traffic light for a churn rate given as a fraction."""
    return f"CASE WHEN {rate} < 0.15D THEN 'green' WHEN {rate} <= 0.30D THEN 'amber' WHEN {rate} > 0.30D THEN 'red' END"


def rate_arrow(rate: str) -> str:
    return f"CASE WHEN {rate} < 0.15D THEN '▼' WHEN {rate} > 0.15D THEN '▲' WHEN {rate} = 0.15D THEN '➖' END"


def score_status(score: str) -> str:
    return (
        f"CASE WHEN {score} <= 49 THEN 'green' WHEN {score} <= 69 THEN 'amber' "
        f"WHEN {score} <= 84 THEN 'orange' WHEN {score} >= 85 THEN 'red' END"
    )


def dot_level(rate_pct: str) -> str:
    return (
        f"CASE WHEN {rate_pct} >= 80 THEN 4 WHEN {rate_pct} >= 60 THEN 3 "
        f"WHEN {rate_pct} >= 40 THEN 2 WHEN {rate_pct} >= 20 THEN 1 ELSE 0 END"
    )


def short_payment(pay: str) -> str:
    return f"replace({pay}, ' (automatic)', ' · Auto')"


def subscribed(alias: dict[str, str] | None = None, phone: str = "phone_service") -> dict[str, str]:
    """Service name -> test that is never NULL, over the typed-layer columns or their aliases."""
    tests = {}
    for _, name, _, source in schemas.SERVICES:
        column = (alias or {}).get(source, source)
        if source == "phone_service":
            hit = phone
        elif source == "internet_service":
            hit = f"{column} IN ('DSL', 'Fiber optic')"
        else:
            hit = f"{column} = 'Yes'"
        tests[name] = f"coalesce({hit}, false)"
    return tests


# The same tests over the feed's short names, where the phone flag is 0/1.
FEED_SUBSCRIBED = subscribed({source: short for short, source in schemas.FEED_COLUMNS.items()}, "phone = 1")
