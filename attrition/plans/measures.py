"""Named measures that evaluate under any grouping and filter context.

Every measure is a formula over additive sums, so a context costs one partial and
one final aggregation. Service groupings stay non-additive: facts collapse per
service combination (at most 512) before a combination is credited to each
service it holds, and a customer counts once per service or category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions.sql import aggregate, quote, ratio
from attrition.operators.filters import filter_model, plain_spec, service_mask

SERVICE_FIELDS = ("ServiceName", "ServiceCategory")


GONE = "ChurnLabel = 'Yes'"


def _sums(threshold: int) -> dict[str, str]:
    """The additive building blocks."""
    risky = f"ChurnLabel = 'No' AND ChurnScore >= {int(threshold)}"
    sums = {
        "n": "count(1)",
        "active": "count_if(ChurnLabel = 'No')",
        "gone": f"count_if({GONE})",
        "risky": f"count_if({risky})",
        "score": "sum(ChurnScore)",
        "score_n": "count(ChurnScore)",
        "monthly": "sum(MonthlyCharges)",
        "monthly_n": "count(MonthlyCharges)",
        "monthly_gone": f"sum(MonthlyCharges) FILTER (WHERE {GONE})",
        "monthly_risky": f"sum(MonthlyCharges) FILTER (WHERE {risky})",
        "lifetime": "sum(TotalCharges)",
        "lifetime_gone": f"sum(TotalCharges) FILTER (WHERE {GONE})",
        "cltv": "sum(CLTV)",
        "cltv_n": "count(CLTV)",
        "cltv_gone": f"sum(CLTV) FILTER (WHERE {GONE})",
        "tenure": "sum(TenureMonths)",
        "tenure_n": "count(TenureMonths)",
        "tenure_gone": f"sum(TenureMonths) FILTER (WHERE {GONE})",
        "tenure_gone_n": f"count(TenureMonths) FILTER (WHERE {GONE})",
        "addons": "sum(addon_count)",
        "addons_n": "count(addon_count)",
    }
    for position, name in enumerate(schemas.CONTRACTS):
        here = f"ContractType = {quote(name)}"
        sums[f"contract{position}_n"] = f"count_if({here})"
        sums[f"contract{position}_gone"] = f"count_if({here} AND {GONE})"
    return sums


def _mean(total: str, count: str) -> tuple[list[str], str]:
    """NULL, not 0, where there is nothing to average."""
    return [total, count], f"try_divide(CAST({total} AS DOUBLE), CAST({count} AS DOUBLE))"


def _rate(part: str, whole: str) -> tuple[list[str], str]:
    return [part, whole], ratio(part, whole)


def _count(name: str) -> tuple[list[str], str]:
    return [name], name


def _money(name: str) -> tuple[list[str], str]:
    return [name], f"coalesce({name}, 0)"


# Measure -> (sums it needs, formula).
PLAIN = {
    "total_customers": _count("n"),
    "active_customers": _count("active"),
    "churned_customers": _count("gone"),
    "churn_rate": _rate("gone", "n"),
    "retention_rate": _rate("active", "n"),
    "avg_churn_score": _mean("score", "score_n"),
    "high_risk_active_customers": _count("risky"),
    "active_high_risk_share": _rate("risky", "active"),
    "monthly_revenue": _money("monthly"),
    "lifetime_revenue": _money("lifetime"),
    "avg_monthly_charge": _mean("monthly", "monthly_n"),
    "avg_cltv": _mean("cltv", "cltv_n"),
    "revenue_at_risk": _money("monthly_gone"),
    "high_risk_revenue_exposure": _money("monthly_risky"),
    "lost_lifetime_revenue": _money("lifetime_gone"),
    "cltv_lost": _money("cltv_gone"),
    "avg_tenure_months": _mean("tenure", "tenure_n"),
    "churned_avg_tenure": _mean("tenure_gone", "tenure_gone_n"),
    "service_customers": _count("n"),
    "service_churned": _count("gone"),
    "service_churn_rate": _rate("gone", "n"),
    "avg_addons": _mean("addons", "addons_n"),
    "geo_customers": _count("n"),
    "geo_churn_rate": _rate("gone", "n"),
    "geo_high_risk": _count("risky"),
    "geo_revenue_at_risk": _money("monthly_gone"),
}
# Rates that replace the contract in the context by their own.
CONTRACT_RATES = {
    name: _rate(f"contract{position}_gone", f"contract{position}_n")
    for position, name in enumerate(
        ["month_to_month_churn_rate", "one_year_churn_rate", "two_year_churn_rate"]
    )
}
REASON = ["top_churn_reason", "top_churn_reason_count"]
RETENTION = ["best_retention_service", "worst_retention_service"]
# Measure pair -> (column, smallest group that competes).
PLACES = {"top_city_churn_rate": ("City", 10), "top_zip_churn_rate": ("ZipCode", 3)}

# The measure names by report page.
FOLDERS = {
    "overview": [
        "total_customers",
        "active_customers",
        "churned_customers",
        "churn_rate",
        "retention_rate",
        "avg_churn_score",
        "high_risk_active_customers",
        "active_high_risk_share",
    ],
    "revenue": [
        "monthly_revenue",
        "lifetime_revenue",
        "avg_monthly_charge",
        "avg_cltv",
        "revenue_at_risk",
        "high_risk_revenue_exposure",
        "lost_lifetime_revenue",
        "cltv_lost",
    ],
    "churn": [
        "avg_tenure_months",
        "churned_avg_tenure",
        "month_to_month_churn_rate",
        "one_year_churn_rate",
        "two_year_churn_rate",
        "top_churn_reason",
        "top_churn_reason_count",
    ],
    "services": [
        "service_customers",
        "service_churned",
        "service_churn_rate",
        "avg_addons",
        "best_retention_service",
        "worst_retention_service",
    ],
    "geography": [
        "geo_customers",
        "geo_churn_rate",
        "geo_high_risk",
        "geo_revenue_at_risk",
        "top_city_churn_rate",
        "top_city_churn_rate_value",
        "top_zip_churn_rate",
        "top_zip_churn_rate_value",
    ],
}
MEASURES = [name for names in FOLDERS.values() for name in names]


def holds(bits: int) -> str:
    return f"ServiceMask & {bits} <> 0"


def credited_services(allowed: int, fields: Sequence[str]) -> str:
    """The services (or categories) of ``ServiceMask`` as an array of structs, each listed once."""
    entries = []
    if "ServiceName" in fields:
        for key, name, category, _ in schemas.SERVICES:
            if allowed >> (key - 1) & 1:
                entries.append((1 << (key - 1), {"ServiceName": name, "ServiceCategory": category}))
    else:
        for category in schemas.CATEGORIES:
            bits = allowed & service_mask(categories=[category])
            if bits:
                entries.append((bits, {"ServiceCategory": category}))
    shown = [field for field in SERVICE_FIELDS if field in fields]
    held = []
    for bits, labels in entries:
        item = ", ".join(f"{quote(labels[field])} AS {field}" for field in shown)
        held.append(f"CASE WHEN {holds(bits)} THEN struct({item}) END")
    kind = f"ARRAY<STRUCT<{', '.join(f'{field}: STRING' for field in shown)}>>"
    return f"array_compact(CAST(array({', '.join(held)}) AS {kind}))"


def sums_by(
    model: DataFrame, by: Sequence[str], names: Sequence[str], spec: dict | None = None, threshold: int = 70
) -> DataFrame:
    """The named sums for each group of ``by``, which may hold service fields."""
    spec = plain_spec(spec)
    columns = _sums(threshold)
    rows = filter_model(model, spec)
    by = list(dict.fromkeys(by))
    wanted = {name: columns[name] for name in names}
    service_by = [field for field in by if field in SERVICE_FIELDS]
    if not service_by:
        return aggregate(rows, by, **wanted)
    allowed = service_mask(spec.get("ServiceName"), spec.get("ServiceCategory"))
    plain = [field for field in by if field not in SERVICE_FIELDS]
    combined = aggregate(rows, [*plain, "ServiceMask"], **wanted)
    credited = combined.selectExpr(*plain, *names, f"inline({credited_services(allowed, service_by)})")
    return aggregate(credited, by, **{name: f"sum({name})" for name in names})


def _rolled(names: Sequence[str]) -> dict[str, str]:
    """Sums of finer sums; counts of nothing are 0."""
    texts = _sums(0)
    return {x: f"coalesce(sum({x}), 0)" if texts[x].startswith("count") else f"sum({x})" for x in names}


def _needed(formulas: dict) -> list[str]:
    return list(dict.fromkeys(name for names, _ in formulas.values() for name in names))


def _join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach columns by group, NULL groups included; without groups the right side is one
    row and comes in as a scalar subquery."""
    if not by:
        row = right.select(F.struct(*right.columns)).scalar()
        return left.withColumn("_row", row).selectExpr(*left.columns, *[f"_row.{name}" for name in right.columns])
    other = right.selectExpr(*[f"{c} AS _{c}" if c in by else c for c in right.columns])
    condition = F.expr(" AND ".join(f"{c} <=> _{c}" for c in by))
    return left.join(other, condition, "left").drop(*[f"_{c}" for c in by])


def _reasons(model, by, spec, threshold, carry) -> DataFrame:
    """Most frequent reason per group; the alphabetically last one on a tie."""
    fine = sums_by(model, [*by, "ChurnReason"], dict.fromkeys([*carry, "gone"]), spec, threshold)
    top = aggregate(fine, by, **_rolled(carry), _top="max(struct(gone, ChurnReason)) FILTER (WHERE gone > 0)")
    return top.selectExpr(*by, *carry, f"_top.ChurnReason AS {REASON[0]}", f"_top.gone AS {REASON[1]}")


def _retention(model, by, spec, threshold, carry) -> DataFrame:
    """Services with the lowest and highest churn rate; a service nobody holds has rate 0.

    Grouped by a service field, the services that compete are those of the group. Besides
    one entry for each service, a combination has one without, which carries the sums
    of its customers; grouping by service cannot carry any.
    """
    service_by = [field for field in by if field in SERVICE_FIELDS]
    plain = [field for field in by if field not in SERVICE_FIELDS]
    allowed = service_mask(spec.get("ServiceName"), spec.get("ServiceCategory"))
    combined = sums_by(model, [*plain, "ServiceMask"], dict.fromkeys([*carry, "n", "gone"]), spec, threshold)
    entries = []
    for key, name, category, _ in schemas.SERVICES:
        if allowed >> (key - 1) & 1:
            held = holds(1 << (key - 1))
            labels = {"ServiceName": name, "ServiceCategory": category}
            fields = [f"{quote(name)} AS service", f"if({held}, n, 0) AS held", f"if({held}, gone, 0) AS lost"]
            fields += [f"{quote(labels[field])} AS {field}" for field in service_by]
            entries.append(f"struct({', '.join([*fields, *[f'if(false, {x}, NULL) AS {x}_all' for x in carry]])})")
    if carry:
        fields = ["CAST(NULL AS STRING) AS service", "0L AS held", "0L AS lost"]
        entries.append(f"struct({', '.join([*fields, *[f'{x} AS {x}_all' for x in carry]])})")
    if not entries:
        return combined.selectExpr(*plain, *[f"'' AS {x}" for x in [*service_by, *RETENTION]]).filter("false")
    listed = combined.selectExpr(*plain, f"inline(array({', '.join(entries)}))")
    rates = aggregate(
        listed, [*by, "service"], rate=ratio("sum(lost)", "sum(held)"), **{x: f"sum({x}_all)" for x in carry}
    )
    return aggregate(
        rates,
        by,
        **_rolled(carry),
        **{
            RETENTION[0]: "(max(struct(-rate AS rank, service)) FILTER (WHERE service IS NOT NULL)).service",
            RETENTION[1]: "(max(struct(rate, service)) FILTER (WHERE service IS NOT NULL)).service",
        },
    )


def _places(model, by, spec, threshold, carry, name) -> DataFrame:
    """The place with the highest churn rate among those of a minimum size."""
    column, base = PLACES[name]
    fine = sums_by(model, [*by, column], dict.fromkeys([*carry, "n", "gone"]), spec, threshold)
    best = f"max(struct({ratio('gone', 'n')} AS rate, {column})) FILTER (WHERE n >= {base})"
    top = aggregate(fine, by, **_rolled(carry), _top=best)
    return top.selectExpr(*by, *carry, f"_top.{column} AS {name}", f"_top.rate AS {name}_value")


def _contracts(model, by, spec, threshold, carry, formulas) -> DataFrame:
    """Rates of each contract, whatever contract the group or the filter names.

    One pass by group and contract without the contract filter: the rates are sums over
    all contracts of a group, the carried sums those of the contracts that pass.
    """
    others = [field for field in by if field != "ContractType"]
    open_spec = {field: values for field, values in spec.items() if field != "ContractType"}
    needed = _needed(formulas)
    fine = sums_by(model, [*by, "ContractType"], dict.fromkeys([*carry, *needed]), open_spec, threshold)
    # Without other groups this window sees one row for each contract.
    over = f"OVER (PARTITION BY {', '.join(others)})" if others else "OVER ()"
    opened = fine.selectExpr("*", *[f"sum({x}) {over} AS _{x}" for x in needed])
    if "ContractType" in spec:
        opened = opened.filter(F.col("ContractType").isin(spec["ContractType"]))
    found = aggregate(opened, by, **_rolled(carry), **{f"_{x}": f"max(_{x})" for x in needed})
    renamed = found.selectExpr(*by, *carry, *[f"_{x} AS {x}" for x in needed if x not in carry])
    return renamed.selectExpr(*by, *carry, *[f"{formula} AS {name}" for name, (_, formula) in formulas.items()])


def evaluate(
    model: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    spec: dict | None = None,
    threshold: int = 70,
) -> DataFrame:
    """The measures for each group of ``by`` under the filters of ``spec``."""
    spec, by = plain_spec(spec), list(by)
    unknown = [name for name in measures if name not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures: {', '.join(unknown)}")
    formulas = {name: PLAIN[name] for name in measures if name in PLAIN}
    contract = {name: CONTRACT_RATES[name] for name in measures if name in CONTRACT_RATES}
    parts = []
    if contract and ("ContractType" in by or "ContractType" in spec):
        parts.append(lambda carry: _contracts(model, by, spec, threshold, carry, contract))
    else:
        formulas |= contract
    if any(name in REASON for name in measures):
        parts.append(lambda carry: _reasons(model, by, spec, threshold, carry))
    for place in PLACES:
        if place in measures or f"{place}_value" in measures:
            parts.append(lambda carry, place=place: _places(model, by, spec, threshold, carry, place))
    if any(name in RETENTION for name in measures):
        parts.append(lambda carry: _retention(model, by, spec, threshold, carry))

    # The groups come from the rows of the context, and so do the plain sums: the first finer
    # aggregate carries both, unless it credits services.
    needed = _needed(formulas) or ["n"]
    services = any(field in SERVICE_FIELDS for field in by)
    if not parts or (services and len(parts) == 1 and any(name in RETENTION for name in measures)):
        sums = sums_by(model, by, needed, spec, threshold)
    else:
        sums = parts.pop(0)(needed)
    out = sums.selectExpr(
        *by,
        *[name for name in sums.columns if name in MEASURES],
        *[f"{formula} AS {name}" for name, (_, formula) in formulas.items()],
    )
    for part in parts:
        out = _join(out, part([]), by)
    counted = f"coalesce({REASON[1]}, 0) AS {REASON[1]}"
    return out.selectExpr(*by, *[counted if name == REASON[1] else name for name in measures])
