"""Report visuals: measures by columns over the wide model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions.derive import rate_arrow, rate_status, score_status
from attrition.functions.sql import aggregate, named, ratio
from attrition.operators.filters import minimum_base, service_mask
from attrition.plans.measures import credited_services, evaluate, sums_by


def _status(df: DataFrame, rate: str = "churn_rate") -> DataFrame:
    return df.selectExpr("*", f"{rate_status(rate)} AS status", f"{rate_arrow(rate)} AS arrow")


def _top(df: DataFrame, by: str, k: int = 10) -> DataFrame:
    """Highest ``k`` and all that tie with the last of them. Each task keeps its own highest
    before the ranks are given, so few rows meet."""
    return df.selectExpr("*", f"rank() OVER (ORDER BY {by} DESC) AS _rank").filter(f"_rank <= {k}").drop("_rank")


# Card rows.


def overview_cards(model: DataFrame) -> DataFrame:
    cards = [
        "total_customers",
        "active_customers",
        "churned_customers",
        "churn_rate",
        "monthly_revenue",
        "avg_cltv",
        "high_risk_active_customers",
        "revenue_at_risk",
    ]
    return _status(evaluate(model, cards))


def churn_cards(model: DataFrame) -> DataFrame:
    cards = [
        "churn_rate",
        "churned_customers",
        "avg_tenure_months",
        "churned_avg_tenure",
        "top_churn_reason",
        "top_churn_reason_count",
    ]
    return _status(evaluate(model, cards))


def services_cards(model: DataFrame) -> DataFrame:
    cards = ["best_retention_service", "worst_retention_service", "avg_addons", "service_churn_rate"]
    return _status(evaluate(model, cards), "service_churn_rate")


def revenue_cards(model: DataFrame) -> DataFrame:
    cards = [
        "monthly_revenue",
        "lifetime_revenue",
        "avg_monthly_charge",
        "avg_cltv",
        "revenue_at_risk",
        "high_risk_revenue_exposure",
        "cltv_lost",
    ]
    return evaluate(model, cards)


def geography_cards(model: DataFrame) -> DataFrame:
    cards = [
        "geo_customers",
        "geo_churn_rate",
        "geo_high_risk",
        "geo_revenue_at_risk",
        "top_city_churn_rate",
        "top_city_churn_rate_value",
        "top_zip_churn_rate",
        "top_zip_churn_rate_value",
    ]
    return _status(evaluate(model, cards), "geo_churn_rate")


# Overview page.


def churned_vs_active(model: DataFrame) -> DataFrame:
    return evaluate(model, ["total_customers", "churn_rate"], ["ChurnLabel"])


def customers_by_contract(model: DataFrame) -> DataFrame:
    return evaluate(model, ["total_customers", "churn_rate"], ["ContractType"])


def churn_by_contract(model: DataFrame) -> DataFrame:
    out = evaluate(model, ["churn_rate", "churned_customers", "total_customers"], ["ContractType"])
    return _status(out).orderBy(F.desc("churn_rate"), "ContractType")


def tenure_buckets(model: DataFrame) -> DataFrame:
    by = ["TenureBucket", "TenureBucketOrder"]
    return evaluate(model, ["total_customers", "churn_rate", "churned_customers"], by).orderBy(by[1])


def top_reasons(model: DataFrame) -> DataFrame:
    counted = evaluate(model, ["churned_customers"], ["ChurnReason"])
    return _top(minimum_base(counted, "churned_customers", 1), "churned_customers")


def score_bands(model: DataFrame) -> DataFrame:
    counts = model.groupBy("ScoreBand", "ScoreBandOrder").pivot("ChurnLabel", ["No", "Yes"]).count()
    return counts.selectExpr(
        "ScoreBand", "ScoreBandOrder", "coalesce(No, 0) AS active", "coalesce(Yes, 0) AS churned"
    ).orderBy("ScoreBandOrder")


def revenue_by_payment(model: DataFrame) -> DataFrame:
    return evaluate(model, ["monthly_revenue"], ["PaymentMethod"]).orderBy(F.desc("monthly_revenue"), "PaymentMethod")


# Churn page.


def contract_rates(model: DataFrame) -> DataFrame:
    return evaluate(model, ["month_to_month_churn_rate", "one_year_churn_rate", "two_year_churn_rate"])


def tenure_churn(model: DataFrame) -> DataFrame:
    by = ["TenureBucket", "TenureBucketOrder"]
    return evaluate(model, ["churned_customers", "churn_rate"], by).orderBy(by[1])


def demographics(model: DataFrame) -> DataFrame:
    """Four one-column breakdowns as grouping sets over the collapsed combinations."""
    columns = ["Gender", "SeniorCitizen", "Partner", "Dependents"]
    cells = sums_by(model, columns, ["n", "gone"])
    keys = [F.col(c) for c in columns]
    flags = {f"_{c}": f"grouping({c})" for c in columns}
    sums = {"total_customers": "sum(n)", "churned_customers": "sum(gone)"}
    sets = cells.groupingSets([[key] for key in keys], *keys).agg(*named(sums | flags))
    return sets.selectExpr(
        "CASE " + " ".join(f"WHEN _{c} = 0 THEN '{c}'" for c in columns) + " END AS attribute",
        "CASE " + " ".join(f"WHEN _{c} = 0 THEN CAST({c} AS STRING)" for c in columns) + " END AS value",
        *sums,
        f"{ratio('churned_customers', 'total_customers')} AS churn_rate",
    )


def payment_by_paperless(model: DataFrame) -> DataFrame:
    out = evaluate(model, ["total_customers", "churn_rate"], ["PaymentMethod", "PaperlessBilling"])
    whole = "sum(total_customers) OVER (PARTITION BY PaymentMethod)"
    return out.selectExpr("*", f"{ratio('total_customers', whole)} AS share")


def decomposition(model: DataFrame) -> DataFrame:
    """Contract, then payment, then service category, as one rollup.

    Customers without services belong to the parents but to no category, and one who
    holds two categories is in both but once in the parents; so each collapsed
    combination is listed once for itself and once per category.
    """
    cells = sums_by(model, ["ContractType", "PaymentMethod", "ServiceMask"], ["n"])
    listed = f"concat(array(struct('' AS ServiceCategory)), {credited_services(service_mask(), ['ServiceCategory'])})"
    rows = cells.selectExpr("ContractType", "PaymentMethod", "n", f"inline({listed})")
    keys = ["ContractType", "PaymentMethod", "ServiceCategory"]
    rolled = rows.rollup(*keys).agg(
        *named(
            {
                "_listed": "sum(n)",
                "_own": "sum(CASE WHEN ServiceCategory = '' THEN n END)",
                "_open": " + ".join(f"grouping({key})" for key in keys),
            }
        )
    )
    return rolled.filter("_open > 0 OR ServiceCategory <> ''").selectExpr(
        "3 - _open AS level", *keys, "if(_open = 0, _listed, _own) AS total_customers"
    )


def reasons_by_contract(model: DataFrame) -> DataFrame:
    counted = evaluate(model, ["churned_customers"], ["ChurnReason", "ContractType"])
    return minimum_base(counted, "churned_customers", 1)


# Services page.

_SERVICE = ["service_churn_rate", "service_churned", "service_customers"]


def churn_by_service(model: DataFrame) -> DataFrame:
    return evaluate(model, _SERVICE, ["ServiceName"]).orderBy("service_churn_rate", "ServiceName")


def churn_by_category(model: DataFrame) -> DataFrame:
    return evaluate(model, _SERVICE, ["ServiceCategory"])


def service_adoption(model: DataFrame) -> DataFrame:
    return evaluate(model, ["service_customers"], ["ServiceName"])


def service_contract_matrix(model: DataFrame) -> DataFrame:
    """Churn rate per service and contract with totals. The total row is every customer
    of the column, not the sum of its services, which share customers."""
    cells = sums_by(model, ["ContractType", "ServiceMask"], ["n", "gone"])
    listed = f"concat(array(struct('Total' AS ServiceName)), {credited_services(service_mask(), ['ServiceName'])})"
    rows = cells.selectExpr("ContractType", "n", "gone", f"inline({listed})")
    sums = {
        "n": "sum(n)",
        "gone": "sum(gone)",
        "_all_services": "grouping(ServiceName)",
        "_all_contracts": "grouping(ContractType)",
    }
    cube = rows.cube("ServiceName", "ContractType").agg(*named(sums))
    rates = cube.filter("_all_services = 0").selectExpr(
        "ServiceName",
        "if(_all_contracts = 1, 'All', ContractType) AS _column",
        f"{ratio('gone', 'n')} AS rate",
    )
    wide = rates.groupBy("ServiceName").pivot("_column", [*schemas.CONTRACTS, "All"]).agg(F.first("rate"))
    return wide.toDF("ServiceName", "month_to_month", "one_year", "two_year", "total")


def addon_distribution(model: DataFrame) -> DataFrame:
    """Customers by premium add-ons held; those with none show as 0."""
    return aggregate(model, {"addon_count": "coalesce(addon_count, 0)"}, total_customers="count(1)")


def adoption_vs_churn(model: DataFrame) -> DataFrame:
    measures = ["service_customers", "service_churn_rate", "service_churned", "avg_addons"]
    return evaluate(model, measures, ["ServiceName", "ServiceCategory"])


# Revenue page.


def revenue_by_contract(model: DataFrame) -> DataFrame:
    return evaluate(model, ["monthly_revenue", "avg_monthly_charge"], ["ContractType"])


def revenue_share_by_payment(model: DataFrame) -> DataFrame:
    """The share's total is a scalar subquery, so no window gathers the groups."""
    out = evaluate(model, ["monthly_revenue"], ["PaymentMethod"])
    whole = model.agg(F.sum("MonthlyCharges")).scalar()
    shared = out.withColumn("_whole", whole)
    return shared.selectExpr(*out.columns, f"{ratio('monthly_revenue', '_whole')} AS share")


def cltv_by_contract(model: DataFrame) -> DataFrame:
    return evaluate(model, ["avg_cltv", "lifetime_revenue"], ["ContractType"])


def risk_by_reason(model: DataFrame) -> DataFrame:
    out = evaluate(model, ["revenue_at_risk", "churned_customers"], ["ChurnReason"])
    held = minimum_base(out, "churned_customers", 1).drop("churned_customers")
    return _top(held, "revenue_at_risk")


def score_vs_cltv(model: DataFrame) -> DataFrame:
    """One point per fact row: a projection, nothing gathered."""
    return model.selectExpr(
        "ChurnKey",
        "ChurnScore",
        "CLTV",
        "ChurnLabel",
        "MonthlyCharges",
        "TenureMonths",
        f"{score_status('ChurnScore')} AS score_status",
    )


def top_zips_by_revenue(model: DataFrame) -> DataFrame:
    return _top(evaluate(model, ["monthly_revenue", "geo_churn_rate"], ["ZipCode"]), "monthly_revenue")


# Geography page.

_GEO = ["geo_customers", "geo_churn_rate", "geo_high_risk", "geo_revenue_at_risk"]


def map_points(model: DataFrame) -> DataFrame:
    return evaluate(model, ["geo_customers", "geo_churn_rate", "geo_revenue_at_risk"], ["Latitude", "Longitude"])


def map_states(model: DataFrame) -> DataFrame:
    return evaluate(model, ["geo_customers", "geo_churn_rate"], ["State"])


def city_table(model: DataFrame) -> DataFrame:
    return evaluate(model, _GEO, ["City", "ZipCode"]).orderBy(F.desc("geo_churn_rate"), "City", "ZipCode")


def top_cities_by_churned(model: DataFrame) -> DataFrame:
    return _top(evaluate(model, ["churned_customers", "geo_churn_rate"], ["City"]), "churned_customers")


def top_zips_by_rate(model: DataFrame, base: int = 3) -> DataFrame:
    sized = minimum_base(evaluate(model, ["geo_customers", "geo_churn_rate"], ["ZipCode"]), "geo_customers", base)
    return _top(sized, "geo_churn_rate")


def city_quadrant(model: DataFrame) -> DataFrame:
    return evaluate(model, ["geo_customers", "geo_churn_rate", "geo_high_risk"], ["City"])


_TOOLTIP = ["total_customers", "churned_customers", "churn_rate", "monthly_revenue", "avg_cltv", "revenue_at_risk"]


def tooltip(model: DataFrame, column: str) -> DataFrame:
    return evaluate(model, _TOOLTIP, [column])
