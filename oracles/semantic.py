"""Oracles for the semantic model: measures, slicers and report visuals."""

from oracles.dashboard import CATEGORY
from oracles.medallion import union

YES, NO = "ChurnLabel = 'Yes'", "ChurnLabel = 'No'"


def per(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0.0)"


def mean(name: str, test: str = "true") -> str:
    return f"CAST(sum({name}) FILTER ({test}) AS DOUBLE) / nullif(count({name}) FILTER ({test}), 0)"


def money(name: str, test: str = "true") -> str:
    return f"CAST(coalesce(sum({name}) FILTER ({test}), 0) AS DOUBLE)"


def rows(test: str = "true") -> str:
    return f"count(*) FILTER ({test})"


def plain(threshold: int = 70) -> dict[str, str]:
    risky = f"ChurnScore >= {threshold} AND {NO}"
    return {
        "total_customers": rows(),
        "active_customers": rows(NO),
        "churned_customers": rows(YES),
        "churn_rate": per(rows(YES), rows()),
        "retention_rate": per(rows(NO), rows()),
        "avg_churn_score": mean("ChurnScore"),
        "high_risk_active_customers": rows(risky),
        "active_high_risk_share": per(rows(risky), rows(NO)),
        "monthly_revenue": money("MonthlyCharges"),
        "lifetime_revenue": money("TotalCharges"),
        "avg_monthly_charge": mean("MonthlyCharges"),
        "avg_cltv": mean("CLTV"),
        "revenue_at_risk": money("MonthlyCharges", YES),
        "high_risk_revenue_exposure": money("MonthlyCharges", risky),
        "lost_lifetime_revenue": money("TotalCharges", YES),
        "cltv_lost": f"CAST(coalesce(sum(CLTV) FILTER ({YES}), 0) AS BIGINT)",
        "avg_tenure_months": mean("TenureMonths"),
        "churned_avg_tenure": mean("TenureMonths", YES),
        "service_customers": rows(),
        "service_churned": rows(YES),
        "service_churn_rate": per(rows(YES), rows()),
        "avg_addons": mean("addon_count"),
        "geo_customers": rows(),
        "geo_churn_rate": per(rows(YES), rows()),
        "geo_high_risk": rows(risky),
        "geo_revenue_at_risk": money("MonthlyCharges", YES),
    }


CONTRACT_RATES = {
    "month_to_month_churn_rate": "Month-to-month",
    "one_year_churn_rate": "One year",
    "two_year_churn_rate": "Two year",
}
FOLDERS = {
    "overview": list(plain())[:8],
    "revenue": list(plain())[8:16],
    "churn": [
        "avg_tenure_months",
        "churned_avg_tenure",
        *CONTRACT_RATES,
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
# Facts next to each service (category) their customer holds, once per category.
BY_SERVICE = ", held AS (SELECT m.*, b.ServiceName, b.ServiceCategory FROM model m JOIN bridge b USING (CustomerKey))"
BY_CATEGORY = """, held AS (SELECT m.*, b.ServiceCategory FROM model m
 JOIN (SELECT DISTINCT CustomerKey, ServiceCategory FROM bridge) b USING (CustomerKey))"""


def correlated(name: str, source: str, by: list[str], opened: str) -> str:
    """A measure that is not a plain aggregate, as a subquery over the group ``g``."""
    same = "".join(f" AND t.{c} IS NOT DISTINCT FROM g.{c}" for c in by)
    if name in CONTRACT_RATES:
        other = "".join(f" AND t.{c} IS NOT DISTINCT FROM g.{c}" for c in by if c != "ContractType")
        only = f"t.ContractType = '{CONTRACT_RATES[name]}'{other}"
        return f"(SELECT {per(f'count(*) FILTER (t.{YES})', 'count(*)')} FROM {opened} t WHERE {only})"
    if name in ("top_churn_reason", "top_churn_reason_count"):
        out = "t.ChurnReason" if name == "top_churn_reason" else "count(*)"
        pick = f"""(SELECT {out} FROM {source} t WHERE t.{YES}{same} GROUP BY t.ChurnReason
 ORDER BY count(*) DESC, t.ChurnReason DESC NULLS LAST LIMIT 1)"""
        return pick if name == "top_churn_reason" else f"coalesce({pick}, 0)"
    if name.endswith("_retention_service"):
        order = "ASC" if name.startswith("best") else "DESC"
        return f"""(SELECT d.ServiceName FROM dim_service d LEFT JOIN (SELECT t.*, b.ServiceKey FROM {source} t
 JOIN bridge b USING (CustomerKey) WHERE true{same}) t USING (ServiceKey) WHERE {{services}} GROUP BY d.ServiceName
 ORDER BY {per(f'count(*) FILTER (t.{YES})', 'count(t.ChurnKey)')} {order}, d.ServiceName DESC LIMIT 1)"""
    column, base = ("City", 10) if "city" in name else ("ZipCode", 3)
    rate = f"CAST(count(*) FILTER (t.{YES}) AS DOUBLE) / count(*)"
    out = rate if name.endswith("_value") else f"t.{column}"
    return f"""(SELECT {out} FROM {source} t WHERE true{same} GROUP BY t.{column} HAVING count(*) >= {base}
 ORDER BY {rate} DESC, t.{column} DESC LIMIT 1)"""


def select(
    measures: list[str],
    by: list[str] = (),
    source: str = "model",
    opened: str | None = None,
    threshold: int = 70,
    services: str = "true",
) -> str:
    expressions, by = plain(threshold), list(by)
    inner = [f"{expressions[m]} AS {m}" for m in measures if m in expressions]
    group = f" GROUP BY {', '.join(by)}" if by else ""
    base = f"SELECT {', '.join([*by, *inner]) or 'count(*)'} FROM {source}{group}"
    if all(m in expressions for m in measures):
        return base
    if not inner:
        base = f"SELECT {', '.join([*by, 'count(*) AS n_'])} FROM {source}{group}"
    outer = [
        f"g.{m}"
        if m in expressions
        else correlated(m, source, by, opened or source).replace("{services}", services) + f" AS {m}"
        for m in measures
    ]
    return f"SELECT {', '.join([f'g.{c}' for c in by] + outer)} FROM ({base}) g"


def status(rate: str) -> str:
    return f"""CASE WHEN {rate} < 0.15 THEN 'green' WHEN {rate} <= 0.3 THEN 'amber' ELSE 'red' END AS status,
 CASE WHEN {rate} < 0.15 THEN '▼' WHEN {rate} > 0.15 THEN '▲' ELSE '➖' END AS arrow"""


def carded(body: str, rate: str = "churn_rate") -> str:
    return f"SELECT *, {status(rate)} FROM ({body})"


TEXTS: dict[str, str] = {}
_GROUPING = {
    "overview": ["ContractType"],
    "revenue": ["PaymentMethod"],
    "churn": ["ContractType", "Gender"],
    "services": ["ServiceName"],
    "geography": ["State"],
}
for _position, _name in enumerate(MEASURES, start=1):
    _folder = next(f for f, names in FOLDERS.items() if _name in names)
    if _name.endswith("_retention_service"):
        _body = select([_name], ["ContractType"])
    elif _folder == "services":
        _body = f"{BY_SERVICE} {select([_name], ['ServiceName'], 'held')}"
    else:
        _body = select([_name], _GROUPING[_folder])
    TEXTS[f"m{_position}_{_name}"] = _body

_KEEP = """Gender = 'Female' AND CustomerKey IN
 (SELECT CustomerKey FROM bridge WHERE ServiceCategory = 'Add-on')"""
TEXTS["m_retention_all_services"] = select(["best_retention_service", "worst_retention_service"])
TEXTS["m_retention_by_service"] = """SELECT DISTINCT ServiceName, ServiceName AS best_retention_service,
 ServiceName AS worst_retention_service FROM bridge JOIN fact_churn USING (CustomerKey)"""
TEXTS["m_retention_by_category"] = f""", rates AS (SELECT d.ServiceCategory, d.ServiceName,
 coalesce(CAST(count(*) FILTER ({YES}) AS DOUBLE) / nullif(count(ChurnKey), 0), 0) AS rate
 FROM dim_service d LEFT JOIN bridge b USING (ServiceKey) LEFT JOIN fact_churn f ON f.CustomerKey = b.CustomerKey GROUP BY ALL)
SELECT ServiceCategory,
 (SELECT ServiceName FROM rates r WHERE r.ServiceCategory = g.ServiceCategory ORDER BY rate, ServiceName DESC LIMIT 1)
  AS best_retention_service,
 (SELECT ServiceName FROM rates r WHERE r.ServiceCategory = g.ServiceCategory ORDER BY rate DESC, ServiceName DESC LIMIT 1)
  AS worst_retention_service, count(DISTINCT ChurnKey) AS service_customers
FROM bridge g JOIN fact_churn USING (CustomerKey) GROUP BY ServiceCategory"""
TEXTS["m_no_services"] = "SELECT '' AS ServiceName, 0::BIGINT AS service_customers WHERE false"
TEXTS["m_all_total"] = select(MEASURES)
TEXTS["m_all_by_state_filtered"] = (
    f""", opened AS (SELECT * FROM model WHERE {_KEEP}),
kept AS (SELECT * FROM opened WHERE ContractType IN ('Month-to-month', 'One year'))
"""
    + select(MEASURES, ["State"], "kept", "opened", 60, "d.ServiceCategory = 'Add-on'")
)

_BUCKET = "TenureBucket, CAST(TenureBucketOrder AS BIGINT) AS TenureBucketOrder"
_P = plain()


def bucketed(measures: list[str]) -> str:
    return f"""SELECT {_BUCKET}, {', '.join(f'{_P[m]} AS {m}' for m in measures)}
 FROM model GROUP BY TenureBucket, TenureBucketOrder"""


_SERVICE = ["service_churn_rate", "service_churned", "service_customers"]
_GEO = ["geo_customers", "geo_churn_rate", "geo_high_risk", "geo_revenue_at_risk"]
_TOOLTIP = ["total_customers", "churned_customers", "churn_rate", "monthly_revenue", "avg_cltv", "revenue_at_risk"]
_CELL = per(rows(YES), rows())


def matrix(label: str, source: str) -> str:
    cells = ", ".join(
        f"CAST(count(*) FILTER ({YES} AND ContractType = '{c}') AS DOUBLE) / nullif(count(*) FILTER "
        f"(ContractType = '{c}'), 0) AS {a}"
        for c, a in [("Month-to-month", "month_to_month"), ("One year", "one_year"), ("Two year", "two_year")]
    )
    return f"SELECT {label} AS ServiceName, {cells}, {_CELL} AS total FROM {source}"


def demographic(column: str) -> str:
    return f"""SELECT '{column}' AS attribute, CAST({column} AS VARCHAR) AS value, {rows()} AS total_customers,
 {rows(YES)} AS churned_customers, {_CELL} AS churn_rate FROM model GROUP BY {column}"""


TEXTS |= {
    "p0a_overview_cards": carded(
        select(
            [
                "total_customers",
                "active_customers",
                "churned_customers",
                "churn_rate",
                "monthly_revenue",
                "avg_cltv",
                "high_risk_active_customers",
                "revenue_at_risk",
            ]
        )
    ),
    "p0b_churn_cards": carded(
        select(
            [
                "churn_rate",
                "churned_customers",
                "avg_tenure_months",
                "churned_avg_tenure",
                "top_churn_reason",
                "top_churn_reason_count",
            ]
        )
    ),
    "p0c_services_cards": carded(
        select(["best_retention_service", "worst_retention_service", "avg_addons", "service_churn_rate"]),
        "service_churn_rate",
    ),
    "p0d_revenue_cards": select(
        [
            "monthly_revenue",
            "lifetime_revenue",
            "avg_monthly_charge",
            "avg_cltv",
            "revenue_at_risk",
            "high_risk_revenue_exposure",
            "cltv_lost",
        ]
    ),
    "p0e_geography_cards": carded(select(FOLDERS["geography"]), "geo_churn_rate"),
    "p1_churned_vs_active": select(["total_customers", "churn_rate"], ["ChurnLabel"]),
    "p2_customers_by_contract": select(["total_customers", "churn_rate"], ["ContractType"]),
    "p3_churn_by_contract": carded(select(["churn_rate", "churned_customers", "total_customers"], ["ContractType"])),
    "p4_tenure_buckets": bucketed(["total_customers", "churn_rate", "churned_customers"]),
    "p5_top_reasons": f"""SELECT ChurnReason, {rows()} AS churned_customers FROM model WHERE {YES}
 GROUP BY ChurnReason QUALIFY rank() OVER (ORDER BY churned_customers DESC) <= 10""",
    "p6_score_bands": f"""SELECT ScoreBand, CAST(ScoreBandOrder AS BIGINT) AS ScoreBandOrder, {rows(NO)} AS active,
 {rows(YES)} AS churned FROM model GROUP BY ScoreBand, ScoreBandOrder""",
    "p7_revenue_by_payment": select(["monthly_revenue"], ["PaymentMethod"]),
    "p8_contract_rates": select(list(CONTRACT_RATES)),
    "p9_tenure_churn": bucketed(["churned_customers", "churn_rate"]),
    "p10_demographics": union([demographic(c) for c in ["Gender", "SeniorCitizen", "Partner", "Dependents"]]),
    "p11_payment_by_paperless": f"""SELECT PaymentMethod, PaperlessBilling, {rows()} AS total_customers,
 {_CELL} AS churn_rate, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY PaymentMethod) AS share
 FROM model GROUP BY PaymentMethod, PaperlessBilling""",
    "p12_decomposition": f"""{BY_SERVICE}
SELECT CAST(0 AS BIGINT) AS level, NULL AS ContractType, NULL AS PaymentMethod, NULL AS ServiceCategory,
 count(*) AS total_customers FROM model
UNION ALL SELECT 1, ContractType, NULL, NULL, count(*) FROM model GROUP BY ContractType
UNION ALL SELECT 2, ContractType, PaymentMethod, NULL, count(*) FROM model GROUP BY ContractType, PaymentMethod
UNION ALL SELECT 3, ContractType, PaymentMethod, ServiceCategory, count(DISTINCT CustomerKey) FROM held
 GROUP BY ContractType, PaymentMethod, ServiceCategory""",
    "p13_reasons_by_contract": f"""SELECT ChurnReason, ContractType, {rows()} AS churned_customers FROM model
 WHERE {YES} GROUP BY ChurnReason, ContractType""",
    "p14_churn_by_service": f"{BY_SERVICE} {select(_SERVICE, ['ServiceName'], 'held')}",
    "p15_churn_by_category": f"{BY_CATEGORY} {select(_SERVICE, ['ServiceCategory'], 'held')}",
    "p16_service_adoption": f"{BY_SERVICE} {select(['service_customers'], ['ServiceName'], 'held')}",
    "p17_service_contract_matrix": f"""{BY_SERVICE} {matrix('ServiceName', 'held')} GROUP BY ServiceName
 UNION ALL {matrix("'Total'", 'model')}""",
    "p18_addon_distribution": """SELECT CAST(coalesce(addon_count, 0) AS BIGINT) AS addon_count,
 count(*) AS total_customers FROM model GROUP BY 1""",
    "p19_adoption_vs_churn": BY_SERVICE
    + " "
    + select(
        ["service_customers", "service_churn_rate", "service_churned", "avg_addons"],
        ["ServiceName", "ServiceCategory"],
        "held",
    ),
    "p20_revenue_by_contract": select(["monthly_revenue", "avg_monthly_charge"], ["ContractType"]),
    "p21_revenue_share_by_payment": """SELECT PaymentMethod, CAST(sum(MonthlyCharges) AS DOUBLE) AS monthly_revenue,
 CAST(sum(MonthlyCharges) AS DOUBLE) / CAST((SELECT sum(MonthlyCharges) FROM model) AS DOUBLE) AS share
 FROM model GROUP BY PaymentMethod""",
    "p22_cltv_by_contract": select(["avg_cltv", "lifetime_revenue"], ["ContractType"]),
    "p23_risk_by_reason": f"""SELECT ChurnReason, {money('MonthlyCharges')} AS revenue_at_risk FROM model
 WHERE {YES} GROUP BY ChurnReason QUALIFY rank() OVER (ORDER BY revenue_at_risk DESC) <= 10""",
    "p24_score_vs_cltv": """SELECT ChurnKey, CAST(ChurnScore AS BIGINT) AS ChurnScore, CAST(CLTV AS BIGINT) AS CLTV,
 ChurnLabel, CAST(MonthlyCharges AS DOUBLE) AS MonthlyCharges, CAST(TenureMonths AS BIGINT) AS TenureMonths,
 CASE WHEN ChurnScore < 50 THEN 'green' WHEN ChurnScore < 70 THEN 'amber' WHEN ChurnScore < 85 THEN 'orange'
 WHEN ChurnScore >= 85 THEN 'red' END AS score_status FROM fact_churn""",
    "p25_top_zips_by_revenue": select(["monthly_revenue", "geo_churn_rate"], ["ZipCode"])
    + " QUALIFY rank() OVER (ORDER BY monthly_revenue DESC) <= 10",
    "p26_map_points": """SELECT CAST(Latitude AS DOUBLE) AS Latitude, CAST(Longitude AS DOUBLE) AS Longitude,
 geo_customers, geo_churn_rate, geo_revenue_at_risk FROM ("""
    + select(["geo_customers", "geo_churn_rate", "geo_revenue_at_risk"], ["Latitude", "Longitude"])
    + ")",
    "p26_map_states": select(["geo_customers", "geo_churn_rate"], ["State"]),
    "p27_city_table": select(_GEO, ["City", "ZipCode"]),
    "p28_top_cities_by_churned": select(["churned_customers", "geo_churn_rate"], ["City"])
    + " QUALIFY rank() OVER (ORDER BY churned_customers DESC) <= 10",
    "p29_top_zips_by_rate": select(["geo_customers", "geo_churn_rate"], ["ZipCode"])
    + " HAVING count(*) >= 3 QUALIFY rank() OVER (ORDER BY geo_churn_rate DESC) <= 10",
    "p30_city_quadrant": select(["geo_customers", "geo_churn_rate", "geo_high_risk"], ["City"]),
    "p31_tooltip_contract": select(_TOOLTIP, ["ContractType"]),
    "p31_tooltip_service": f"{BY_SERVICE} {select(_TOOLTIP, ['ServiceName'], 'held')}",
    "p31_tooltip_reason": select(_TOOLTIP, ["ChurnReason"]),
    "f4_bridge_filter": """SELECT ChurnKey, CustomerKey, ChurnLabel FROM fact_churn WHERE CustomerKey IN
 (SELECT CustomerKey FROM bridge WHERE ServiceCategory = 'Add-on')""",
    "f4_model_filter": f"""SELECT ChurnKey, CustomerID, ContractType, ChurnLabel FROM model WHERE {_KEEP}
 AND ContractType IN ('Month-to-month', 'One year') AND State IN ('NATION_1', 'NATION_2', 'NATION_3')""",
    "f5_threshold_sweep": f"""SELECT CAST(t.threshold AS BIGINT) AS threshold, count(m.ChurnKey) AS high_risk_active,
 CAST(coalesce(sum(m.MonthlyCharges), 0) AS DOUBLE) AS exposure FROM range(101) AS t(threshold)
 LEFT JOIN (SELECT * FROM model WHERE {NO}) m ON m.ChurnScore >= t.threshold GROUP BY t.threshold""",
    "f8_regional_rows": "SELECT ChurnKey, State, ChurnLabel FROM model WHERE State IN ('NATION_1', 'NATION_7')",
    "f8_executive_rows": "SELECT ChurnKey, State, ChurnLabel FROM model",
    "f8_rows_by_user": """SELECT u."user", ChurnKey, State FROM (VALUES ('ana'),('ben')) AS u("user") JOIN model m
 ON u."user" = 'ana' OR m.State IN ('NATION_1','NATION_7')""",
    "f8_access_summary": f"""SELECT u."user", count(m.ChurnKey) AS customers, count(m.ChurnKey) FILTER (m.{YES})
 AS churned, {per(f'count(m.ChurnKey) FILTER (m.{YES})', 'count(m.ChurnKey)')} AS churn_rate
 FROM (VALUES ('ana'),('ben'),('eve')) AS u("user") LEFT JOIN model m
 ON u."user" = 'ana' OR (u."user" = 'ben' AND m.State IN ('NATION_1','NATION_7')) GROUP BY u."user\"""",
    "f9_minimum_base": select(["geo_customers", "geo_churn_rate"], ["City"]) + " HAVING count(*) >= 10",
}
assert set(CATEGORY.values()) == {"Phone", "Internet", "Add-on", "Streaming"}
