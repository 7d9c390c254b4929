"""Oracles for dashboard semantics: derived columns, filters, KPIs, charts, questions."""

from oracles.medallion import union

GONE = "coalesce(churn = 'Yes', false)"
TIER = "CASE WHEN internet IN ('DSL','Fiber optic') THEN internet ELSE 'No' END"
# Band limits and labels.
BAND = """CASE WHEN coalesce(tenure,0) <= 6 THEN '0-6' WHEN tenure <= 12 THEN '7-12' WHEN tenure <= 24 THEN '13-24'
 WHEN tenure <= 48 THEN '25-48' ELSE '49-72' END"""
SCORE = """CASE WHEN coalesce(score,0) < 0 THEN '80-100' WHEN coalesce(score,0) < 20 THEN '0-19'
 WHEN score < 40 THEN '20-39' WHEN score < 60 THEN '40-59' WHEN score < 80 THEN '60-79' ELSE '80-100' END"""
STATE_OF = "CASE WHEN churn = 'Yes' THEN 'Churned' ELSE 'Active' END"
REASON = "coalesce(nullif(reason, ''), 'Unknown')"
CITY = "coalesce(nullif(city, ''), 'Unknown')"
# Service names and what counts as held.
HELD = {
    "Phone Service": "coalesce(phone = 1, false)",
    "Multiple Lines": "coalesce(mlines = 'Yes', false)",
    "Internet Service": "coalesce(internet IN ('DSL','Fiber optic'), false)",
    "Online Security": "coalesce(osec = 'Yes', false)",
    "Online Backup": "coalesce(oback = 'Yes', false)",
    "Device Protection": "coalesce(dprot = 'Yes', false)",
    "Tech Support": "coalesce(tech = 'Yes', false)",
    "Streaming TV": "coalesce(stv = 'Yes', false)",
    "Streaming Movies": "coalesce(smov = 'Yes', false)",
}
CATEGORY = dict(zip(HELD, ["Phone", "Phone", "Internet", *["Add-on"] * 4, "Streaming", "Streaming"]))
# Listed domains.
CONTRACTS = "(VALUES (1,'Month-to-month'),(2,'One year'),(3,'Two year')) AS d(pos, contract)"
TENURES = "(VALUES (1,'0-6'),(2,'7-12'),(3,'13-24'),(4,'25-48'),(5,'49-72')) AS d(pos, band)"
PAYS = """(VALUES (1,'Electronic check'),(2,'Mailed check'),(3,'Credit card (automatic)'),
 (4,'Bank transfer (automatic)')) AS d(pos, pay)"""
ADDONS = " + ".join(f"CAST({HELD[s]} AS INTEGER)" for s, c in CATEGORY.items() if c == "Add-on")


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST(100 * ({part}) AS DOUBLE) / nullif({whole}, 0), 0.0)"


def per(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0.0)"


def over(domain: str, key: str, expression: str, outputs: str) -> str:
    """Aggregate of the matching feed rows for each domain value, empty ones included."""
    return f"""SELECT d.{key}, {outputs} FROM {domain}
 LEFT JOIN (SELECT *, {expression} AS k FROM feed) r ON r.k = d.{key} GROUP BY d.pos, d.{key}"""


N = "count(r.id)"
CH = "count(r.id) FILTER (r.churn = 'Yes')"

SERVICES = union(
    [
        f"""SELECT {position} AS pos, '{name}' AS service, '{CATEGORY[name]}' AS category,
 count(*) FILTER ({test}) AS total, count(*) FILTER ({test} AND {GONE}) AS churned FROM chosen"""
        for position, (name, test) in enumerate(HELD.items())
    ]
)
CHOSEN = ", chosen AS (SELECT * FROM feed)"
FILTERED = f""", chosen AS (SELECT * FROM feed WHERE gender = 'Male' AND contract = 'Month-to-month'
 AND {TIER} = 'DSL' AND {BAND} = '49-72')"""

# The feed after the batch with deletes: every thirteenth customer is gone, every seventh has moved.
AFTER_DELETES = """, after_feed AS (SELECT * REPLACE (CASE WHEN n % 7 = 0 THEN cltv + 3 ELSE cltv END AS cltv,
 CASE WHEN n % 7 = 0 THEN 'Moved' ELSE city END AS city)
 FROM (SELECT *, CAST(substr(id, 2) AS BIGINT) AS n FROM feed) WHERE n % 13 <> 0)"""

OVERVIEW = f"""count(*) AS total, count(*) FILTER ({GONE}) AS churners,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS churn_rate,
 CAST(coalesce(sum(monthly), 0) AS DOUBLE) AS monthly_revenue, {per('sum(monthly)', 'count(*)')} AS avg_monthly,
 {per('sum(cltv)', 'count(*)')} AS avg_cltv, CAST(coalesce(sum(total), 0) AS DOUBLE) AS lifetime_revenue"""

K = {
    "k1_overview": f"SELECT {OVERVIEW} FROM chosen",
    "k2_churn": f""", reasons AS (SELECT {REASON} AS reason, count(*) AS n FROM chosen WHERE {GONE} GROUP BY 1
 ORDER BY n DESC, reason LIMIT 1)
SELECT count(*) FILTER ({GONE}) AS churned, count(*) FILTER (NOT {GONE}) AS active,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS churn_rate, {per('sum(score)', 'count(*)')} AS avg_score,
 count(*) FILTER (NOT {GONE} AND score >= 70) AS high_risk_active,
 CAST(coalesce(sum(monthly) FILTER ({GONE}), 0) AS DOUBLE) AS revenue_at_risk,
 (SELECT reason FROM reasons) AS top_reason, (SELECT n FROM reasons) AS top_reason_count FROM chosen""",
    "k3_services": f""", svc_counts AS ({SERVICES}),
svc_rates AS (SELECT *, {pct('churned', 'total')} AS rate FROM svc_counts),
best AS (SELECT * FROM svc_rates ORDER BY rate, pos DESC LIMIT 1),
worst AS (SELECT * FROM svc_rates ORDER BY rate DESC, pos LIMIT 1),
flags AS (SELECT {ADDONS} AS a, {HELD['Streaming TV']} OR {HELD['Streaming Movies']} AS st FROM chosen)
SELECT (SELECT CAST(sum(total) AS BIGINT) FROM svc_counts) AS subscriptions,
 {per('sum(a)', 'count(*)')} AS avg_addons, (SELECT service FROM best) AS best_service,
 (SELECT rate FROM best) AS best_rate, (SELECT total FROM best) AS best_n,
 (SELECT service FROM worst) AS worst_service, (SELECT rate FROM worst) AS worst_rate,
 (SELECT total FROM worst) AS worst_n, {pct('count(*) FILTER (st)', 'count(*)')} AS streaming_pct,
 count(*) FILTER (st) AS streaming_n, {pct('count(*) FILTER (a > 0)', 'count(*)')} AS suite_pct,
 count(*) FILTER (a > 0) AS suite_n FROM flags""",
    "k4_revenue": f""", ranked AS (SELECT d.contract, coalesce(sum(r.monthly), 0) AS rev, count(r.id) AS n, d.pos
 FROM {CONTRACTS} LEFT JOIN chosen r ON r.contract = d.contract GROUP BY d.pos, d.contract),
top AS (SELECT * FROM ranked ORDER BY rev DESC, pos LIMIT 1)
SELECT CAST(coalesce(sum(monthly), 0) AS DOUBLE) AS monthly_revenue,
 CAST(coalesce(sum(total), 0) AS DOUBLE) AS lifetime_revenue, {per('sum(monthly)', 'count(*)')} AS avg_monthly,
 {per('sum(cltv)', 'count(*)')} AS avg_cltv, (SELECT contract FROM top) AS top_contract,
 CAST((SELECT rev FROM top) AS DOUBLE) AS top_contract_revenue, (SELECT n FROM top) AS top_contract_n,
 coalesce({per('sum(cltv)', 'count(*)')} / nullif({per('sum(monthly)', 'count(*)')}, 0), 0.0) AS cltv_multiple
FROM chosen""",
    "k5_geography": f""", city_rows AS (SELECT {CITY} AS city, count(*) AS n,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS rate FROM chosen GROUP BY 1),
zip_rows AS (SELECT coalesce(zip, '0') AS zip, count(*) AS n,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS rate FROM chosen GROUP BY 1),
top_city AS (SELECT * FROM city_rows ORDER BY n DESC, city LIMIT 1),
top_zip AS (SELECT * FROM zip_rows ORDER BY n DESC, zip LIMIT 1),
hot AS (SELECT * FROM city_rows WHERE n >= 10 ORDER BY rate DESC, n DESC, city LIMIT 1)
SELECT (SELECT count(DISTINCT nullif(state, '')) FROM chosen) AS states,
 (SELECT count(DISTINCT nullif(city, '')) FROM chosen) AS cities, (SELECT count(*) FROM zip_rows) AS zips,
 (SELECT city FROM top_city) AS top_city, (SELECT n FROM top_city) AS top_city_n,
 (SELECT zip FROM top_zip) AS top_zip, (SELECT n FROM top_zip) AS top_zip_n,
 (SELECT rate FROM top_zip) AS top_zip_rate, (SELECT city FROM hot) AS hot_city, (SELECT n FROM hot) AS hot_city_n,
 (SELECT rate FROM hot) AS hot_city_rate""",
}

ZIPS = f"""zips AS (SELECT coalesce(zip, '0') AS zip, coalesce(min(nullif(city, '')), '?') AS city,
 coalesce(min(nullif(state, '')), 'CA') AS state, {per('sum(lat)', 'count(*)')} AS lat,
 {per('sum(lng)', 'count(*)')} AS lng, count(*) AS n, count(*) FILTER ({GONE}) AS churned,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS rate, {per('sum(cltv)', 'count(*)')} AS avg_cltv,
 CAST(coalesce(sum(monthly), 0) AS DOUBLE) AS revenue FROM feed GROUP BY 1),
mapped AS (SELECT *, 6 + 16 * sqrt(CAST(n AS DOUBLE) / (SELECT max(n) FROM zips)) AS radius,
 CAST(CASE WHEN rate >= 80 THEN 4 WHEN rate >= 60 THEN 3 WHEN rate >= 40 THEN 2 WHEN rate >= 20 THEN 1 ELSE 0 END
  AS BIGINT) AS level FROM zips)"""
SHORT = "replace(pay, ' (automatic)', ' · Auto')"
SHORT_D = "replace(d.pay, ' (automatic)', ' · Auto')"

FIELDS = {
    "gender": ("gender", ["Male", "Female"]),
    "contract": ("contract", ["Month-to-month", "One year", "Two year"]),
    "internet": (TIER, ["DSL", "Fiber optic", "No"]),
    "pay": ("pay", ["Electronic check", "Mailed check", "Credit card (automatic)", "Bank transfer (automatic)"]),
    "tenure": (BAND, ["0-6", "7-12", "13-24", "25-48", "49-72"]),
    "churn": (STATE_OF, ["Churned", "Active"]),
}


def where(spec: dict[str, str], without: str | None = None) -> str:
    tests = [f"{FIELDS[f][0]} = '{v}'" for f, v in spec.items() if f != without and v != "All"]
    return " AND ".join(tests) or "true"


def facets(spec: dict[str, str]) -> str:
    """Field by field and value by value, each with its own filter."""
    parts = []
    for field, (expression, values) in FIELDS.items():
        others = where(spec, field)
        for value in values:
            parts.append(
                f"SELECT '{field}' AS field, '{value}' AS value, "
                f"count(*) FILTER ({others} AND {expression} = '{value}') AS \"count\" FROM feed"
            )
    parts.append(f"SELECT 'churn', 'All', count(*) FILTER ({where(spec, 'churn')}) FROM feed")
    return union(parts)


SEGMENTS = {
    "everyone": {},
    "monthly fiber": {"contract": "Month-to-month", "internet": "Fiber optic"},
    "new by check": {"pay": "Electronic check", "tenure": "0-6"},
    "women gone": {"gender": "Female", "churn": "Churned"},
    "long and loyal": {
        "gender": "Male",
        "contract": "Two year",
        "internet": "DSL",
        "pay": "Mailed check",
        "tenure": "49-72",
        "churn": "Active",
    },
    "nobody": {"gender": "Other"},
}

# Intent patterns.
PATTERNS = [
    "(churn rate|churn%|churn percentage|how many.*churn|overall churn)",
    "(reason|why.*leave|why.*churn|top churn)",
    "(contract|plan|month.to.month|two.year|one.year)",
    "(service|fiber|dsl|internet|tech support|add.on|retention)",
    "(average|avg|monthly charge|spend|bill)",
    "(revenue.*risk|at risk|money.*lose|lose.*money|exposure)",
    "(how many|total|customers|count)",
    "(high.risk|risk|score|cltv.*risk|at.risk.*customer)",
]
INTENTS = ["churn_rate", "reason", "contract", "service", "average", "revenue_at_risk", "count", "high_risk"]
ASKED = ", asked AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user')"
_HITS = ", ".join(
    f"CASE WHEN regexp_matches(lower(question), '{p}') THEN '{name}' END" for name, p in zip(INTENTS, PATTERNS)
)
TAGGED = f""", tagged AS (SELECT *, CASE WHEN len(list_filter([{_HITS}], lambda x: x IS NOT NULL)) = 0
 THEN ['fallback'] ELSE list_filter([{_HITS}], lambda x: x IS NOT NULL) END AS intents FROM asked)"""


def money(value: str) -> str:
    return f"'$' || format('{{:,}}', CAST(floor({value} + 0.5) AS BIGINT))"


def whole(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def two(value: str) -> str:
    return f"format('{{:,.2f}}', {value}) || '%'"


# The answer sentences below.
FIGURES = f""", chosen AS (SELECT * FROM feed), svc_counts AS ({SERVICES}),
svc_rates AS (SELECT *, {pct('churned', 'total')} AS rate FROM svc_counts),
con_rates AS (SELECT d.contract, d.pos, {pct("count(r.id) FILTER (r.churn = 'Yes')", 'count(r.id)')} AS rate
 FROM {CONTRACTS} LEFT JOIN feed r ON r.contract = d.contract GROUP BY d.pos, d.contract),
reasons AS (SELECT {REASON} AS reason, count(*) AS n FROM feed WHERE {GONE} GROUP BY 1),
top3 AS (SELECT * FROM reasons ORDER BY n DESC, reason LIMIT 3),
facts AS (SELECT count(*) AS total, count(*) FILTER ({GONE}) AS gone,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS rate, {per('sum(monthly)', 'count(*)')} AS avg_monthly,
 {per('sum(cltv)', 'count(*)')} AS avg_cltv, CAST(coalesce(sum(monthly) FILTER ({GONE}), 0) AS DOUBLE) AS at_risk,
 count(*) FILTER (NOT {GONE} AND score >= 70) AS high_risk FROM feed),
said AS (SELECT
 'Overall churn rate in the current view is **' || {two('rate')} || '** (' || {whole('gone')} || ' of ' ||
  {whole('total')} || ' customers churned).' AS churn_rate,
 'Top churn reason: **' || coalesce((SELECT reason FROM top3 ORDER BY n DESC, reason LIMIT 1), 'n/a') || '** (' ||
  {whole('coalesce((SELECT max(n) FROM top3), 0)')} || ' churners).' ||
  CASE WHEN (SELECT count(*) FROM reasons) > 1 THEN chr(10) || 'Top 3 reasons: ' ||
   (SELECT string_agg(reason || ' (' || {whole('n')} || ')', ' · ' ORDER BY n DESC, reason) FROM top3) || '.'
  ELSE '' END AS reason,
 'Highest-churn contract: **' || (SELECT contract FROM con_rates ORDER BY rate DESC, pos LIMIT 1) || '** at **' ||
  (SELECT {two('max(rate)')} FROM con_rates) || '**; lowest: **' ||
  (SELECT contract FROM con_rates ORDER BY rate, pos DESC LIMIT 1) || '** at **' ||
  (SELECT {two('min(rate)')} FROM con_rates) || '**.' AS contract,
 'Highest-churn service: **' || (SELECT service FROM svc_rates ORDER BY rate DESC, pos LIMIT 1) || '** at **' ||
  (SELECT {two('max(rate)')} FROM svc_rates) || '**; best retention: **' ||
  (SELECT service FROM svc_rates ORDER BY rate, pos DESC LIMIT 1) || '** at **' ||
  (SELECT {two('min(rate)')} FROM svc_rates) || '**.' AS service,
 'Average monthly charge is **' || {money('avg_monthly')} || '** and average CLTV is **' || {money('avg_cltv')} ||
  '**.' AS average,
 'Revenue at risk is **' || {money('at_risk')} || '** per month (churned customers'' recurring charges).'
  AS revenue_at_risk,
 'Current view contains **' || {whole('total')} || '** customers — **' || {whole('gone')} || '** churned, **' ||
  {whole('total - gone')} || '** active.' AS "count",
 '**' || {whole('high_risk')} || '** currently-active customers are high-risk (churn score ≥ 70) and should be ' ||
  'prioritized for retention.' AS high_risk,
 'Analysis of ' || {whole('total')} || ' customers: churn rate **' || {two('rate')} || '**, ' ||
  coalesce('top reason **' || (SELECT reason FROM top3 ORDER BY n DESC, reason LIMIT 1) || '**',
  'no churners in view') || '.' || chr(10) ||
  'Try: "overall churn rate", "top churn reasons", "which contract churns the most", "revenue at risk".' AS fallback
 FROM facts)"""


def answered(keys: str) -> str:
    lines = ", ".join(f"CASE WHEN list_contains(intents, '{i}') THEN s.\"{i}\" END" for i in [*INTENTS, "fallback"])
    return f"SELECT {keys}, array_to_string([{lines}], chr(10)) AS answer FROM tagged, said s"


# Suggested questions.
SUGGESTED = """, asked(id, question) AS (VALUES (CAST(1 AS BIGINT), 'What is the overall churn rate?'),
 (2, 'Top churn reasons'), (3, 'Which contract churns the most?'), (4, 'Which service has the highest churn?'),
 (5, 'What is the average monthly charge?'), (6, 'How much revenue is at risk?'))"""

TEXTS = {
    "d1_internet_tier": f"SELECT id, {TIER} AS tier FROM feed",
    "d2_is_subscribed": "SELECT id, "
    + ", ".join(f"{test} AS {name.lower().replace(' ', '_')}" for name, test in HELD.items())
    + " FROM feed",
    "d3_tenure_band": f"SELECT id, {BAND} AS band FROM feed",
    "d4_score_band": f"SELECT id, {SCORE} AS band FROM feed",
    "d5_tenure_bucket": """SELECT ChurnKey, TenureBucket, CAST(TenureBucketOrder AS BIGINT) AS TenureBucketOrder
 FROM model""",
    "d6_risk_band": "SELECT ChurnKey, ScoreBand, CAST(ScoreBandOrder AS BIGINT) AS ScoreBandOrder FROM model",
    "d7_addon_count": "SELECT c.CustomerKey, a.addon_count FROM dim_customer c LEFT JOIN addons a USING (CustomerKey)",
    "d8_service_category": "SELECT CustomerKey, ServiceName, ServiceCategory FROM bridge",
    "d9_rate_status": """SELECT City, churn_rate, CASE WHEN churn_rate < 0.15 THEN 'green' WHEN churn_rate <= 0.3
 THEN 'amber' ELSE 'red' END AS status, CASE WHEN churn_rate < 0.15 THEN '▼' WHEN churn_rate > 0.15 THEN '▲'
 ELSE '➖' END AS arrow FROM (SELECT City, CAST(count(*) FILTER (ChurnLabel = 'Yes') AS DOUBLE) / count(*)
 AS churn_rate FROM model GROUP BY City)""",
    "d10_score_status": """SELECT ChurnKey, CASE WHEN ChurnScore < 50 THEN 'green' WHEN ChurnScore < 70 THEN 'amber'
 WHEN ChurnScore < 85 THEN 'orange' WHEN ChurnScore >= 85 THEN 'red' END AS status FROM fact_churn""",
    "d11_dot_level": f", {ZIPS} SELECT zip, level FROM mapped",
    "d12_bubble_radius": f", {ZIPS} SELECT zip, n, radius FROM mapped",
    "d13_payment_label": f"SELECT id, {SHORT} AS label FROM feed",
    "f1_cross_filter": f"{FILTERED} SELECT id, churn, CAST(monthly AS DOUBLE) AS monthly FROM chosen",
    "f2_filter_without": f"""SELECT id, contract FROM feed WHERE gender = 'Male' AND {TIER} = 'DSL'
 AND {BAND} = '49-72'""",
    "f3_facets": facets({"gender": "Male", "contract": "Month-to-month", "pay": "Electronic check"}),
    "f3_facets_open": facets({"churn": "Churned", "internet": "No"}),
    "f6_segments": union(
        [
            f"""SELECT '{name}' AS segment, count(*) AS total, count(*) FILTER ({GONE}) AS churners,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS churn_rate,
 CAST(coalesce(sum(monthly), 0) AS DOUBLE) AS monthly_revenue, {per('sum(cltv)', 'count(*)')} AS avg_cltv
 FROM feed WHERE {where(spec)}"""
            for name, spec in SEGMENTS.items()
        ]
    ),
    "f7_drill_through": f"SELECT city, zip, {OVERVIEW} FROM feed GROUP BY city, zip",
    **{name: CHOSEN + "\n" + body for name, body in K.items()},
    "r2_stream_churn_page": AFTER_DELETES + ", chosen AS (SELECT * FROM after_feed)\n" + K["k2_churn"],
    "r2_stream_services_page": AFTER_DELETES + FILTERED.replace("FROM feed", "FROM after_feed") + "\n" + K["k3_services"],
    "r2_stream_facets": AFTER_DELETES
    + facets({"gender": "Male", "contract": "Month-to-month", "pay": "Electronic check"}).replace("FROM feed", "FROM after_feed"),
    **{f"{name}_filtered": FILTERED + "\n" + body for name, body in K.items()},
    "c1_contract": over(CONTRACTS, "contract", "contract", f"{N} AS total, {CH} AS churned, {pct(CH, N)} AS rate"),
    "c2_tenure": over(TENURES, "band", BAND, f"{N} AS total, {CH} AS churned, {pct(CH, N)} AS rate"),
    "c3_payment": over(
        PAYS, "pay", "pay", f"{SHORT_D} AS label, {N} AS total, {CH} AS churned, {pct(CH, N)} AS rate"
    ),
    "c4_monthly_by_tenure": over(TENURES, "band", BAND, f"{per('sum(r.monthly)', N)} AS avg_monthly"),
    "c5_churn_status": f"""SELECT s.status, count(f.id) AS total, {pct('count(f.id)', '(SELECT count(*) FROM feed)')}
 AS share FROM (VALUES ('Active'),('Churned')) AS s(status)
 LEFT JOIN (SELECT *, {STATE_OF} AS status FROM feed) f USING (status) GROUP BY s.status""",
    "c6_internet_mix": f"""SELECT s.internet, count(f.id) AS total,
 {pct('count(f.id)', '(SELECT count(*) FROM feed)')} AS share
 FROM (VALUES ('Fiber optic'),('DSL'),('No')) AS s(internet)
 LEFT JOIN (SELECT id, {TIER} AS internet FROM feed) f USING (internet) GROUP BY s.internet""",
    "c7_top_reasons": f"""SELECT {REASON} AS reason, count(*) AS total FROM feed WHERE {GONE} GROUP BY 1
 ORDER BY total DESC, reason LIMIT 10""",
    "c8_score_histogram": f"""SELECT s.band, count(f.id) AS total
 FROM (VALUES ('0-19'),('20-39'),('40-59'),('60-79'),('80-100')) AS s(band)
 LEFT JOIN (SELECT id, {SCORE} AS band FROM feed WHERE coalesce(score, 0) >= 0) f USING (band) GROUP BY s.band""",
    "c9_service_adoption": f"{CHOSEN}, svc_counts AS ({SERVICES}) SELECT service, total FROM svc_counts",
    "c10_service_churn": f"""{CHOSEN}, svc_counts AS ({SERVICES})
 SELECT service, total, churned, {pct('churned', 'total')} AS rate FROM svc_counts""",
    "c11_category_subscriptions": f"""{CHOSEN}, svc_counts AS ({SERVICES})
 SELECT category, CAST(sum(total) AS BIGINT) AS subscriptions,
 {pct('sum(total)', '(SELECT sum(total) FROM svc_counts)')} AS share FROM svc_counts GROUP BY category""",
    "c12_addons_by_contract": f"""SELECT d.contract, {per('sum(r.a)', 'count(r.id)')} AS avg_addons FROM {CONTRACTS}
 LEFT JOIN (SELECT id, contract, {ADDONS} AS a FROM feed) r ON r.contract = d.contract GROUP BY d.contract""",
    "c13_revenue_by_contract": over(
        CONTRACTS, "contract", "contract", "CAST(coalesce(sum(r.monthly), 0) AS DOUBLE) AS monthly_revenue"
    ),
    "c14_cltv_by_tenure": over(TENURES, "band", BAND, f"{per('sum(r.cltv)', N)} AS avg_cltv"),
    "c15_trajectory": over(
        TENURES,
        "band",
        BAND,
        f"""{per("sum(r.monthly) FILTER (r.churn IS DISTINCT FROM 'Yes')",
                 "count(r.id) FILTER (r.churn IS DISTINCT FROM 'Yes')")} AS active_avg_monthly,
 {per("sum(r.monthly) FILTER (r.churn = 'Yes')", CH)} AS churned_avg_monthly""",
    ),
    "c16_payment_mix": over(
        PAYS,
        "pay",
        "pay",
        f"""{SHORT_D} AS label, {N} AS total, {pct(N, f"(SELECT count(*) FROM feed WHERE pay IN (SELECT d.pay FROM {PAYS}))")}
 AS share""",
    ),
    "c17_zip_map": f", {ZIPS} SELECT * FROM mapped",
    "c18_map_bounds": f""", {ZIPS} SELECT min(lat) AS south, min(lng) AS west, max(lat) AS north, max(lng) AS east
 FROM zips""",
    "c19_top_cities": f"""SELECT {CITY} AS city, count(*) AS total,
 {pct(f'count(*) FILTER ({GONE})', 'count(*)')} AS rate FROM feed GROUP BY 1 ORDER BY total DESC, 1 LIMIT 10""",
    "c20_top_zips": f""", {ZIPS} SELECT zip || ' · ' || city AS label, n AS total, rate FROM zips
 ORDER BY n DESC, zip LIMIT 10""",
    "c21_group_sum": "SELECT state, CAST(sum(monthly) AS DOUBLE) AS total FROM feed GROUP BY state",
    "q1_tag_intents": f"""{ASKED}{TAGGED}, numbered AS (SELECT conv_id, turn, intents, unnest(range(len(intents)))
 AS i FROM tagged) SELECT conv_id, turn, i AS position, intents[i + 1] AS intent FROM numbered""",
    "q2_answer_questions": f"{ASKED}{TAGGED}{FIGURES} {answered('conv_id, turn')}",
    "q3_suggested_questions": f"{SUGGESTED}{TAGGED}{FIGURES} {answered('id, question')}",
}
