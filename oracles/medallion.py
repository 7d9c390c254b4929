"""Oracles for landing, typed layer, star schema, checks and incremental loads."""

from oracles.layers import CONTRACT, CUSTOMER, TEXT, content, integer, one_line  # noqa: F401

# Columns of the feed.
FEED_OUT = """id, gender, CAST(senior AS BIGINT) AS senior, CAST(partner AS BIGINT) AS partner,
 CAST(dep AS BIGINT) AS dep, CAST(tenure AS BIGINT) AS tenure, CAST(phone AS BIGINT) AS phone, mlines, internet, osec,
 oback, dprot, tech, stv, smov, contract, CAST(paper AS BIGINT) AS paper, pay, CAST(monthly AS DOUBLE) AS monthly,
 CAST(total AS DOUBLE) AS total, churn, CAST(churnv AS BIGINT) AS churnv, CAST(score AS BIGINT) AS score,
 CAST(cltv AS BIGINT) AS cltv, reason, city, zip, state, country, CAST(lat AS DOUBLE) AS lat,
 CAST(lng AS DOUBLE) AS lng"""
INTEGERS = ", ".join(
    f"CAST({c} AS BIGINT) AS {c}" for c in ['"count"', "tenure_months", "churn_value", "churn_score", "cltv"]
)
MONEY = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ["latitude", "longitude", "monthly_charges"])
FLAGS = "senior_citizen, partner, dependents, phone_service, paperless_billing"
PROFILE = """count(*) AS row_count, count(*) FILTER (churn_label = 'Yes') AS churners,
 count(*) FILTER (total_charges IS NULL) AS new_customers, CAST(min(monthly_charges) AS DOUBLE) AS min_monthly,
 CAST(max(monthly_charges) AS DOUBLE) AS max_monthly"""
# Declared widths.
SILVER_OUT = f"""customer_id, {', '.join(TEXT)}, churn_reason, {FLAGS}, {INTEGERS}, {MONEY},
 CAST(total_charges AS DOUBLE) AS total_charges"""
RELOADED = """SELECT ChurnKey, CustomerKey, CustomerID, City, ContractType, PaymentMethod,
 CAST(TenureMonths AS BIGINT) AS TenureMonths, CAST(ChurnScore AS BIGINT) AS ChurnScore, ChurnLabel,
 coalesce((SELECT bit_or(1::BIGINT << (b.ServiceKey - 1)) FROM bridge b WHERE b.CustomerKey = model.CustomerKey), 0) AS ServiceMask
 FROM model"""
WIDTHS = {
    "customer_id": 10, "country": 50, "state": 50, "city": 100, "zip_code": 10, "lat_long": 50, "gender": 10,
    "multiple_lines": 20, "internet_service": 20, "online_security": 20, "online_backup": 20,
    "device_protection": 20, "tech_support": 20, "streaming_tv": 20, "streaming_movies": 20, "contract": 20,
    "payment_method": 30, "churn_label": 5, "churn_reason": 200,
}
STAR = ["dim_customer", "dim_contract", "dim_service", "fact_customer_service", "fact_churn"]
LANDING = "SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS distinct_customers FROM bronze"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def counts(names: list[str]) -> str:
    return union([f"SELECT '{name}' AS layer, count(*) AS row_count FROM {name}" for name in names])


def nulls(table: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM {table}"
        for c in columns
    ]


def repeated(table: str, keys: str) -> str:
    return f"""SELECT '{table}' AS "table", count(*) AS repeated_keys,
 CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
 FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY ALL HAVING count(*) > 1)"""


def orphans(child: str, column: str, parent: str) -> str:
    return f"""SELECT '{child}' AS "table", '{column}' AS "column", '{parent}' AS parent, count(*) AS orphans
 FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})"""


_PAIR = content(["o_custkey", "o_orderpriority"])
_LINE = content(["l_returnflag", "l_linestatus"])

NUMBERED = """, numbered AS (SELECT *, CAST(substr(customer_id, 2) AS BIGINT) AS n FROM silver),
after_batch AS (SELECT * EXCLUDE (city, cltv), CASE WHEN n % 7 = 0 THEN 'Moved' ELSE city END AS city,
 CAST(CASE WHEN n % 7 = 0 THEN cltv + 3 ELSE cltv END AS BIGINT) AS cltv,
 CAST(CASE WHEN n % 7 = 0 THEN 3 ELSE 1 END AS BIGINT) AS version FROM numbered)
"""
RAGGED = ", record AS (SELECT *, CAST(substr(customer_id, 2) AS BIGINT) AS n FROM bronze)\n"
# Every thirteenth customer is deleted at version 4.
DELETED = NUMBERED + """, after_deletes AS (SELECT * FROM after_batch WHERE n % 13 <> 0),
changes AS (SELECT customer_id,
 CASE WHEN n % 13 = 0 THEN 'delete' WHEN n % 10 = 0 THEN 'insert' ELSE 'update' END AS change,
 CAST(CASE WHEN n % 10 <> 0 THEN 1 END AS BIGINT) AS version_before,
 CAST(CASE WHEN n % 13 = 0 THEN 4 WHEN n % 7 = 0 THEN 3 ELSE 1 END AS BIGINT) AS version_after FROM numbered
 WHERE CASE WHEN n % 10 = 0 THEN n % 13 <> 0 ELSE n % 13 = 0 OR n % 7 = 0 END)
"""
_SOURCE = """customer_id AS CustomerID, gender AS Gender, senior_citizen AS SeniorCitizen, partner AS Partner,
 dependents AS Dependents, country AS Country, state AS State, city AS City, zip_code AS ZipCode,
 latitude AS Latitude, longitude AS Longitude"""
_CUSTOMER_KEY = content(CUSTOMER)
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in CUSTOMER)



def dimension_after(ctes: str, after: str) -> str:
    """Keys of earlier customers stay, those of deleted ones among them; arriving ones are numbered behind."""
    return (
        ctes
        + f""", earlier AS (SELECT DISTINCT {_SOURCE} FROM numbered WHERE n % 10 <> 0),
arriving AS (SELECT {_SOURCE} FROM {after} WHERE n % 10 = 0),
keys AS (
 SELECT row_number() OVER (ORDER BY substr(md5({_CUSTOMER_KEY}),1,4), {_ORDER}) AS CustomerKey, CustomerID
 FROM earlier
 UNION ALL
 SELECT (SELECT count(*) FROM earlier) + row_number() OVER (ORDER BY substr(md5({_CUSTOMER_KEY}),1,4),
  {_ORDER}), CustomerID FROM arriving)
SELECT k.CustomerKey, k.CustomerID, a.city AS City FROM keys k JOIN {after} a ON a.customer_id = k.CustomerID"""
    )


def facts_after(ctes: str, after: str) -> str:
    return ctes + f"""SELECT customer_id AS CustomerID, city AS City, contract AS ContractType,
 paperless_billing AS PaperlessBilling, payment_method AS PaymentMethod, CAST(tenure_months AS BIGINT) AS TenureMonths,
 cltv AS CLTV, churn_label AS ChurnLabel, true AS key_kept FROM {after}"""


def kpis_after(ctes: str, after: str) -> str:
    return ctes + f"""SELECT CAST(0 AS BIGINT) AS batch, count(*) AS total, count(*) FILTER (churn_label = 'Yes') AS churners,
 CAST(sum(cltv) AS DOUBLE) / count(*) AS avg_cltv FROM numbered WHERE n % 10 <> 0
UNION ALL SELECT b, count(*), count(*) FILTER (churn_label = 'Yes'), CAST(sum(cltv) AS DOUBLE) / count(*)
 FROM {after}, (VALUES (CAST(1 AS BIGINT)), (2)) AS v(b) GROUP BY b"""


TEXTS = {
    # A blank cell of a text file lands as NULL.
    "b1_read_raw": """SELECT * REPLACE (nullif(total_charges, '') AS total_charges,
 nullif(churn_reason, '') AS churn_reason) FROM bronze""",
    "b1_read_raw_cells": """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn,
 ' said "' || role || '", then:' || chr(10) || coalesce(text, '') || ',"" ' AS cell FROM conversations""",
    "b1_ragged_rows": RAGGED + "SELECT customer_id, gender, contract FROM record WHERE n % 50 <> 0 AND n % 70 <> 0",
    "b1_ragged_rejects": RAGGED + """SELECT CASE WHEN n % 50 = 0 THEN concat_ws(',', customer_id, gender, contract, 'extra')
 ELSE customer_id END AS record FROM record WHERE n % 50 = 0 OR n % 70 = 0""",
    "b2_snake_headers": "SELECT * FROM bronze",
    "b3_width_profile": """SELECT "column", CAST(greatest(w, 1) AS BIGINT) AS max_len FROM
 (UNPIVOT (SELECT max(length(COLUMNS(*))) FROM bronze) ON COLUMNS(*) INTO NAME "column" VALUE w)""",
    "b4_stringify": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer",
    "b5_bulk_write": "SELECT * FROM bronze",
    "b6_landing_check": LANDING,
    "x1_feed": f"SELECT {FEED_OUT} FROM feed",
    "x2_feed_flags": """SELECT id, CAST(senior AS BIGINT) AS senior, CAST(partner AS BIGINT) AS partner,
 CAST(dep AS BIGINT) AS dep, CAST(phone AS BIGINT) AS phone, CAST(paper AS BIGINT) AS paper FROM feed""",
    "x3_one_line_text": f"SELECT conv_id, turn, role, {one_line('text')} AS text FROM conversations",
    "x4_feed_sink": f"SELECT {FEED_OUT}, (SELECT count(*) FROM feed) AS written FROM feed",
    "s1_trim": f"SELECT customer_id, {', '.join(TEXT)}, churn_reason FROM silver",
    "s2_flags": f"SELECT customer_id, {FLAGS} FROM silver",
    "s3_integers": f"SELECT customer_id, {INTEGERS} FROM silver",
    "s4_decimals": f"SELECT customer_id, {MONEY} FROM silver",
    "s5_blank_total": "SELECT customer_id, CAST(total_charges AS DOUBLE) AS total_charges FROM silver",
    "s6_blank_reason": "SELECT customer_id, churn_reason FROM silver",
    "s7_audit_stamp": "SELECT count(*) AS stamped FROM silver",
    "s8_silver": f"SELECT {SILVER_OUT} FROM silver",
    "s9_full_reload": f"SELECT {SILVER_OUT} FROM silver",
    "s10_load_if_empty": f"SELECT {SILVER_OUT}, true AS first_wrote, false AS second_wrote FROM silver",
    "s11_load_profile": f"SELECT {PROFILE} FROM silver",
    "s12_missing_ids": "SELECT count(*) FILTER (customer_id IS NULL) AS missing_ids FROM silver",
    "s13_too_wide": union(
        [
            f"SELECT '{c}' AS \"column\", count(*) FILTER (length({c}) > {w}) AS too_wide FROM silver"
            for c, w in WIDTHS.items()
        ]
    ),
    "g1_dense_key": f"""SELECT row_number() OVER (ORDER BY substr(md5({_PAIR}),1,4), o_custkey, o_orderpriority) AS row_key,
 o_custkey, o_orderpriority FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)""",
    "g1_dense_key_copies": f"""SELECT row_number() OVER (ORDER BY
  substr(md5(k || CASE WHEN run = 0 THEN '' ELSE '#' || CAST(run AS VARCHAR) END),1,4),
  l_returnflag, l_linestatus, run) AS row_key,
 l_returnflag, l_linestatus FROM (SELECT l_returnflag, l_linestatus, {_LINE} AS k,
  (row_number() OVER (PARTITION BY l_returnflag, l_linestatus) - 1) // 10000 AS run FROM lineitem)""",
    "g2_dim_customer": """SELECT CustomerKey, CustomerID, Gender, SeniorCitizen, Partner, Dependents, Country, State,
 City, ZipCode, CAST(Latitude AS DOUBLE) AS Latitude, CAST(Longitude AS DOUBLE) AS Longitude FROM dim_customer""",
    "g3_dim_contract": "SELECT * FROM dim_contract",
    "g4_dim_service": """SELECT CAST(ServiceKey AS BIGINT) AS ServiceKey, ServiceName, ServiceCategory,
 count(*) AS subscriptions FROM bridge GROUP BY ALL""",
    "g5_unpivot_services": "SELECT customer_id, ServiceName FROM unpivoted",
    "g6_fact_customer_service": """SELECT CustomerKey, CAST(ServiceKey AS BIGINT) AS ServiceKey
 FROM fact_customer_service""",
    "g7_fact_churn": """SELECT ChurnKey, CustomerKey, ContractKey, CAST(TenureMonths AS BIGINT) AS TenureMonths,
 CAST(MonthlyCharges AS DOUBLE) AS MonthlyCharges, CAST(TotalCharges AS DOUBLE) AS TotalCharges,
 CAST(ChurnScore AS BIGINT) AS ChurnScore, CAST(CLTV AS BIGINT) AS CLTV, CAST(ChurnValue AS BIGINT) AS ChurnValue,
 ChurnLabel, ChurnReason FROM fact_churn""",
    "g8_full_reload": RELOADED,
    "g8_changed_reload": f"""SELECT * REPLACE (CASE WHEN reloaded THEN 100 - ChurnScore ELSE ChurnScore END AS ChurnScore)
 FROM ({RELOADED.replace("SELECT", "SELECT State = 'NATION_1' AS reloaded,", 1)} WHERE State <> 'NATION_2')""",
    "g9_facts_reload": RELOADED,
    "v1_layer_counts": counts(["bronze", "silver", *STAR]),
    "v2_wide_counts": "SELECT " + ", ".join(f"(SELECT count(*) FROM {name}) AS {name}_rows" for name in STAR),
    "v4_churn_sanity": """SELECT count(*) AS total_customers, count(*) FILTER (ChurnLabel = 'Yes')
 AS churned_customers, CAST(CAST(100.0 * count(*) FILTER (ChurnLabel = 'Yes') / nullif(count(*), 0)
 AS DECIMAL(5,1)) AS DOUBLE) AS churn_rate_pct FROM fact_churn""",
    "v5_duplicate_keys": union(
        [
            repeated("dim_customer", "CustomerKey"),
            repeated("dim_contract", "ContractKey"),
            repeated("dim_service", "ServiceKey"),
            repeated("fact_churn", "ChurnKey"),
            repeated("fact_customer_service", "CustomerKey, ServiceKey"),
        ]
    ),
    "v6_orphan_rows": union(
        [
            orphans("fact_churn", "CustomerKey", "dim_customer"),
            orphans("fact_churn", "ContractKey", "dim_contract"),
            orphans("fact_customer_service", "CustomerKey", "dim_customer"),
            orphans("fact_customer_service", "ServiceKey", "dim_service"),
        ]
    ),
    "v7_missing_values": union(
        nulls("dim_customer", ["CustomerKey", "CustomerID"])
        + nulls("dim_contract", ["ContractKey", *CONTRACT])
        + nulls("dim_service", ["ServiceKey", "ServiceName", "ServiceCategory"])
        + nulls("fact_churn", ["ChurnKey", "CustomerKey", "ContractKey"])
        + nulls("fact_customer_service", ["CustomerKey", "ServiceKey"])
    ),
    "v7_contract_gaps": union(
        [
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM silver"
            for c in ["contract", "paperless_billing", "payment_method"]
        ]
    ),
    "v7_load_loss": """SELECT (SELECT count(*) FROM silver s LEFT JOIN dim_customer c ON s.customer_id = c.CustomerID) AS due,
 (SELECT count(*) FROM fact_churn) AS facts, 0::BIGINT AS lost""",
    "v8_reconcile": f""", actual AS ({counts(["bronze", "silver", *STAR])}),
wanted(layer, expected) AS (SELECT 'dim_customer', count(*) FROM customers UNION ALL SELECT 'dim_contract', count(*) FROM contracts
 UNION ALL SELECT 'dim_service', 9 UNION ALL SELECT 'fact_customer_service', count(*) FROM unpivoted
 UNION ALL SELECT 'fact_churn', count(*) FROM bronze)
SELECT layer, CAST(expected AS BIGINT) AS expected, row_count AS actual,
 coalesce(expected = row_count, false) AS matches FROM wanted FULL JOIN actual USING (layer)""",
    "r1_upsert": NUMBERED + "SELECT customer_id, city, cltv, version FROM after_batch",
    "r1_upsert_dimension": dimension_after(NUMBERED, "after_batch"),
    "r1_delete_dimension": dimension_after(DELETED, "after_deletes"),
    "r1_upsert_facts": facts_after(NUMBERED, "after_batch"),
    "r1_delete_facts": facts_after(DELETED, "after_deletes"),
    "r1_delete": DELETED + "SELECT customer_id, city, cltv, version FROM after_deletes",
    "r1_delete_bridge": DELETED + """SELECT u.customer_id AS CustomerID, CAST(s.ServiceKey AS BIGINT) AS ServiceKey
 FROM unpivoted u JOIN dim_service s ON s.ServiceName = u.ServiceName JOIN after_deletes a ON a.customer_id = u.customer_id""",
    "r1_changes": DELETED + "SELECT * FROM changes",
    "r2_stream_delete": DELETED + "SELECT customer_id, city, cltv, version FROM after_deletes",
    "r2_stream_delete_kpis": kpis_after(DELETED, "after_deletes"),
    # The batch that comes again is taken once more: updates of what it has put in.
    "r2_stream_changes": DELETED + """SELECT CAST(0 AS BIGINT) AS batch, customer_id, 'insert' AS change,
 CAST(NULL AS BIGINT) AS version_before, CAST(1 AS BIGINT) AS version_after FROM numbered WHERE n % 10 <> 0
UNION ALL SELECT 1, * FROM changes
UNION ALL SELECT 2, customer_id, 'update', version_after, version_after FROM changes WHERE change <> 'delete'""",
    "r1_upsert_bridge": """SELECT u.customer_id AS CustomerID, CAST(s.ServiceKey AS BIGINT) AS ServiceKey
 FROM unpivoted u JOIN dim_service s ON s.ServiceName = u.ServiceName""",
    "r2_stream_gold": NUMBERED + """SELECT customer_id AS CustomerID, a.city AS City, contract AS ContractType,
 paperless_billing AS PaperlessBilling, payment_method AS PaymentMethod, cltv AS CLTV, churn_label AS ChurnLabel,
 coalesce((SELECT bit_or(1::BIGINT << (s.ServiceKey - 1)) FROM unpivoted u JOIN dim_service s ON s.ServiceName = u.ServiceName
  WHERE u.customer_id = a.customer_id), 0) AS ServiceMask FROM after_batch a""",
    "r2_stream_upsert": NUMBERED + "SELECT customer_id, city, cltv, version FROM after_batch",
    "r2_stream_kpis": kpis_after(NUMBERED, "after_batch"),
}
