"""DuckDB text of the medallion layers, shared as a CTE prefix by every oracle."""

# Column names of the typed layer.
TEXT = [
    "country", "state", "city", "zip_code", "lat_long", "gender", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    "contract", "payment_method", "churn_label",
]

BRONZE = """
svc AS (SELECT l_orderkey,
  MAX(CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE 0 END) s0, MAX(CASE WHEN l_partkey % 9 = 1 THEN 1 ELSE 0 END) s1,
  MAX(CASE WHEN l_partkey % 9 = 2 THEN 1 ELSE 0 END) s2, MAX(CASE WHEN l_partkey % 9 = 3 THEN 1 ELSE 0 END) s3,
  MAX(CASE WHEN l_partkey % 9 = 4 THEN 1 ELSE 0 END) s4, MAX(CASE WHEN l_partkey % 9 = 5 THEN 1 ELSE 0 END) s5,
  MAX(CASE WHEN l_partkey % 9 = 6 THEN 1 ELSE 0 END) s6, MAX(CASE WHEN l_partkey % 9 = 7 THEN 1 ELSE 0 END) s7,
  MAX(CASE WHEN l_partkey % 9 = 8 THEN 1 ELSE 0 END) s8
 FROM lineitem GROUP BY l_orderkey),
base AS (SELECT o.o_orderkey k, c.c_custkey ck, n.n_name nname, r.r_name rname, o.o_orderpriority pri,
  COALESCE(s0,0) s0, COALESCE(s1,0) s1, COALESCE(s2,0) s2, COALESCE(s3,0) s3, COALESCE(s4,0) s4,
  COALESCE(s5,0) s5, COALESCE(s6,0) s6, COALESCE(s7,0) s7, COALESCE(s8,0) s8,
  LEAST(72, 24020 - (CAST(year(o.o_orderdate) AS INT)*12 + CAST(month(o.o_orderdate) AS INT))) ten,
  1825 + (CAST(ROUND(o.o_totalprice*100) AS BIGINT) % 10051) mc,
  (o.o_orderkey*7919 + 104729) % 100 h, (o.o_orderkey*104729 + 7919) % 1009 h2,
  (o.o_orderkey*31 + 7) % 20 cb
 FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
 JOIN region r ON n.n_regionkey=r.r_regionkey LEFT JOIN svc ON svc.l_orderkey=o.o_orderkey),
b2 AS (SELECT *, CASE WHEN cb<11 THEN 'Month-to-month' WHEN cb<15 THEN 'One year' ELSE 'Two year' END con,
  CASE WHEN h < CASE WHEN cb<11 THEN 43 WHEN cb<15 THEN 11 ELSE 3 END THEN 1 ELSE 0 END cv FROM base),
b3 AS (SELECT 'S' || CASE WHEN k < 1000000000 THEN LPAD(CAST(k AS VARCHAR),9,'0') ELSE CAST(k AS VARCHAR) END customer_id, '1' "count", rname country, nname state,
 nname || '/C' || CAST(ck % 20 AS VARCHAR) city, LPAD(CAST(ck % 100000 AS VARCHAR),5,'0') zip_code,
 CAST(CAST(32 + ck % 10 AS DECIMAL(9,6)) AS VARCHAR) latitude,
 CAST(CAST(-124 + ck % 9 AS DECIMAL(9,6)) AS VARCHAR) longitude,
 CASE WHEN h2 % 7<4 THEN 'Male' ELSE 'Female' END gender,
 CASE WHEN h2 % 11<2 THEN 'Yes' ELSE 'No' END senior_citizen,
 CASE WHEN h2 % 29 < 14 THEN 'Yes' ELSE 'No' END partner,
 CASE WHEN h2 % 13 < 3 THEN 'Yes' ELSE 'No' END dependents,
 CAST(ten AS VARCHAR) tenure_months,
 CASE WHEN s0=0 THEN CASE WHEN k % 13=0 THEN 'yes ' ELSE 'Yes' END ELSE 'No' END phone_service,
 CASE WHEN s0=1 THEN 'No phone service' WHEN s1=1 THEN 'Yes' ELSE 'No' END multiple_lines,
 CASE WHEN s2=1 THEN 'No' WHEN pri < '3' THEN 'Fiber optic' ELSE 'DSL' END internet_service,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s3=1 THEN 'Yes' ELSE 'No' END online_security,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s4=1 THEN 'Yes' ELSE 'No' END online_backup,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s5=1 THEN 'Yes' ELSE 'No' END device_protection,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s6=1 THEN 'Yes' ELSE 'No' END tech_support,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s7=1 THEN 'Yes' ELSE 'No' END streaming_tv,
 CASE WHEN s2=1 THEN 'No internet service' WHEN s8=1 THEN 'Yes' ELSE 'No' END streaming_movies,
 con contract, CASE WHEN h2 % 5 < 3 THEN 'Yes' ELSE 'No' END paperless_billing,
 CASE WHEN k % 17=0 THEN '  ' ELSE '' END || CASE h2 % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
  WHEN 2 THEN 'Credit card (automatic)' ELSE 'Bank transfer (automatic)' END payment_method,
 CASE WHEN k % 997=0 THEN 'n/a' ELSE CAST(CAST(mc*0.01 AS DECIMAL(10,2)) AS VARCHAR) END monthly_charges,
 CASE WHEN ten=0 THEN '' ELSE CAST(CAST(mc*ten*0.01 AS DECIMAL(10,2)) AS VARCHAR) END total_charges,
 CASE WHEN cv=1 THEN 'Yes' ELSE 'No' END churn_label, CAST(cv AS VARCHAR) churn_value,
 CAST(CASE WHEN cv=1 THEN 60 + h2 % 41 ELSE 5 + h2 % 73 END AS VARCHAR) churn_score,
 CAST(2000 + (h2*37) % 4500 AS VARCHAR) cltv,
 CASE WHEN cv=0 THEN '' WHEN k % 19=0 THEN '   ' ELSE CASE (h2 % 23) % 8 WHEN 0 THEN 'Attitude of support person'
  WHEN 1 THEN 'Attitude of support person' WHEN 2 THEN 'Competitor offer' WHEN 3 THEN 'Price too high'
  WHEN 4 THEN 'Network reliability' WHEN 5 THEN 'Moved' WHEN 6 THEN 'Product dissatisfaction'
  ELSE 'Do not know' END END churn_reason
FROM b2),
bronze AS (SELECT customer_id, "count", country, state, city, zip_code, latitude || ', ' || longitude AS lat_long,
 latitude, longitude, gender, senior_citizen, partner, dependents, tenure_months, phone_service, multiple_lines,
 internet_service, online_security, online_backup, device_protection, tech_support, streaming_tv, streaming_movies,
 contract, paperless_billing, payment_method, monthly_charges, total_charges, churn_label, churn_value, churn_score,
 cltv, churn_reason FROM b3)"""


def flag(name: str) -> str:
    return f"CASE lower(rtrim({name},' ')) WHEN 'yes' THEN true WHEN 'no' THEN false END AS {name}"


def integer(name: str, kind: str, guard: str = "true") -> str:
    value = f"TRY_CAST(trim({name}) AS {kind})"
    return f"""CASE WHEN regexp_full_match(trim({name}), '[+-]?[0-9]+') AND {value} IS NOT NULL
 AND ({guard.format(value)}) THEN {value} END AS {name}"""


def number(name: str, precision: str) -> str:
    plain = rf"regexp_full_match({name}, '\s*[+-]?\d*\.?\d*\s*')"
    return f"CASE WHEN {plain} THEN TRY_CAST(trim({name}) AS DECIMAL({precision})) END AS {name}"


BYTE = "{} BETWEEN 0 AND 255"

SILVER = f"""
silver AS (SELECT trim(customer_id,' ') AS customer_id, {integer('"count"', 'SMALLINT')},
 {', '.join(f"trim({c},' ') AS {c}" for c in TEXT)},
 {', '.join(flag(c) for c in ['senior_citizen', 'partner', 'dependents', 'phone_service', 'paperless_billing'])},
 {number('latitude', '9,6')}, {number('longitude', '9,6')}, {number('monthly_charges', '10,2')},
 CASE WHEN trim(total_charges,' ') = '' THEN NULL ELSE TRY_CAST(trim(total_charges) AS DECIMAL(10,2)) END
  AS total_charges,
 {integer('tenure_months', 'SMALLINT', BYTE)}, {integer('churn_value', 'SMALLINT', BYTE)},
 {integer('churn_score', 'SMALLINT')}, {integer('cltv', 'INTEGER')},
 nullif(trim(churn_reason,' '), '') AS churn_reason
 FROM bronze)"""


def one_line(name: str) -> str:
    return f"replace(replace(replace({name}, chr(13), ''), chr(10), ' '), chr(9), ' ')"


def bit(name: str) -> str:
    return f"coalesce(CAST({name} AS INTEGER), 0)"


FEED = f"""
feed AS (SELECT customer_id AS id, {one_line('gender')} AS gender, {bit('senior_citizen')} AS senior,
 {bit('partner')} AS partner, {bit('dependents')} AS dep, tenure_months AS tenure, {bit('phone_service')} AS phone,
 {one_line('multiple_lines')} AS mlines, {one_line('internet_service')} AS internet,
 {one_line('online_security')} AS osec, {one_line('online_backup')} AS oback,
 {one_line('device_protection')} AS dprot, {one_line('tech_support')} AS tech,
 {one_line('streaming_tv')} AS stv, {one_line('streaming_movies')} AS smov, {one_line('contract')} AS contract,
 {bit('paperless_billing')} AS paper, {one_line('payment_method')} AS pay, monthly_charges AS monthly,
 total_charges AS total, {one_line('churn_label')} AS churn, churn_value AS churnv, churn_score AS score, cltv,
 {one_line('churn_reason')} AS reason, {one_line('city')} AS city, {one_line('zip_code')} AS zip,
 {one_line('state')} AS state, {one_line('country')} AS country, latitude AS lat, longitude AS lng FROM silver)"""


def content(columns: list[str]) -> str:
    """Same content key as the engine: length and text of each column, a dash for NULL."""
    parts = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    return " || ".join(parts)


# Columns of the star tables.
CUSTOMER = ["CustomerID", "Gender", "SeniorCitizen", "Partner", "Dependents", "Country", "State", "City", "ZipCode",
            "Latitude", "Longitude"]
CONTRACT = ["ContractType", "PaperlessBilling", "PaymentMethod"]
FACT = ["CustomerKey", "ContractKey", "TenureMonths", "MonthlyCharges", "TotalCharges", "ChurnScore", "CLTV",
        "ChurnValue", "ChurnLabel", "ChurnReason"]


def keyed(name: str, source: str, columns: list[str]) -> str:
    k = content(columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"row_number() OVER (ORDER BY substr(md5({k}),1,4), {order}) AS {name}, {', '.join(columns)} FROM {source}"


GOLD = f"""
dim_service(ServiceKey, ServiceName, ServiceCategory) AS (VALUES (1,'Phone Service','Phone'),
 (2,'Multiple Lines','Phone'), (3,'Internet Service','Internet'), (4,'Online Security','Add-on'),
 (5,'Online Backup','Add-on'), (6,'Device Protection','Add-on'), (7,'Tech Support','Add-on'),
 (8,'Streaming TV','Streaming'), (9,'Streaming Movies','Streaming')),
customers AS (SELECT DISTINCT customer_id AS CustomerID, gender AS Gender, senior_citizen AS SeniorCitizen,
 partner AS Partner, dependents AS Dependents, country AS Country, state AS State, city AS City,
 zip_code AS ZipCode, latitude AS Latitude, longitude AS Longitude FROM silver),
dim_customer AS (SELECT {keyed('CustomerKey', 'customers', CUSTOMER)}),
contracts AS (SELECT DISTINCT contract AS ContractType, paperless_billing AS PaperlessBilling,
 payment_method AS PaymentMethod FROM silver),
dim_contract AS (SELECT {keyed('ContractKey', 'contracts', CONTRACT)}),
unpivoted AS (
 SELECT customer_id, 'Phone Service' AS ServiceName FROM silver WHERE phone_service
 UNION ALL SELECT customer_id, 'Multiple Lines' FROM silver WHERE multiple_lines = 'Yes'
 UNION ALL SELECT customer_id, 'Internet Service' FROM silver WHERE internet_service IN ('DSL','Fiber optic')
 UNION ALL SELECT customer_id, 'Online Security' FROM silver WHERE online_security = 'Yes'
 UNION ALL SELECT customer_id, 'Online Backup' FROM silver WHERE online_backup = 'Yes'
 UNION ALL SELECT customer_id, 'Device Protection' FROM silver WHERE device_protection = 'Yes'
 UNION ALL SELECT customer_id, 'Tech Support' FROM silver WHERE tech_support = 'Yes'
 UNION ALL SELECT customer_id, 'Streaming TV' FROM silver WHERE streaming_tv = 'Yes'
 UNION ALL SELECT customer_id, 'Streaming Movies' FROM silver WHERE streaming_movies = 'Yes'),
fact_customer_service AS (SELECT c.CustomerKey, s.ServiceKey FROM unpivoted u
 JOIN dim_customer c ON u.customer_id = c.CustomerID JOIN dim_service s ON u.ServiceName = s.ServiceName),
fact_rows AS (SELECT c.CustomerKey, ct.ContractKey, s.tenure_months AS TenureMonths,
 s.monthly_charges AS MonthlyCharges, s.total_charges AS TotalCharges, s.churn_score AS ChurnScore, s.cltv AS CLTV,
 s.churn_value AS ChurnValue, s.churn_label AS ChurnLabel, s.churn_reason AS ChurnReason
 FROM silver s JOIN dim_customer c ON s.customer_id = c.CustomerID
 JOIN dim_contract ct ON s.contract = ct.ContractType AND s.paperless_billing = ct.PaperlessBilling
  AND s.payment_method = ct.PaymentMethod),
fact_churn AS (SELECT {keyed('ChurnKey', 'fact_rows', FACT)}),
bridge AS (SELECT b.CustomerKey, d.ServiceKey, d.ServiceName, d.ServiceCategory FROM fact_customer_service b
 JOIN dim_service d USING (ServiceKey)),
addons AS (SELECT CustomerKey, count(*) AS addon_count FROM bridge WHERE ServiceCategory = 'Add-on' GROUP BY ALL),
model AS (SELECT f.*, c.* EXCLUDE (CustomerKey), t.* EXCLUDE (ContractKey), a.addon_count,
 CASE WHEN f.TenureMonths <= 12 THEN '0-12' WHEN f.TenureMonths <= 24 THEN '13-24' WHEN f.TenureMonths <= 36 THEN
  '25-36' WHEN f.TenureMonths <= 48 THEN '37-48' WHEN f.TenureMonths <= 60 THEN '49-60'
  WHEN f.TenureMonths > 60 THEN '60+' END AS TenureBucket,
 CASE WHEN f.TenureMonths <= 12 THEN 1 WHEN f.TenureMonths <= 24 THEN 2 WHEN f.TenureMonths <= 36 THEN 3
  WHEN f.TenureMonths <= 48 THEN 4 WHEN f.TenureMonths <= 60 THEN 5 WHEN f.TenureMonths > 60 THEN 6 END
  AS TenureBucketOrder,
 CASE WHEN f.ChurnScore < 40 THEN '0-39' WHEN f.ChurnScore < 60 THEN '40-59' WHEN f.ChurnScore < 70 THEN '60-69'
  WHEN f.ChurnScore < 85 THEN '70-84' WHEN f.ChurnScore >= 85 THEN '85+' END AS ScoreBand,
 CASE WHEN f.ChurnScore < 40 THEN 1 WHEN f.ChurnScore < 60 THEN 2 WHEN f.ChurnScore < 70 THEN 3
  WHEN f.ChurnScore < 85 THEN 4 WHEN f.ChurnScore >= 85 THEN 5 END AS ScoreBandOrder
 FROM fact_churn f JOIN dim_customer c USING (CustomerKey) JOIN dim_contract t USING (ContractKey)
 LEFT JOIN addons a USING (CustomerKey))"""

ALL_LAYERS = "WITH " + ",".join([BRONZE, SILVER, FEED, GOLD])
