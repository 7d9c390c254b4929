"""Subscriber records bound to order, line item and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition import schemas

INPUT_TABLES = ["orders", "lineitem", "customer", "nation", "region"]

# One order is one subscriber. The line-item side is collapsed to one bit mask per
# order before it is joined, so it shuffles two narrow columns.
_SUBSCRIBER_SQL = """
WITH held AS (
  SELECT l_orderkey, bit_or(shiftleft(1, CAST(l_partkey % 9 AS INT))) AS bits
  FROM {lineitem} GROUP BY l_orderkey
),
place AS (
  SELECT c.c_custkey, n.n_name, r.r_name
  FROM {customer} c
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey
),
base AS (
  SELECT o.o_orderkey AS k, p.c_custkey AS ck, p.n_name AS nname, p.r_name AS rname,
    o.o_orderpriority AS pri, COALESCE(h.bits, 0) AS bits,
    LEAST(72, 24020 - (year(o.o_orderdate) * 12 + month(o.o_orderdate))) AS ten,
    1825 + (CAST(ROUND(o.o_totalprice * 100) AS BIGINT) % 10051) AS cents,
    (o.o_orderkey % 100 * 7919 + 104729) % 100 AS h,
    (o.o_orderkey % 1009 * 104729 + 7919) % 1009 AS h2,
    (o.o_orderkey % 20 * 31 + 7) % 20 AS cb
  FROM {orders} o
  LEFT JOIN held h ON h.l_orderkey = o.o_orderkey
  JOIN place p ON o.o_custkey = p.c_custkey
),
sub AS (
  SELECT *,
    CASE WHEN cb < 11 THEN 'Month-to-month' WHEN cb < 15 THEN 'One year' ELSE 'Two year' END AS con,
    h < CASE WHEN cb < 11 THEN 43 WHEN cb < 15 THEN 11 ELSE 3 END AS gone,
    (bits & 4) <> 0 AS offline
  FROM base
)
SELECT
  'S' || lpad(CAST(k AS STRING), greatest(9, length(CAST(k AS STRING))), '0') AS customer_id,
  '1' AS `count`,
  rname AS country,
  nname AS state,
  nname || '/C' || CAST(ck % 20 AS STRING) AS city,
  lpad(CAST(ck % 100000 AS STRING), 5, '0') AS zip_code,
  CAST(CAST(32 + ck % 10 AS DECIMAL(9,6)) AS STRING) AS latitude,
  CAST(CAST(-124 + ck % 9 AS DECIMAL(9,6)) AS STRING) AS longitude,
  IF(h2 % 7 < 4, 'Male', 'Female') AS gender,
  IF(h2 % 11 < 2, 'Yes', 'No') AS senior_citizen,
  IF(h2 % 29 < 14, 'Yes', 'No') AS partner,
  IF(h2 % 13 < 3, 'Yes', 'No') AS dependents,
  CAST(ten AS STRING) AS tenure_months,
  CASE WHEN (bits & 1) <> 0 THEN 'No' WHEN k % 13 = 0 THEN 'yes ' ELSE 'Yes' END AS phone_service,
  CASE WHEN (bits & 1) <> 0 THEN 'No phone service' WHEN (bits & 2) <> 0 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  CASE WHEN offline THEN 'No' WHEN pri < '3' THEN 'Fiber optic' ELSE 'DSL' END AS internet_service,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 8) <> 0 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 16) <> 0 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 32) <> 0 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 64) <> 0 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 128) <> 0 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN offline THEN 'No internet service' WHEN (bits & 256) <> 0 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  con AS contract,
  IF(h2 % 5 < 3, 'Yes', 'No') AS paperless_billing,
  IF(k % 17 = 0, '  ', '') || CASE h2 % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
    WHEN 2 THEN 'Credit card (automatic)' ELSE 'Bank transfer (automatic)' END AS payment_method,
  IF(k % 997 = 0, 'n/a', CAST(CAST(cents * 0.01 AS DECIMAL(10,2)) AS STRING)) AS monthly_charges,
  IF(ten = 0, '', CAST(CAST(cents * ten * 0.01 AS DECIMAL(10,2)) AS STRING)) AS total_charges,
  IF(gone, 'Yes', 'No') AS churn_label,
  IF(gone, '1', '0') AS churn_value,
  CAST(IF(gone, 60 + h2 % 41, 5 + h2 % 73) AS STRING) AS churn_score,
  CAST(2000 + (h2 * 37) % 4500 AS STRING) AS cltv,
  CASE WHEN NOT gone THEN '' WHEN k % 19 = 0 THEN '   ' ELSE
    element_at(array('Attitude of support person', 'Attitude of support person', 'Competitor offer',
      'Price too high', 'Network reliability', 'Moved', 'Product dissatisfaction', 'Do not know'),
      CAST((h2 % 23) % 8 + 1 AS INT)) END AS churn_reason
FROM sub
"""


def read_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in INPUT_TABLES}
    rows = spark.sql(_SUBSCRIBER_SQL, **inputs)
    rows = rows.withColumn("lat_long", F.concat_ws(", ", "latitude", "longitude"))
    return rows.select(*[F.col(f"`{name}`") for name in schemas.BRONZE_COLUMNS])


def read_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as bulk questions, in order of conversation and turn."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter(F.col("role") == "user")
    return turns.select("conv_id", "turn", F.col("text").alias("question"))
