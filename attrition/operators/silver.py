"""Raw text to typed columns: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from attrition import schemas
from attrition.functions import cleansing as clean
from attrition.functions.sql import aggregate

# Integer kinds of the typed layer.
_INTEGERS = {
    "count": "smallint",
    "tenure_months": "tinyint",
    "churn_value": "tinyint",
    "churn_score": "smallint",
    "cltv": "int",
}


def typed(name: str) -> str:
    raw = f"`{name}`"
    if name in schemas.FLAG_COLUMNS:
        return clean.yes_no(raw)
    if name in _INTEGERS:
        return clean.safe_int(raw, _INTEGERS[name])
    if name in ("latitude", "longitude"):
        return clean.safe_decimal(raw, 9, 6)
    if name == "monthly_charges":
        return clean.safe_decimal(raw, 10, 2)
    if name == "total_charges":
        return f"CASE WHEN trim({raw}) <> '' THEN {clean.safe_decimal(raw, 10, 2)} END"
    if name == "churn_reason":
        return clean.blank_to_null(raw)
    return f"trim({raw})"


def build_silver(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    columns = [f"{typed(name)} AS `{name}`" for name in schemas.BRONZE_COLUMNS]
    if stamp:
        columns.append("current_timestamp() AS dwh_create_date")
    return bronze.selectExpr(*columns)


def load_profile(silver: DataFrame) -> DataFrame:
    return aggregate(
        silver,
        [],
        row_count="count(1)",
        churners="count_if(churn_label = 'Yes')",
        new_customers="count_if(total_charges IS NULL)",
        min_monthly="min(monthly_charges)",
        max_monthly="max(monthly_charges)",
    )
