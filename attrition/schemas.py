"""Column lists, declared widths and value domains of the three layers."""

from __future__ import annotations

# Source columns in order, with the width each text column is declared with
# in the typed layer (None where the typed column is not text).
SUBSCRIBER_COLUMNS: dict[str, int | None] = {
    "customer_id": 10,
    "count": None,
    "country": 50,
    "state": 50,
    "city": 100,
    "zip_code": 10,
    "lat_long": 50,
    "latitude": None,
    "longitude": None,
    "gender": 10,
    "senior_citizen": None,
    "partner": None,
    "dependents": None,
    "tenure_months": None,
    "phone_service": None,
    "multiple_lines": 20,
    "internet_service": 20,
    "online_security": 20,
    "online_backup": 20,
    "device_protection": 20,
    "tech_support": 20,
    "streaming_tv": 20,
    "streaming_movies": 20,
    "contract": 20,
    "paperless_billing": None,
    "payment_method": 30,
    "monthly_charges": None,
    "total_charges": None,
    "churn_label": 5,
    "churn_value": None,
    "churn_score": None,
    "cltv": None,
    "churn_reason": 200,
}
BRONZE_COLUMNS = list(SUBSCRIBER_COLUMNS)
TEXT_WIDTHS = {name: width for name, width in SUBSCRIBER_COLUMNS.items() if width}
FLAG_COLUMNS = ["senior_citizen", "partner", "dependents", "phone_service", "paperless_billing"]

# The service catalogue in key order, with category and the typed-layer column.
SERVICES = [
    (1, "Phone Service", "Phone", "phone_service"),
    (2, "Multiple Lines", "Phone", "multiple_lines"),
    (3, "Internet Service", "Internet", "internet_service"),
    (4, "Online Security", "Add-on", "online_security"),
    (5, "Online Backup", "Add-on", "online_backup"),
    (6, "Device Protection", "Add-on", "device_protection"),
    (7, "Tech Support", "Add-on", "tech_support"),
    (8, "Streaming TV", "Streaming", "streaming_tv"),
    (9, "Streaming Movies", "Streaming", "streaming_movies"),
]
CATEGORIES = ["Phone", "Internet", "Add-on", "Streaming"]

# Domains that reports list even when a value has no rows.
GENDERS = ["Male", "Female"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
PAYMENTS = [
    "Electronic check",
    "Mailed check",
    "Credit card (automatic)",
    "Bank transfer (automatic)",
]
INTERNET_TIERS = ["DSL", "Fiber optic", "No"]
CHURN_STATES = ["Churned", "Active"]

# Bands as (label, first value, last value); None leaves the end open.
TENURE_BANDS = [("0-6", 0, 6), ("7-12", 7, 12), ("13-24", 13, 24), ("25-48", 25, 48), ("49-72", 49, None)]
SCORE_BANDS = [("0-19", 0, 19), ("20-39", 20, 39), ("40-59", 40, 59), ("60-79", 60, 79), ("80-100", 80, None)]
TENURE_BUCKETS = [
    ("0-12", None, 12),
    ("13-24", 13, 24),
    ("25-36", 25, 36),
    ("37-48", 37, 48),
    ("49-60", 49, 60),
    ("60+", 61, None),
]
RISK_BANDS = [("0-39", None, 39), ("40-59", 40, 59), ("60-69", 60, 69), ("70-84", 70, 84), ("85+", 85, None)]

# Feed alias -> typed-layer column, in feed order.
FEED_COLUMNS = {
    "id": "customer_id",
    "gender": "gender",
    "senior": "senior_citizen",
    "partner": "partner",
    "dep": "dependents",
    "tenure": "tenure_months",
    "phone": "phone_service",
    "mlines": "multiple_lines",
    "internet": "internet_service",
    "osec": "online_security",
    "oback": "online_backup",
    "dprot": "device_protection",
    "tech": "tech_support",
    "stv": "streaming_tv",
    "smov": "streaming_movies",
    "contract": "contract",
    "paper": "paperless_billing",
    "pay": "payment_method",
    "monthly": "monthly_charges",
    "total": "total_charges",
    "churn": "churn_label",
    "churnv": "churn_value",
    "score": "churn_score",
    "cltv": "cltv",
    "reason": "churn_reason",
    "city": "city",
    "zip": "zip_code",
    "state": "state",
    "country": "country",
    "lat": "latitude",
    "lng": "longitude",
}

# Gold column -> typed-layer column.
CUSTOMER_ATTRIBUTES = {
    "CustomerID": "customer_id",
    "Gender": "gender",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "Country": "country",
    "State": "state",
    "City": "city",
    "ZipCode": "zip_code",
    "Latitude": "latitude",
    "Longitude": "longitude",
}
CONTRACT_ATTRIBUTES = {
    "ContractType": "contract",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
}
FACT_ATTRIBUTES = {
    "TenureMonths": "tenure_months",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "ChurnScore": "churn_score",
    "CLTV": "cltv",
    "ChurnValue": "churn_value",
    "ChurnLabel": "churn_label",
    "ChurnReason": "churn_reason",
}
