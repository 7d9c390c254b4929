"""Small literal frames with defaults for the columns a test does not care about."""

from decimal import Decimal

from attrition import schemas
from attrition.operators import gold
from attrition.operators.silver import build_silver

BRONZE = dict(
    customer_id="S1", count="1", country="C", state="ST", city="Town", zip_code="00001", lat_long="1, 2",
    latitude="1.000000", longitude="2.000000", gender="Male", senior_citizen="No", partner="No", dependents="No",
    tenure_months="5", phone_service="Yes", multiple_lines="No", internet_service="DSL", online_security="No",
    online_backup="No", device_protection="No", tech_support="No", streaming_tv="No", streaming_movies="No",
    contract="Month-to-month", paperless_billing="Yes", payment_method="Mailed check", monthly_charges="10.00",
    total_charges="50.00", churn_label="No", churn_value="0", churn_score="50", cltv="1000", churn_reason=None,
)

FEED_SCHEMA = """id string, gender string, senior int, partner int, dep int, tenure smallint, phone int, mlines string,
 internet string, osec string, oback string, dprot string, tech string, stv string, smov string, contract string,
 paper int, pay string, monthly decimal(10,2), total decimal(10,2), churn string, churnv smallint, score smallint,
 cltv int, reason string, city string, zip string, state string, country string, lat decimal(9,6), lng decimal(9,6)"""
FEED = dict(
    id="S1", gender="Male", senior=0, partner=0, dep=0, tenure=5, phone=1, mlines="No", internet="DSL", osec="No",
    oback="No", dprot="No", tech="No", stv="No", smov="No", contract="Month-to-month", paper=1, pay="Mailed check",
    monthly=Decimal("10.00"), total=Decimal("50.00"), churn="No", churnv=0, score=50, cltv=1000, reason=None,
    city="Town", zip="00001", state="ST", country="C", lat=Decimal("1"), lng=Decimal("2"),
)


def bronze(spark, rows):
    schema = ", ".join(f"`{name}` string" for name in schemas.BRONZE_COLUMNS)
    return spark.createDataFrame([tuple((BRONZE | row)[c] for c in schemas.BRONZE_COLUMNS) for row in rows], schema)


def silver(spark, rows):
    return build_silver(bronze(spark, rows), stamp=False)


def feed(spark, rows):
    return spark.createDataFrame([tuple((FEED | row)[c] for c in FEED) for row in rows], FEED_SCHEMA)


def star(spark, rows):
    """Typed rows and the star tables over them, as a dictionary. Each layer is kept, as a
    written table would be."""
    typed = silver(spark, rows).cache()
    t = {"silver": typed, "dim_service": gold.build_dim_service(spark)}
    t["dim_customer"] = gold.build_dim_customer(typed).cache()
    t["dim_contract"] = gold.build_dim_contract(typed).cache()
    keyed = gold.key_subscribers(typed, t["dim_customer"]).cache()
    t["fact_customer_service"] = gold.build_fact_customer_service(keyed, t["dim_service"]).cache()
    t["fact_churn"] = gold.build_fact_churn(keyed, t["dim_contract"]).cache()
    t["profile"] = gold.build_customer_profile(t["dim_customer"], t["fact_customer_service"])
    t["model"] = gold.build_model(t["fact_churn"], t["dim_contract"], t["profile"]).cache()
    return t


def model(spark, rows):
    return star(spark, rows)["model"]


def churn(**more):
    return dict(churn="Yes", churnv=1) | more


def gone(**more):
    return dict(churn_label="Yes", churn_value="1") | more


def ids(rows):
    """Numbers the rows, so that each is a customer of its own."""
    return [dict(customer_id=f"S{i}") | row for i, row in enumerate(rows)]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def pairs(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
