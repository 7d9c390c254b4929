"""Star schema: dimensions, facts, and the wide model the measures scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions import derive
from attrition.functions.sql import quote
from attrition.operators.keys import with_key


def renamed(silver: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return silver.selectExpr(*[f"{source} AS {target}" for target, source in mapping.items()])


def build_dim_customer(silver: DataFrame) -> DataFrame:
    return with_key(renamed(silver, schemas.CUSTOMER_ATTRIBUTES), "CustomerKey", once=True)


def build_dim_contract(silver: DataFrame) -> DataFrame:
    rows = renamed(silver, schemas.CONTRACT_ATTRIBUTES).distinct()
    return with_key(rows, "ContractKey", distinct=True, key_type="int")


def build_dim_service(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"({key}, '{name}', '{category}')" for key, name, category, _ in schemas.SERVICES)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(ServiceKey, ServiceName, ServiceCategory)")


def key_subscribers(silver: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Typed rows with their customer key: the one wide shuffle both facts share.

    A customer id that occurs in several dimension rows fans out, as an equi-join
    on the natural key does; a hot id is split by the adaptive skew join.
    """
    keys = dim_customer.select("CustomerKey", F.col("CustomerID").alias("customer_id"))
    return silver.join(keys, "customer_id")


def fact_columns(silver: DataFrame) -> DataFrame:
    """The typed columns that facts and bridge are made of; what describes a customer is in the dimension."""
    services = [column for *_, column in schemas.SERVICES]
    return silver.select("customer_id", *services, *schemas.CONTRACT_ATTRIBUTES.values(), *schemas.FACT_ATTRIBUTES.values())


def unpivot_services(keyed: DataFrame, *keep: str) -> DataFrame:
    """One row per held service, in a single pass over the nine columns."""
    held = ", ".join(f"CASE WHEN {hit} THEN {quote(name)} END" for name, hit in derive.subscribed().items())
    return keyed.selectExpr(*keep, f"explode(array_compact(array({held}))) AS ServiceName")


def build_fact_customer_service(keyed: DataFrame, dim_service: DataFrame) -> DataFrame:
    held = unpivot_services(keyed, "CustomerKey")
    # Nine catalogue rows.
    return held.join(F.broadcast(dim_service), "ServiceName").select("CustomerKey", "ServiceKey")


def fact_rows(keyed: DataFrame, dim_contract: DataFrame) -> DataFrame:
    """Fact content before its own key. The contract side is a stored table, so
    the optimizer broadcasts it on its measured size and shuffles otherwise."""
    contract = dim_contract.selectExpr(
        "ContractKey", *[f"{target} AS {source}" for target, source in schemas.CONTRACT_ATTRIBUTES.items()]
    )
    joined = keyed.join(contract, list(schemas.CONTRACT_ATTRIBUTES.values()))
    return joined.selectExpr(
        "CustomerKey", "ContractKey", *[f"{source} AS {target}" for target, source in schemas.FACT_ATTRIBUTES.items()]
    )


def build_fact_churn(keyed: DataFrame, dim_contract: DataFrame) -> DataFrame:
    return with_key(fact_rows(keyed, dim_contract), "ChurnKey")


def service_bits(bridge: DataFrame) -> DataFrame:
    """Services per customer as one integer; bit ``ServiceKey - 1`` is set when held."""
    return bridge.groupBy("CustomerKey").agg(F.expr("bit_or(shiftleft(1L, ServiceKey - 1)) AS ServiceMask"))


ADDON_MASK = sum(1 << (key - 1) for key, _, category, _ in schemas.SERVICES if category == "Add-on")


def build_customer_profile(dim_customer: DataFrame, bridge: DataFrame) -> DataFrame:
    """Customers with the services they hold: ``ServiceMask`` is 0 and ``addon_count`` NULL for none."""
    profile = dim_customer.join(service_bits(bridge), "CustomerKey", "left")
    return profile.selectExpr(
        *dim_customer.columns,
        "coalesce(ServiceMask, 0L) AS ServiceMask",
        f"nullif(bit_count(ServiceMask & {ADDON_MASK}), 0) AS addon_count",
    )


def build_model(fact_churn: DataFrame, dim_contract: DataFrame, profile: DataFrame) -> DataFrame:
    """Facts with every attribute a report can group or filter by.

    The relationships are walked once here; each measure is then a scan of the
    columns it names plus one aggregation. ``ServiceMask`` carries the bridge, so a
    service filter keeps a customer once, however many services match. The stored
    profile makes this a single shuffled join, which the adaptive skew handling can
    split when one customer holds a large part of the facts.
    """
    return with_derived(fact_churn.join(dim_contract, "ContractKey").join(profile, "CustomerKey"))


def with_derived(fact_churn: DataFrame) -> DataFrame:
    """The fact's own calculated columns."""
    banded = fact_churn.selectExpr(
        "*",
        f"{derive.tenure_bucket('TenureMonths')} AS TenureBucket",
        f"{derive.risk_band('ChurnScore')} AS ScoreBand",
    )
    return banded.selectExpr(
        "*",
        f"CAST({derive.band_order('TenureBucket', schemas.TENURE_BUCKETS)} AS INT) AS TenureBucketOrder",
        f"CAST({derive.band_order('ScoreBand', schemas.RISK_BANDS)} AS INT) AS ScoreBandOrder",
    )


def with_addon_count(dim_customer: DataFrame, bridge: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Customers with the number of premium add-ons they hold; NULL when none."""
    addons = F.broadcast(dim_service.filter(F.col("ServiceCategory") == "Add-on").select("ServiceKey"))
    counts = bridge.join(addons, "ServiceKey").groupBy("CustomerKey").agg(F.expr("count(1) AS addon_count"))
    return dim_customer.join(counts, "CustomerKey", "left")
