"""Cross-filters, facets, saved segments, thresholds and row-level access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions import derive
from attrition.functions.sql import aggregate, named, percent, quote, ratio
from attrition.operators.domains import literal_table

ALL = "All"

# Filter field -> the values a report lists for it.
DOMAINS = {
    "gender": schemas.GENDERS,
    "contract": schemas.CONTRACTS,
    "internet": schemas.INTERNET_TIERS,
    "pay": schemas.PAYMENTS,
    "tenure": [label for label, _, _ in schemas.TENURE_BANDS],
    "churn": schemas.CHURN_STATES,
}


# Filter field -> its value on a feed row.
FIELD_VALUES = {
    "gender": "gender",
    "contract": "contract",
    "internet": derive.internet_tier("internet"),
    "pay": "pay",
    "tenure": derive.tenure_band("tenure"),
    "churn": "CASE WHEN churn = 'Yes' THEN 'Churned' ELSE 'Active' END",
}


def _test(field: str, value: str) -> str:
    """Plain comparisons where the field allows it, so that the scan can use them."""
    if field == "internet" and value in ("DSL", "Fiber optic"):
        return f"internet = {quote(value)}"
    if field == "churn" and value == "Churned":
        return "churn = 'Yes'"
    if field == "tenure":
        for label, low, high in schemas.TENURE_BANDS[1:-1]:
            if label == value:
                return f"tenure BETWEEN {low} AND {high}"
    return f"{FIELD_VALUES[field]} = {quote(value)}"


def apply_filters(rows: DataFrame, spec: dict[str, str], without: str | None = None) -> DataFrame:
    """Rows that pass every filter; ``All`` and the field named by ``without`` do not constrain."""
    for field, value in spec.items():
        if field not in DOMAINS:
            raise ValueError(f"unknown filter field {field!r}")
        if value != ALL and field != without:
            rows = rows.filter(_test(field, value))
    return rows


def facet_counts(rows: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Count per field and value under all *other* filters, in one scan.

    Rows collapse to one row per combination of the fields first, a few hundred on
    clean data. A combination counts for a field when no other field fails, that is,
    when its failures are at most its own.
    """
    return facets_from(aggregate(rows, FIELD_VALUES, n="count(1)"), spec)


def facets_from(cells: DataFrame, spec: dict[str, str]) -> DataFrame:
    """The counts from rows of all six fields and a number ``n``."""
    fails = {}
    for field in DOMAINS:
        wanted = spec.get(field, ALL)
        fails[field] = "0" if wanted == ALL else f"CASE WHEN {field} = {quote(wanted)} THEN 0 ELSE 1 END"
    total = " + ".join(fails.values())
    pairs = []
    for field in DOMAINS:
        counts = f"({total}) - ({fails[field]}) = 0"
        pairs.append(f"CASE WHEN {counts} THEN struct('{field}' AS field, {field} AS value) END")
        if field == "churn":
            pairs.append(f"CASE WHEN {counts} THEN struct('{field}' AS field, '{ALL}' AS value) END")
    matched = cells.selectExpr("n", f"inline(array_compact(array({', '.join(pairs)})))")
    counted = aggregate(matched, ["field", "value"], n="sum(n)")
    listed_values = [(field, value) for field, values in DOMAINS.items() for value in values] + [("churn", ALL)]
    domain = literal_table(cells.sparkSession, ["field", "value"], listed_values)
    return domain.join(counted, ["field", "value"], "left").selectExpr("field", "value", "coalesce(n, 0) AS count")


def segment_kpis(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Overview numbers of many saved filter sets in one job.

    ``segments`` has a ``segment`` name and one column per field, ``All`` for no
    constraint. The field combinations are rolled up over every subset of fields, so
    that a segment with wildcards is an equality lookup, not a range of comparisons.
    """
    fields = list(DOMAINS)
    sums = {
        "total": "count(1)",
        "churners": "count_if(churn = 'Yes')",
        "monthly_revenue": "sum(monthly)",
        "cltv": "sum(cltv)",
    }
    cells = aggregate(rows, FIELD_VALUES, **sums)
    cube = cells.cube(*fields).agg(*named({n: f"sum({n})" for n in sums} | {"_open": "grouping_id()"}))
    patterns = cube.selectExpr(
        *[
            f"CASE WHEN _open & {1 << (len(fields) - 1 - position)} <> 0 THEN '{ALL}' ELSE {field} END AS {field}"
            for position, field in enumerate(fields)
        ],
        *sums,
    )
    found = segments.join(patterns, fields, "left").selectExpr(
        "segment", *[f"coalesce({n}, 0) AS {n}" for n in sums]
    )
    return found.selectExpr(
        "segment",
        "total",
        "churners",
        f"{percent('churners', 'total')} AS churn_rate",
        "monthly_revenue",
        f"{ratio('cltv', 'total')} AS avg_cltv",
    )


def threshold_sweep(model: DataFrame) -> DataFrame:
    """High-risk active customers and their monthly revenue at every threshold 0..100.

    The fact collapses to one row per score, and the running sum sees 101 rows.
    """
    active = model.filter("ChurnLabel = 'No' AND ChurnScore >= 0")
    counted = aggregate(
        active, {"threshold": "least(CAST(ChurnScore AS INT), 100)"}, n="count(1)", revenue="sum(MonthlyCharges)"
    )
    scale = model.sparkSession.range(101).selectExpr("CAST(id AS INT) AS threshold")
    filled = scale.join(F.broadcast(counted), "threshold", "left")
    above = "(ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return filled.selectExpr(
        "threshold",
        f"sum(coalesce(n, 0)) OVER {above} AS high_risk_active",
        f"sum(coalesce(revenue, 0)) OVER {above} AS exposure",
    )


# Partition column of the stored model: the state after "=", so that a blank state is a value like others.
PARTITION = "StatePart"


def rows_by_user(rows: DataFrame, entitlements: DataFrame, state: str = "State") -> DataFrame:
    """Row-level access of all users in one job: each with the rows it may see. ``Executive`` sees all, ``Regional`` the listed states.

    Grants are joined, never fetched. A stored model is partitioned by PARTITION, and the join prunes
    its folders to those that some of the users may see.
    """
    place = PARTITION if PARTITION in rows.columns else state
    named = F.concat(F.lit("="), "state") if place == PARTITION else F.col("state")
    regional = entitlements.filter("role = 'Regional' AND state IS NOT NULL").select("user", named.alias("_place"))
    # As many places as there are folders; rows without one are seen by executives only.
    everywhere, all_seeing = rows.agg(F.collect_set(place)).scalar(), entitlements.filter("role = 'Executive'")
    executive = all_seeing.select("user", F.explode(everywhere).alias("_place"))
    allowed = regional.union(executive).distinct()
    placed = rows.join(allowed, rows[place] == allowed["_place"]).drop("_place")
    users = F.explode(all_seeing.agg(F.collect_set("user")).scalar())
    return placed.unionByName(rows.filter(F.col(place).isNull()).withColumn("user", users))


def visible_rows(rows: DataFrame, entitlements: DataFrame, user: str, state: str = "State") -> DataFrame:
    """The rows one user may see."""
    return rows_by_user(rows, entitlements.filter(F.col("user") == user), state).select(rows.columns)


def access_summary(model: DataFrame, entitlements: DataFrame) -> DataFrame:
    """What each user sees, from one aggregation per state: counts add up over states."""
    states = aggregate(
        model, {"state": "coalesce(State, '')"}, n="count(1)", gone="count_if(ChurnLabel = 'Yes')"
    )
    everyone = aggregate(entitlements, ["user"], _all="max(role = 'Executive')")
    listed_states = entitlements.filter("role = 'Regional'").select("user", "state").distinct()
    regional = aggregate(listed_states.join(states, "state"), ["user"], n="sum(n)", gone="sum(gone)")
    whole = states.agg(F.expr("struct(sum(n) AS n, sum(gone) AS gone)")).scalar()
    seen = everyone.join(regional, "user", "left").withColumn("_whole", F.when(F.col("_all"), whole))
    counted = seen.selectExpr(
        "user", "coalesce(_whole.n, n, 0) AS customers", "coalesce(_whole.gone, gone, 0) AS churned"
    )
    return counted.selectExpr("*", f"{ratio('churned', 'customers')} AS churn_rate")


def minimum_base(grouped: DataFrame, size: str, base: int) -> DataFrame:
    return grouped.filter(f"{size} >= {base}")


# Semantic-model filter fields that are plain columns of the model.
MODEL_FIELDS = [
    "Gender",
    "ContractType",
    "PaymentMethod",
    "PaperlessBilling",
    "TenureBucket",
    "ScoreBand",
    "ChurnLabel",
    "ChurnReason",
    "State",
    "City",
    "ZipCode",
]


def service_mask(names: list[str] | None = None, categories: list[str] | None = None) -> int:
    """Bits of the services that pass both lists; ``None`` lets every service pass."""
    mask = 0
    for key, name, category, _ in schemas.SERVICES:
        if (names is None or name in names) and (categories is None or category in categories):
            mask |= 1 << (key - 1)
    return mask


def plain_spec(spec: dict | None) -> dict[str, list]:
    """Filters as lists of values; ``All`` and None, alone or as a list, filter nothing. An empty list lets nothing pass."""
    listed = {field: value if isinstance(value, list) else [value] for field, value in (spec or {}).items()}
    return {field: values for field, values in listed.items() if ALL not in values and values != [None]}


def filter_model(model: DataFrame, spec: dict, without: tuple[str, ...] = ()) -> DataFrame:
    """Slicers of the semantic model; a value may be one or a list. Service fields keep a
    customer who holds any matching service, once."""
    services = {}
    for field, values in plain_spec(spec).items():
        if field in without:
            continue
        if field in ("ServiceName", "ServiceCategory"):
            services[field] = values
        elif field in MODEL_FIELDS:
            model = model.filter(F.col(field).isin(values))
        else:
            raise ValueError(f"unknown filter field {field!r}")
    if services:
        mask = service_mask(services.get("ServiceName"), services.get("ServiceCategory"))
        model = model.filter(f"ServiceMask & {mask} <> 0")
    return model


def through_bridge(fact: DataFrame, bridge: DataFrame, dim_service: DataFrame, condition: Column) -> DataFrame:
    """The same service filter on the star itself: a semi join, so no customer is multiplied."""
    matching = F.broadcast(dim_service.filter(condition).select("ServiceKey"))
    holders = bridge.join(matching, "ServiceKey", "left_semi").select("CustomerKey")
    return fact.join(holders, "CustomerKey", "left_semi")
