"""Expectations over the layers, each as a small result table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions import derive
from attrition.functions.cleansing import utf16_length
from attrition.functions.sql import aggregate, named
from attrition.operators import gold
from attrition.operators.domains import literal_table

# Key columns of each star table.
PRIMARY_KEYS = {
    "dim_customer": ["CustomerKey"],
    "dim_contract": ["ContractKey"],
    "dim_service": ["ServiceKey"],
    "fact_churn": ["ChurnKey"],
    "fact_customer_service": ["CustomerKey", "ServiceKey"],
}
# Child table, column, parent table.
FOREIGN_KEYS = [
    ("fact_churn", "CustomerKey", "dim_customer"),
    ("fact_churn", "ContractKey", "dim_contract"),
    ("fact_customer_service", "CustomerKey", "dim_customer"),
    ("fact_customer_service", "ServiceKey", "dim_service"),
]
# Columns that must be filled.
REQUIRED = {
    "dim_customer": ["CustomerKey", "CustomerID"],
    "dim_contract": ["ContractKey", "ContractType", "PaperlessBilling", "PaymentMethod"],
    "dim_service": ["ServiceKey", "ServiceName", "ServiceCategory"],
    "fact_churn": ["ChurnKey", "CustomerKey", "ContractKey"],
    "fact_customer_service": ["CustomerKey", "ServiceKey"],
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            aggregate(df, [], row_count="count(1)").selectExpr(f"'{name}' AS layer", "row_count")
            for name, df in tables.items()
        ]
    )


def wide_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """The same counts as one row of scalar subqueries."""
    spark = next(iter(tables.values())).sparkSession
    counts = [df.agg(F.count(F.lit(1))).scalar().alias(f"{name}_rows") for name, df in tables.items()]
    return spark.range(1).select(*counts)


def churn_sanity(fact_churn: DataFrame) -> DataFrame:
    total, gone = F.count(F.lit(1)), F.count_if(F.col("ChurnLabel") == "Yes")
    rate = F.try_divide(gone * F.lit(100.0).cast("decimal(4,1)"), total).cast("decimal(5,1)")
    return fact_churn.agg(
        total.alias("total_customers"), gone.alias("churned_customers"), rate.alias("churn_rate_pct")
    )


def key_profile(df: DataFrame, column: str) -> DataFrame:
    """One row about a whole-number column: rows, nulls, lowest and highest value, and how many distinct values there are.

    Distinct values are bits set in bitmaps of 32,768 values each. Keys are numbered in the order
    their rows are stored in, so a task has few bitmaps and they, not the keys, are shuffled.
    """
    place = {"_block": f"bitmap_bucket_number({column})"}
    blocks = aggregate(
        df,
        place,
        n="count(1)",
        filled=f"count({column})",
        low=f"min({column})",
        high=f"max({column})",
        bits=f"bitmap_count(bitmap_construct_agg(bitmap_bit_position({column})))",
    )
    sums = {"rows": "sum(n)", "nulls": "sum(n - filled)", "bits": "sum(bits)"}
    return blocks.agg(*named({name: f"coalesce({text}, 0)" for name, text in sums.items()} | {"low": "min(low)", "high": "max(high)"}))


class Profiles:
    """Profiles of key columns, each worked out when first asked for. ``masks``: the customer profile, if it is stored."""

    def __init__(self, tables: Mapping[str, DataFrame], masks: DataFrame | None = None):
        self.tables, self.masks, self.seen = tables, masks, {}

    def of(self, table: str, column: str) -> Row:
        if (table, column) not in self.seen:
            self.seen[table, column] = key_profile(self.tables[table], column).first()
        return self.seen[table, column]

    def forget(self, table: str) -> None:
        self.seen = {place: found for place, found in self.seen.items() if place[0] != table}

    def unique(self, table: str, columns: list[str]) -> bool:
        """Whether a key is known not to repeat; False says only that it has to be looked at."""
        if len(columns) == 1:
            found = self.of(table, columns[0])
            return found["bits"] == found["rows"]
        if columns != ["CustomerKey", "ServiceKey"]:
            return False
        # A customer's services are one mask, so a pair that repeats is missing from the masks.
        masks = gold.service_bits(self.tables[table]) if self.masks is None else self.masks
        pairs = aggregate(masks, [], pairs="coalesce(sum(bit_count(ServiceMask)), 0)").first()["pairs"]
        return pairs == self.tables[table].count() and (self.masks is None or self.unique("dim_customer", ["CustomerKey"]))

    def dense(self, table: str, column: str) -> int | None:
        """The highest key, if the keys are all whole numbers from 1 to it."""
        found = self.of(table, column)
        whole = found["nulls"] == 0 and found["bits"] and found["low"] == 1 and found["high"] == found["bits"]
        return found["high"] if whole else None


def duplicate_keys(
    tables: dict[str, DataFrame], keys: dict[str, list[str]] = PRIMARY_KEYS, profiles: Profiles | None = None
) -> DataFrame:
    """Keys that occur more than once. Rows are grouped by a key only where bitmaps do not show that it is unique."""
    profiles = profiles or Profiles(tables)
    spark = tables[next(iter(keys))].sparkSession
    clean = [(name, 0, 0) for name, columns in keys.items() if profiles.unique(name, columns)]
    found = [spark.createDataFrame(clean, "table string, repeated_keys bigint, extra_rows bigint")]
    for name, columns in keys.items():
        if (name, 0, 0) in clean:
            continue
        repeated = aggregate(tables[name], columns, n="count(1)").filter("n > 1")
        counted = aggregate(repeated, [], repeated_keys="count(1)", extra_rows="coalesce(sum(n - 1), 0)")
        found.append(counted.selectExpr(f"'{name}' AS table", "repeated_keys", "extra_rows"))
    return _union(found)


def orphan_rows(
    tables: dict[str, DataFrame], keys: list[tuple[str, str, str]] = FOREIGN_KEYS, profiles: Profiles | None = None
) -> DataFrame:
    """Child rows without a parent. Where a parent's keys are 1 to N without a gap, its children only have to be in that range;
    elsewhere children collapse to one row per key before they meet the parent."""
    profiles = profiles or Profiles(tables)
    found = []
    for child, column, parent in keys:
        highest = profiles.dense(parent, column)
        if highest is None:
            rows = aggregate(tables[child], [column], n="count(1)").filter(f"{column} IS NOT NULL")
            lost = aggregate(rows.join(tables[parent], column, "left_anti"), [], orphans="coalesce(sum(n), 0)")
        else:
            lost = aggregate(tables[child], [], orphans=f"count_if({column} NOT BETWEEN 1 AND {highest})")
        found.append(lost.selectExpr(f"'{child}' AS table", f"'{column}' AS column", f"'{parent}' AS parent", "orphans"))
    return _union(found)


def _per_column(df: DataFrame, tests: dict[str, str], label: str) -> DataFrame:
    one = df.agg(*named({name: f"count_if({test})" for name, test in tests.items()}))
    return one.unpivot([], [f"`{name}`" for name in tests], "column", label)


def missing_values(tables: dict[str, DataFrame], required: dict[str, list[str]] = REQUIRED) -> DataFrame:
    """NULLs in required columns, one pass per table."""
    return _union(
        [
            _per_column(tables[name], {c: f"{c} IS NULL" for c in columns}, "nulls").select(
                F.lit(name).alias("table"), "column", "nulls"
            )
            for name, columns in required.items()
        ]
    )


def contract_gaps(silver: DataFrame) -> DataFrame:
    """Rows whose contract columns are not all filled and so would have no dimension row."""
    columns = list(schemas.CONTRACT_ATTRIBUTES.values())
    return _per_column(silver, {c: f"{c} IS NULL" for c in columns}, "nulls")


def expected_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows each star table should have, counted on the layers before it in one pass each."""
    customer = ", ".join(schemas.CUSTOMER_ATTRIBUTES.values())
    contract = ", ".join(schemas.CONTRACT_ATTRIBUTES.values())
    held = " + ".join(f"CAST(coalesce({hit}, false) AS INT)" for hit in derive.subscribed().values())
    counted = {
        "dim_customer": f"count(DISTINCT struct({customer}))",
        "dim_contract": f"count(DISTINCT struct({contract}))",
        "fact_customer_service": f"coalesce(sum({held}), 0)",
    }
    spark = silver.sparkSession
    typed = silver.agg(*named(counted)).unpivot([], list(counted), "layer", "expected")
    landed = bronze.agg(F.count(F.lit(1)).alias("fact_churn")).unpivot([], ["fact_churn"], "layer", "expected")
    catalogue = literal_table(spark, ["layer", "expected"], [("dim_service", len(schemas.SERVICES))])
    return _union([typed, landed, catalogue.selectExpr("layer", "CAST(expected AS BIGINT) AS expected")])


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected next to actual row counts; a table on one side only shows NULL on the other."""
    wanted = expected
    joined = wanted.join(actual, "layer", "full_outer")
    return joined.select(
        "layer",
        F.col("expected").cast("bigint").alias("expected"),
        F.col("row_count").alias("actual"),
        F.coalesce(F.col("expected") == F.col("row_count"), F.lit(False)).alias("matches"),
    )


def missing_ids(silver: DataFrame) -> DataFrame:
    return silver.agg(F.count_if(F.col("customer_id").isNull()).alias("missing_ids"))


def too_wide(silver: DataFrame) -> DataFrame:
    """Values longer than their declared width, per text column, in one pass."""
    tests = {name: f"{utf16_length(name)} > {width}" for name, width in schemas.TEXT_WIDTHS.items()}
    return _per_column(silver, tests, "too_wide")


def require_clean(report: DataFrame, column: str) -> None:
    """Raise when a report shows a violation; reports hold one row per rule, so all of them are shown."""
    bad = report.filter(F.col(column) > 0).collect()
    if bad:
        raise ValueError("expectations failed: " + "; ".join(str(row.asDict()) for row in bad))


def required_columns(layer: str) -> list[str]:
    """Columns of a layer that have to be filled."""
    if layer == "silver":
        return ["customer_id", *schemas.CONTRACT_ATTRIBUTES.values()]
    return REQUIRED.get(layer, [])


def require_filled(layer: str, nulls: dict[str, int]) -> None:
    """Raise if a required column has nulls, by counts taken while the layer was written."""
    bad = [{"table": layer, "column": column, "nulls": n} for column, n in nulls.items() if n]
    if bad:
        raise ValueError("expectations failed: " + "; ".join(map(str, bad)))


def verify(layer: str, tables: Mapping[str, DataFrame], nulls: dict[str, int] | None = None, profiles: Profiles | None = None) -> None:
    """Raise if a written layer breaks a constraint of its table: required values, primary and foreign keys.

    ``nulls`` are those of ``required_columns``, if they were counted while the layer was written.
    """
    profiles = profiles or Profiles(tables)
    if nulls is None:
        columns = required_columns(layer)
        nulls = tables[layer].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict() if columns else {}
    require_filled(layer, nulls)
    if layer in PRIMARY_KEYS:
        require_clean(duplicate_keys(tables, {layer: PRIMARY_KEYS[layer]}, profiles), "repeated_keys")
    children = [key for key in FOREIGN_KEYS if key[0] == layer]
    if children:
        require_clean(orphan_rows(tables, children, profiles), "orphans")


def load_loss(silver: DataFrame, fact_churn: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Facts the typed rows call for, one for each dimension row of their customer, next to those there are."""
    spark = silver.sparkSession
    rows = aggregate(silver, ["customer_id"], n="count(1)")
    held = aggregate(dim_customer, ["CustomerID"], d="count(1)")
    due = rows.join(held, F.col("customer_id") == F.col("CustomerID"), "left").agg(
        F.coalesce(F.sum(F.col("n") * F.coalesce("d", F.lit(1))), F.lit(0)).alias("due")
    )
    facts = fact_churn.agg(F.count(F.lit(1)).alias("facts"))
    counts = spark.range(1).select(due.scalar().alias("due"), facts.scalar().alias("facts"))
    return counts.withColumn("lost", F.col("due") - F.col("facts"))
