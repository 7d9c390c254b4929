"""Upserts and deletes: the latest version of a customer wins, surrogate keys stay.

Changes may have a column ``operation``: ``delete`` takes the customer out, all else,
NULL included, puts the row in its place. Inputs are read once; what is as small as
a batch and used more than once is written on the way, so that a join may broadcast it
by its measured size and a stored table is never shuffled for a small batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition import schemas
from attrition.operators import gold
from attrition.operators.keys import with_key
from attrition.session import kept

OPERATION, DELETE = "operation", "delete"


def deleted(changes: DataFrame) -> Column:
    """Whether a change takes its customer out."""
    if OPERATION not in changes.columns:
        return F.lit(False)
    return F.coalesce(F.lower(F.trim(OPERATION)) == DELETE, F.lit(False))


def live(changes: DataFrame) -> DataFrame:
    """The rows that changes put in, without ``operation``."""
    return changes.filter(~deleted(changes)).drop(OPERATION)


def latest_versions(changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """One row per key, the highest sequence; equal sequences are settled by content, and a delete comes after all of them.

    A single aggregate. Rows are dealt by key before it, so they are sorted once and in tasks of a bounded size: a
    sort in the scan, as a partial aggregate of whole rows needs, is as large as the files are.
    """
    rest = [c for c in changes.columns if c not in (key, sequence)]
    ranked = changes.select(key, F.struct(sequence, deleted(changes).alias("_gone"), *rest).alias("_row")).repartition(key)
    return ranked.groupBy(key).agg(F.max("_row").alias("_row")).select(key, "_row.*").select(*changes.columns)


def apply_latest(current: DataFrame, latest: DataFrame, key: str, sequence: str) -> DataFrame:
    """``current`` with one change per key applied. A change older than what is stored is
    ignored, so a batch that arrives twice or late does no harm. Columns that changes do
    not have stay as they are, and are NULL in new rows. A deleted row goes, and with it
    its version: who has to refuse changes from before a delete keeps tombstones, as the stream does.

    Every join has the changes on the side that may be broadcast: while they are
    small, ``current`` is scanned twice (once for its keys only) and never shuffled.
    ``latest`` is read three times, so it should be a written table.
    """
    given = [name for name in current.columns if name in latest.columns]
    offered = latest.select(key, F.struct(*given).alias("_new"), deleted(latest).alias("_gone"))
    take = F.col("_new").isNotNull() & F.coalesce(F.col(f"_new.{sequence}") >= F.col(sequence), F.lit(True))
    joined = current.join(offered, key, "left").withColumn("_take", take).filter("NOT (_take AND _gone)")
    updated = joined.select(
        *[F.when(F.col("_take"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in current.columns]
    )
    seen = current.select(key).join(latest.select(key), key, "left_semi")
    new = live(latest).join(seen, key, "left_anti")
    kinds = {field.name: field.dataType for field in current.schema}
    arriving = new.select(*[F.col(c) if c in given else F.lit(None).cast(kinds[c]).alias(c) for c in current.columns])
    return updated.unionByName(arriving)


def upsert(current: DataFrame, changes: DataFrame, key: str = "customer_id", sequence: str = "version") -> DataFrame:
    return apply_latest(current, kept(latest_versions(changes, key, sequence), "latest"), key, sequence)


def change_feed(current: DataFrame, latest: DataFrame, key: str, sequence: str) -> DataFrame:
    """What one change per key does to ``current``: the key, ``insert``, ``update`` or ``delete``, and the versions before and after.

    Changes that do nothing have no row: those from before what is stored, and deletes of customers there are none of.
    """
    before = current.select(key, F.col(sequence).alias("version_before"), F.lit(True).alias("_there"))
    asked = latest.select(key, F.col(sequence).alias("version_after"), deleted(latest).alias("_gone"))
    joined = asked.join(before.join(latest.select(key), key, "left_semi"), key, "left")
    done = joined.filter("CASE WHEN _there THEN coalesce(version_after >= version_before, true) ELSE NOT _gone END")
    what = F.expr("CASE WHEN _gone THEN 'delete' WHEN _there THEN 'update' ELSE 'insert' END")
    return done.select(key, what.alias("change"), "version_before", "version_after")


def upsert_dim_customer(dim_customer: DataFrame, changed: DataFrame, highest: Column | int | None = None) -> DataFrame:
    """Dimension after a batch of one row per customer id: known customers keep their key and
    take the new attributes, deleted ones go, new ones are numbered after ``highest``.

    ``highest`` is the highest key ever given; without it the highest there is, which is the same as long as
    the last customers were not deleted. ``changed`` should be a written table.
    """
    names = list(schemas.CUSTOMER_ATTRIBUTES)
    attributes = F.struct(*[F.col(s).alias(t) for t, s in schemas.CUSTOMER_ATTRIBUTES.items()])
    id_column = schemas.CUSTOMER_ATTRIBUTES["CustomerID"]
    offered = changed.select(F.col(id_column).alias("CustomerID"), attributes.alias("_new"), deleted(changed).alias("_gone"))
    joined = dim_customer.join(offered, "CustomerID", "left").filter("NOT coalesce(_gone, false)")
    taken = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names]
    updated = joined.select("CustomerKey", *taken)
    known = dim_customer.select("CustomerID").join(offered.select("CustomerID"), "CustomerID", "left_semi")
    arriving = offered.filter("NOT _gone").join(known, "CustomerID", "left_anti").select("_new.*")
    if highest is None:
        highest = dim_customer.agg(F.coalesce(F.max("CustomerKey"), F.lit(0))).scalar()
    added = with_key(kept(arriving, "arriving"), "CustomerKey", distinct=True, after=highest)
    return updated.select(*dim_customer.columns).unionByName(added)


def upsert_dim_contract(dim_contract: DataFrame, changed: DataFrame) -> DataFrame:
    """Contract combinations the batch brings in are numbered after the highest key; none goes."""
    offered = live(changed).select(*[F.col(s).alias(t) for t, s in schemas.CONTRACT_ATTRIBUTES.items()]).distinct()
    names = list(schemas.CONTRACT_ATTRIBUTES)
    new = offered.join(dim_contract, names, "left_anti")
    highest = dim_contract.agg(F.coalesce(F.max("ContractKey"), F.lit(0))).scalar()
    added = with_key(new, "ContractKey", distinct=True, after=highest, key_type="int")
    return dim_contract.unionByName(added)


def keyed_changes(changed: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Changed rows with the customer key of the dimension after the batch."""
    rows = live(changed)
    ids = rows.select(F.col("customer_id").alias("CustomerID"))
    return gold.key_subscribers(rows, dim_customer.join(ids, "CustomerID", "left_semi"))


def deleted_keys(changed: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customer keys that go with the batch, from the dimension before it."""
    ids = changed.filter(deleted(changed)).select(F.col("customer_id").alias("CustomerID"))
    return dim_customer.join(ids, "CustomerID", "left_semi").select("CustomerKey")


def _touched(keyed: DataFrame, gone: DataFrame | None) -> DataFrame:
    customers = keyed.select("CustomerKey")
    return (customers if gone is None else customers.union(gone.select("CustomerKey"))).distinct()


def upsert_fact_churn(fact_churn: DataFrame, keyed: DataFrame, dim_contract: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Facts after a batch: those of changed customers are replaced, those of ``gone`` ones go, all others stay untouched.

    A customer's new facts take over the keys of the old ones, in order; what is left over
    is numbered after the highest key. ``keyed`` is the batch with customer keys (``keyed_changes``),
    ``dim_contract`` the dimension after it. The stored facts meet only the batch's keys.
    """
    new = gold.fact_rows(keyed, dim_contract)
    customers = _touched(keyed, gone)
    untouched = fact_churn.join(customers, "CustomerKey", "left_anti")
    mine = Window.partitionBy("CustomerKey")
    old = fact_churn.join(customers, "CustomerKey", "left_semi").select("CustomerKey", "ChurnKey")
    old = old.withColumn("_place", F.row_number().over(mine.orderBy("ChurnKey")))
    content = [c for c in new.columns if c != "CustomerKey"]
    placed = new.withColumn("_place", F.row_number().over(mine.orderBy(*content))).join(old, ["CustomerKey", "_place"], "left")
    placed = kept(placed, "placed")
    highest = fact_churn.agg(F.coalesce(F.max("ChurnKey"), F.lit(0))).scalar()
    added = with_key(placed.filter("ChurnKey IS NULL").select(*new.columns), "ChurnKey", after=highest)
    known = placed.filter("ChurnKey IS NOT NULL")
    return untouched.select(*fact_churn.columns).unionByName(known.select(*fact_churn.columns)).unionByName(added)


def upsert_bridge(bridge: DataFrame, keyed: DataFrame, dim_service: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Held services after a batch: those of changed customers are replaced, those of ``gone`` ones go."""
    untouched = bridge.join(_touched(keyed, gone), "CustomerKey", "left_anti")
    return untouched.unionByName(gold.build_fact_customer_service(keyed, dim_service))
