"""A star schema stored by state, of which a reload rewrites the changed states only.

Typed rows are summed up to one digest a state, whatever their order or files. A
reload compares digests, rebuilds the states that differ and replaces their folders;
all other folders stay as they are. Surrogate keys stay with their customers.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition import schemas
from attrition.operators import checks, gold, incremental
from attrition.operators.keys import content_key, with_key
from attrition.operators.silver import build_silver
from attrition.plans.warehouse import code_mark
from attrition.session import delete, kept
from attrition.sources import landing

# The folder of a state: a letter and a digest, so that any text, or none, makes a plain folder name and no number.
PART = "part"
TABLES = ["dim_customer", "fact_customer_service", "fact_churn", "model", "silver"]


def part_of(state: str) -> Column:
    return F.expr(f"concat('p', md5(coalesce(concat('=', `{state}`), '-')))")


def digests(typed: DataFrame, code: str = "") -> DataFrame:
    """``part, n, first, second``: rows of each part and two sums of hashes of them, so neither order nor files count but copies do.

    Summed in each task before anything is shuffled: one row a part and task moves.
    """
    key = F.expr(content_key([c for c in typed.columns if c != PART]))
    hashes = {f: F.sum(F.xxhash64(F.lit(f + code), key).cast("decimal(20,0)")) for f in ("first", "second")}
    return typed.groupBy(PART).agg(F.count("*").alias("n"), *[h.cast("decimal(38,0)").alias(f) for f, h in hashes.items()])


def take_over_keys(new: DataFrame, old: DataFrame | None, key: str, by: str, highest: int) -> DataFrame:
    """``new`` with ``key``: rows of one ``by`` take over the keys ``old`` had for it, in order; the rest is numbered after ``highest``."""
    if old is None:
        return with_key(new, key, after=highest)
    mine = Window.partitionBy(by)
    held = old.select(by, key).withColumn("_place", F.row_number().over(mine.orderBy(key)))
    placed = new.withColumn("_place", F.row_number().over(mine.orderBy(*[c for c in new.columns if c != by])))
    placed = kept(placed.join(held, [by, "_place"], "left"), "placed")
    added = with_key(placed.filter(F.col(key).isNull()).select(*new.columns), key, after=highest)
    return placed.filter(F.col(key).isNotNull()).select(key, *new.columns).unionByName(added)


class StateStore:
    """Tables under ``root``, each with a folder a state; ``load`` brings them to what the given raw rows call for.

    ``entries`` has one row a finished load: where its digests and contracts are, and the highest keys
    ever given. It is written last, so an interrupted load is done again; the typed rows are
    written just before it, as the old ones say which customers a change touches.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getitem__(self, table: str) -> DataFrame:
        if table == "dim_contract":
            return self.spark.read.parquet(self._entry()["contracts"])
        return self.spark.read.parquet(f"{self.root}/{table}")

    def _entry(self) -> dict | None:
        fields = "at long, digests string, contracts string, customer_high long, churn_high long"
        try:
            rows = self.spark.read.schema(fields).json(f"{self.root}/entries").orderBy(F.desc("at")).limit(1).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows[0].asDict() if rows else None

    def _old(self, table: str, parts: list[str]) -> DataFrame | None:
        """The stored rows of some parts; None if nothing is stored yet."""
        try:
            return self[table].filter(F.col(PART).isin(parts))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _high(self, table: str, key: str, known: int) -> int:
        """The highest key ever given, also by a load that was interrupted."""
        try:
            return max(known, self[table].agg(F.max(key)).first()[0] or 0)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return known

    def _replace(self, table: str, rows: DataFrame, parts: list[str]) -> None:
        """The folders of ``parts`` get ``rows``; those without any go."""
        path = f"{self.root}/{table}"
        spread = rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        spread.partitionBy(PART).parquet(path)
        there = {r[PART] for r in rows.select(PART).distinct().collect()}  # a state each
        for part in set(parts) - there:
            delete(self.spark, f"{path}/{PART}={part}")

    def load(self, bronze: DataFrame) -> list[str]:
        """Make the tables those of ``bronze``; the parts that were rewritten, none if nothing has changed.

        A broken constraint stops the load before any table is touched. Lists here have an entry a state.
        """
        entry = self._entry() or {"customer_high": 0, "churn_high": 0}
        typed = build_silver(bronze, stamp=False)
        typed = typed.withColumn(PART, part_of("state"))
        now = kept(digests(typed, code_mark()), "digests")
        if "digests" in entry:
            before = self.spark.read.parquet(entry["digests"])
            same = now.join(before, now.columns, "left_semi").select(PART)
            every = now.select(PART).union(before.select(PART)).distinct()
            changed = [r[PART] for r in every.join(same, PART, "left_anti").collect()]
        else:
            changed = [r[PART] for r in now.select(PART).collect()]
        if not changed:
            return []

        arrived = kept(typed.filter(F.col(PART).isin(changed)), "arrived")
        required = checks.required_columns("silver")
        checks.require_filled("silver", arrived.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict())
        left = self._old("silver", changed)
        stays = None if left is None else self["silver"].filter(~F.col(PART).isin(changed)).select(*arrived.columns)

        # A customer in several states: facts in all of them depend on all the rows.
        touched = set(changed)
        if stays is not None:
            ids = arrived.select("customer_id").union(left.select("customer_id")).distinct()
            touched |= {r[PART] for r in stays.select("customer_id", PART).join(ids, "customer_id", "left_semi").select(PART).distinct().collect()}
        parts = sorted(touched)

        made = self._build(arrived, stays, changed, parts, entry)
        for table in TABLES[:-1]:
            self._replace(table, made[table], changed if table == "dim_customer" else parts)
        self._replace("silver", arrived, changed)
        mark = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        places = {"digests": f"{self.root}/digests-{mark}", "contracts": f"{self.root}/contracts-{mark}"}
        landing.write_table(now, places["digests"])
        landing.write_table(made["dim_contract"], places["contracts"])
        columns = {"at": time.time_ns(), **places, "customer_high": made["customer_high"], "churn_high": made["churn_high"]}
        self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in columns.items()]).write.mode("append").json(f"{self.root}/entries")
        return parts

    def _build(self, arrived: DataFrame, stays: DataFrame | None, changed: list[str], parts: list[str], entry: dict) -> dict:
        """The new content of the touched parts, checked, in scratch folders."""
        rows = arrived.drop(PART)
        if "contracts" in entry:
            contracts = incremental.upsert_dim_contract(self["dim_contract"], rows)
        else:
            contracts = gold.build_dim_contract(rows)
        contracts = kept(contracts, "contracts")

        customers = gold.renamed(rows, schemas.CUSTOMER_ATTRIBUTES).distinct()
        high = self._high("dim_customer", "CustomerKey", entry["customer_high"])
        numbered = take_over_keys(customers, self._old("dim_customer", changed), "CustomerKey", "CustomerID", high)
        numbered = kept(numbered.withColumn(PART, part_of("State")), "customers")
        known = numbered
        if also := [p for p in parts if p not in changed]:
            known = known.unionByName(self._old("dim_customer", also))

        places = known.select("CustomerKey", PART)
        subscribers = rows if stays is None else rows.unionByName(
            stays.drop(PART).join(known.select(F.col("CustomerID").alias("customer_id")), "customer_id", "left_semi")
        )
        keyed = kept(gold.key_subscribers(subscribers, known), "keyed")
        services = gold.build_dim_service(self.spark)
        bridge = kept(gold.build_fact_customer_service(keyed, services), "bridge")
        facts = gold.fact_rows(keyed, contracts)
        churn_high = self._high("fact_churn", "ChurnKey", entry["churn_high"])
        facts = kept(take_over_keys(facts, self._old("fact_churn", parts), "ChurnKey", "CustomerKey", churn_high), "facts")

        tables = {"dim_customer": known, "dim_contract": contracts, "dim_service": services}
        tables |= {"fact_customer_service": bridge, "fact_churn": facts}
        for table in tables:
            checks.verify(table, tables)
        profile = gold.build_customer_profile(known.drop(PART), bridge)
        model = gold.build_model(facts, contracts, profile).withColumn(PART, part_of("State"))
        tops = known.agg(F.max("CustomerKey")).first()[0], facts.agg(F.max("ChurnKey")).first()[0]
        return {
            "dim_customer": numbered,
            "dim_contract": contracts,
            "fact_customer_service": kept(bridge.join(places, "CustomerKey"), "bridge-parts"),
            "fact_churn": kept(facts.join(places, "CustomerKey"), "fact-parts"),
            "model": kept(model, "model-parts"),
            "customer_high": max(high, tops[0] or 0),
            "churn_high": max(churn_high, tops[1] or 0),
        }
