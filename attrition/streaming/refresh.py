"""Customer changes from arriving files, through to star tables and KPIs after every batch.

The typed rows are kept in hash buckets of the customer id. A micro-batch looks up the
customers it names and writes one change file with what it makes of them; buckets
are left alone. Readers lay the pending changes over the buckets. Change files of like
size are merged, and a bucket takes its pending changes in once they are a share of its own
rows, so each change is rewritten a bounded number of times, however large the state is.
Buckets split one after the other as the state grows (linear hashing), so none outgrows ``bucket_rows`` by much.

A deleted customer stays as a tombstone, which refuses changes from before the delete and keeps
the surrogate key; readers do not see it.

A batch ends by writing a ledger that names all files of the state; readers follow the
latest. A batch that runs again starts from the ledger before it and overwrites its own
output, so a retry changes nothing. Files that neither of the last two ledgers names are removed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from attrition import schemas
from attrition.operators import gold
from attrition.operators.checks import require_clean
from attrition.operators.incremental import OPERATION, deleted, latest_versions, upsert_dim_contract
from attrition.operators.keys import with_key
from attrition.plans.kpis import overview_from
from attrition.session import delete
from attrition.sources.feed import build_feed
from attrition.streaming import cells

# Customers of a bucket before it is split, and the share of a bucket's rows that may be pending.
BUCKET_ROWS, FOLD_SHARE = 1_000_000, 0.25
# Rows that one task sorts when a bucket is rewritten.
TASK_ROWS = 50_000
# Batches after which their KPI rows are put into one file.
HISTORY = 16
KEY, GONE, BATCH = "CustomerKey", "_deleted", "_batch"
# Files with differences of cells, before they are put into one.
CELL_FILES = 8
# What KPI rows are made of; fixed types, as sums of sums would grow wider from batch to batch.
SUMS = {"total": "bigint", "churners": "bigint", "monthly_revenue": "decimal(38,2)", "_cltv": "bigint", "lifetime_revenue": "decimal(38,2)"}
LEDGER = "kind string, number bigint, holder bigint, folded bigint, rows bigint, pending bigint"


@dataclass
class Bucket:
    holder: int | None = None  # the batch that wrote its rows
    folded: int = -1  # changes up to this batch are among them
    rows: int = 0
    pending: int = 0


@dataclass
class Ledger:
    """All files of the state after a batch. One entry a bucket, and change files, which double in size from each to the one before."""

    version: int | None = None
    buckets: list[Bucket] = field(default_factory=lambda: [Bucket()])
    deltas: dict[int, int] = field(default_factory=dict)  # batch to rows
    cells: list[int] = field(default_factory=list)  # batches whose differences make up the cells
    highest: int = 0  # customer key
    customers: int = 0  # tombstones included
    contracts: int | None = None
    history: int = -1  # KPI rows up to this batch are in one file

    def rows(self) -> list[tuple]:
        listed = [("bucket", i, b.holder, b.folded, b.rows, b.pending) for i, b in enumerate(self.buckets)]
        listed += [("delta", batch, None, None, rows, None) for batch, rows in self.deltas.items()]
        listed += [("cells", batch, None, None, None, None) for batch in self.cells]
        return [*listed, *[(k, getattr(self, k), None, None, None, None) for k in ("highest", "customers", "contracts", "history")]]

    def bucket_path(self, root: str, number: int) -> str:
        return f"{root}/state/batch={self.buckets[number].holder}/bucket={number}"

    def paths(self, root: str) -> set[str]:
        held = {self.bucket_path(root, i) for i, b in enumerate(self.buckets) if b.holder is not None}
        held |= {f"{root}/delta/batch={batch}" for batch in self.deltas} | {f"{root}/cells/batch={batch}" for batch in self.cells}
        if self.contracts is not None:
            held.add(f"{root}/contracts/batch={self.contracts}")
        if self.history >= 0:
            held.add(f"{root}/kpi-history/upto={self.history}")
        return held


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _versions(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Batches whose ledgers are there, rising; older ones than the last few are removed."""
    try:
        found = spark.read.schema(f"{LEDGER}, batch bigint").parquet(f"{root}/ledger").select("batch").distinct().collect()
    except AnalysisException as error:
        if not _missing(error):
            raise
        return []
    return sorted(row["batch"] for row in found if before is None or row["batch"] < before)


def current_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    return max(_versions(spark, root, before), default=None)


def read_ledger(spark: SparkSession, root: str, version: int | None) -> Ledger:
    if version is None:
        return Ledger()
    found = Ledger(version=version)
    buckets = {}
    for row in spark.read.schema(LEDGER).parquet(f"{root}/ledger/batch={version}").collect():  # one a bucket
        if row["kind"] == "bucket":
            buckets[row["number"]] = Bucket(row["holder"], row["folded"], row["rows"], row["pending"])
        elif row["kind"] == "delta":
            found.deltas[row["number"]] = row["rows"]
        elif row["kind"] == "cells":
            found.cells.append(row["number"])
        else:
            setattr(found, row["kind"], row["number"])
    found.buckets = [buckets[i] for i in range(len(buckets))]
    return found


def bucket_of(key: str, count: int) -> str:
    """Linear hashing: with ``count`` buckets the first ones are split already, the others not yet."""
    whole = 1 << max(count - 1, 0).bit_length()
    wide, narrow = (f"pmod(xxhash64({key}), {n})" for n in (whole, max(whole // 2, 1)))
    return f"CAST(CASE WHEN {wide} < {count} THEN {wide} ELSE {narrow} END AS INT)"


def origin(number: int, count: int) -> int:
    """The bucket that held ``number``'s rows when there were ``count`` buckets."""
    while number >= count:
        number -= 1 << (number.bit_length() - 1)
    return number


def _open_changes(spark: SparkSession, root: str, ledger: Ledger, key: str, only: set[int] | None = None) -> DataFrame | None:
    """Rows of the change files that their buckets have not taken in yet, of some buckets or of all."""
    if not ledger.deltas:
        return None
    rows = spark.read.parquet(*[f"{root}/delta/batch={batch}" for batch in ledger.deltas])
    marks = [(i, b.folded) for i, b in enumerate(ledger.buckets) if b.pending and (only is None or i in only)]
    folded = spark.createDataFrame(marks, "_bucket int, _folded bigint")  # at most every bucket
    placed = rows.withColumn("_bucket", F.expr(bucket_of(key, len(ledger.buckets))))
    return placed.join(F.broadcast(folded), "_bucket").filter(f"{BATCH} > _folded").select(*rows.columns)


def _pending(spark: SparkSession, root: str, ledger: Ledger, key: str, only: set[int] | None = None) -> DataFrame | None:
    """The newest pending row of each customer, of some buckets or of all."""
    open_rows = _open_changes(spark, root, ledger, key, only)
    if open_rows is None:
        return None
    rest = [c for c in open_rows.columns if c not in (key, BATCH)]
    newest = open_rows.groupBy(key).agg(F.max(F.struct(BATCH, *rest)).alias("_row"))
    return newest.select(key, "_row.*").select(*open_rows.columns)


def _rows(spark: SparkSession, root: str, ledger: Ledger, key: str, only: set[int] | None = None, keys: DataFrame | None = None) -> DataFrame | None:
    """Rows of the state, tombstones included: buckets with their pending changes laid over; ``keys`` are looked up in both."""
    numbers = [i for i in range(len(ledger.buckets)) if only is None or i in only]
    paths = [ledger.bucket_path(root, i) for i in numbers if ledger.buckets[i].holder is not None]
    base = spark.read.parquet(*paths) if paths else None
    pending = _pending(spark, root, ledger, key, only)
    if keys is not None:
        base, pending = (df if df is None else df.join(keys, key, "left_semi") for df in (base, pending))
    if base is None:
        return None if pending is None else pending.drop(BATCH)
    if pending is None:
        return base
    return base.join(pending.select(key), key, "left_anti").unionByName(pending.drop(BATCH).select(*base.columns))


def _state(spark: SparkSession, root: str, key: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"no snapshot under {root}")
    rows = _rows(spark, root, read_ledger(spark, root, version), key)
    if rows is None:
        raise ValueError(f"nothing has arrived under {root}")
    return rows.filter(f"NOT {GONE}").drop(GONE)


def read_current(spark: SparkSession, root: str, key: str = "customer_id") -> DataFrame:
    return _state(spark, root, key).drop(KEY)


def read_gold(spark: SparkSession, root: str, key: str = "customer_id") -> dict[str, DataFrame]:
    """The star tables of the latest batch. A customer has one typed row, so its fact takes the
    customer's key; all tables but the contracts are projections of the state."""
    state = _state(spark, root, key)
    contracts = read_ledger(spark, root, current_version(spark, root)).contracts
    dim_contract = spark.read.parquet(f"{root}/contracts/batch={contracts}")
    dim_service = gold.build_dim_service(spark)
    return {
        "dim_customer": gold.renamed(state, {KEY: KEY} | schemas.CUSTOMER_ATTRIBUTES),
        "dim_contract": dim_contract,
        "dim_service": dim_service,
        "fact_churn": gold.fact_rows(state, dim_contract).withColumn("ChurnKey", F.col(KEY)),
        "fact_customer_service": gold.build_fact_customer_service(state, dim_service),
    }


def read_model(spark: SparkSession, root: str) -> DataFrame:
    """The wide model over the latest star tables, for measures and visuals."""
    star = read_gold(spark, root)
    profile = gold.build_customer_profile(star["dim_customer"], star["fact_customer_service"])
    return gold.build_model(star["fact_churn"], star["dim_contract"], profile)


def _kpi_sums(spark: SparkSession, root: str, history: int) -> DataFrame:
    """What the overview of each batch is made of: one file of earlier batches, and one of each later batch."""
    recent = spark.read.parquet(f"{root}/kpi").withColumn("batch", F.col("batch").cast("bigint")).filter(F.col("batch") > history)
    if history < 0:
        return recent
    return spark.read.parquet(f"{root}/kpi-history/upto={history}").unionByName(recent)


def read_kpis(spark: SparkSession, root: str) -> DataFrame:
    """The overview row of every batch so far."""
    version = current_version(spark, root)
    sums = _kpi_sums(spark, root, read_ledger(spark, root, version).history)
    return overview_from(sums.filter(F.col("batch") <= version), "batch")


def _cells(spark: SparkSession, root: str, ledger: Ledger) -> DataFrame:
    return spark.read.parquet(*[f"{root}/cells/batch={batch}" for batch in ledger.cells])


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    """Additive cells of the latest batch, for the page KPIs and facet counts of ``attrition.streaming.cells``."""
    return cells.merged(_cells(spark, root, read_ledger(spark, root, current_version(spark, root))))


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """What every batch so far did: ``batch``, the customer, ``insert``, ``update`` or ``delete``, versions before and after.

    A customer that comes back after a delete is an insert.
    """
    version = current_version(spark, root)
    rows = spark.read.parquet(f"{root}/changed").withColumn("batch", F.col("batch").cast("bigint"))
    return rows.filter(F.col("batch") <= version)


def _moves(spark: SparkSession, root: str, ledger: Ledger, latest: DataFrame, touched: set[int], key: str, sequence: str) -> DataFrame:
    """Changes that are taken, next to the stored rows of their customers."""
    gone = deleted(latest)
    columns = [c for c in latest.columns if c != OPERATION]
    offered = latest.select(key, F.struct(*columns).alias("new"), gone.alias("gone"))
    stored = _rows(spark, root, ledger, key, touched, latest.select(key))
    if stored is None:
        kinds = [f"CAST(NULL AS {latest.schema[c].dataType.simpleString()}) AS `{c}`" for c in columns]
        stored = latest.selectExpr(*kinds, f"CAST(NULL AS BIGINT) AS {KEY}", f"CAST(NULL AS BOOLEAN) AS {GONE}").filter("false")
    old = stored.select(key, F.struct(*columns).alias("old"), KEY, F.col(GONE).alias("was_gone"))
    joined = offered.join(old, key, "left")
    taken = joined.filter(F.col("old").isNull() | F.coalesce(F.col(f"new.{sequence}") >= F.col(f"old.{sequence}"), F.lit(True)))
    there = "(old IS NOT NULL AND NOT was_gone)"
    change = f"CASE WHEN gone AND {there} THEN 'delete' WHEN gone THEN NULL WHEN {there} THEN 'update' ELSE 'insert' END"
    return taken.withColumns({"there": F.expr(there), "change": F.expr(change)})


def _changed_rows(moves: DataFrame, batch_id: int) -> DataFrame:
    """What the batch makes of the customers it names; new ones, which are not ``GONE``, have no key yet."""
    return moves.select("new.*", KEY, F.col("gone").alias(GONE), F.lit(batch_id).cast("bigint").alias(BATCH))


def _numbered(rows: DataFrame, key: str, highest: int) -> DataFrame:
    """Rows of the change file. Known customers keep their keys, new ones are numbered after ``highest``; tombstones need none."""
    arriving = rows.filter(f"NOT {GONE} AND {KEY} IS NULL").drop(KEY)
    numbered = with_key(arriving, KEY, [key], distinct=True, after=highest)
    return rows.filter(f"{GONE} OR {KEY} IS NOT NULL").unionByName(numbered.select(*rows.columns))


def apply_batch(
    batch: DataFrame, batch_id: int, root: str, key: str, sequence: str, bucket_rows: int = BUCKET_ROWS, fold_share: float = FOLD_SHARE
) -> None:
    spark = batch.sparkSession
    versions = _versions(spark, root, before=batch_id)
    before = read_ledger(spark, root, max(versions, default=None))

    def written(df: DataFrame, folder: str) -> DataFrame:
        path = f"{root}/{folder}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # Stored first: a small batch is then known to be small and the state is not shuffled for it.
    latest = written(latest_versions(batch, key, sequence), "latest")
    in_bucket = bucket_of(key, len(before.buckets))
    named = latest.selectExpr(f"{in_bucket} AS b", f"{key} IS NULL AS missing").groupBy("b").agg(F.count_if("missing").alias("missing_ids"))
    touched = named.collect()  # at most every bucket
    require_clean(spark.createDataFrame(touched, "b int, missing_ids bigint"), "missing_ids")
    moves = written(_moves(spark, root, before, latest, {row["b"] for row in touched}, key, sequence), "moves")

    after = Ledger(
        batch_id, list(before.buckets), dict(before.deltas), [*before.cells, batch_id], before.highest, before.customers, batch_id, before.history
    )
    taken = moves.selectExpr(f"{in_bucket} AS b", "old IS NULL AS unknown").groupBy("b").agg(F.count("*").alias("n"), F.count_if("unknown").alias("new"))
    taken = taken.collect()
    counts, rows = {r["b"]: r["n"] for r in taken}, sum(r["n"] for r in taken)
    after.customers += sum(r["new"] for r in taken)
    if rows:
        after.buckets = [Bucket(b.holder, b.folded, b.rows, b.pending + counts.get(i, 0)) for i, b in enumerate(before.buckets)]
        wanted = max(len(after.buckets), math.ceil(after.customers / bucket_rows))
        folding = {i for i, b in enumerate(after.buckets) if b.pending and b.pending >= fold_share * b.rows}
        folding |= {origin(i, len(after.buckets)) for i in range(len(after.buckets), wanted)}
        new = _changed_rows(moves, batch_id)
        if set(counts) <= folding:
            # Every bucket the batch names takes it in at once: no change file is needed.
            top = _fold(spark, root, after, key, folding, wanted, new, before.highest)
        else:
            top = _write_changes(spark, root, before, after, _numbered(new, key, before.highest), rows, key)
            _fold(spark, root, after, key, folding, wanted)
        after.highest = max(before.highest, top or 0)

    # Contracts of the batch, and KPIs: what was stored of its customers is taken off, what they are now is added.
    stored = spark.read.parquet(f"{root}/contracts/batch={before.contracts}") if before.contracts is not None else None
    dim_contract = gold.build_dim_contract(latest.filter(~deleted(latest))) if stored is None else upsert_dim_contract(stored, latest)
    written(dim_contract, "contracts")
    sides = "CASE WHEN NOT gone THEN struct(new AS row, 1 AS sign) END, CASE WHEN there THEN struct(old AS row, -1 AS sign) END"
    signed = moves.selectExpr(f"inline(array_compact(array({sides})))").select("row.*", "sign")
    differences = cells.differences(build_feed(signed, "sign"))
    if len(before.cells) >= CELL_FILES:
        differences = cells.merged(differences.unionByName(_cells(spark, root, before)))
        after.cells = [batch_id]
    written(differences, "cells")
    overview = cells.overview_sums(_cells(spark, root, after))
    written(overview.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in SUMS.items()]), "kpi")
    changed = moves.filter("change IS NOT NULL")
    written(changed.select(key, "change", F.when(F.col("there"), F.col(f"old.{sequence}")).alias("version_before"), F.col(f"new.{sequence}").alias("version_after")), "changed")
    if before.version is not None and before.version - before.history >= HISTORY:
        after.history = before.version
        kept = _kpi_sums(spark, root, before.history).filter(F.col("batch") <= before.version)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{root}/kpi-history/upto={after.history}")
    spark.createDataFrame(after.rows(), LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/batch={batch_id}")
    _remove_superseded(spark, root, versions, before)


def _write_changes(spark: SparkSession, root: str, before: Ledger, after: Ledger, rows: DataFrame, count: int, key: str) -> int | None:
    """The batch's change file. Earlier ones that are not much larger go into it, so few are left, and each row is moved a few times only."""
    merged = {}
    for batch in sorted(before.deltas, reverse=True):
        if before.deltas[batch] > 2 * (count + sum(merged.values())):
            break
        merged[batch] = before.deltas[batch]
    if merged:
        earlier = _pending(spark, root, Ledger(buckets=before.buckets, deltas=merged), key)
        rows = rows.unionByName(earlier.join(rows.select(key), key, "left_anti").select(*rows.columns))
    path = f"{root}/delta/batch={after.version}"
    rows.write.mode("overwrite").parquet(path)
    found = spark.read.schema(rows.schema).parquet(path).agg(F.count("*").alias("n"), F.max(KEY).alias("top")).first()
    after.deltas = {b: n for b, n in before.deltas.items() if b not in merged} | {after.version: found["n"]}
    return found["top"]


def _fold(
    spark: SparkSession, root: str, ledger: Ledger, key: str, folding: set[int], wanted: int, new: DataFrame | None = None, highest: int = 0
) -> int | None:
    """Rewrite the buckets ``folding`` with their pending rows, and with ``new`` ones, as parts of ``wanted`` buckets.

    Stored, pending and new rows are dealt once: a task sorts its part of a bucket, keeps the newest row of a customer
    and numbers new customers, after those of the parts before it.
    """
    if not folding:
        return None
    count = len(ledger.buckets)
    paths = [ledger.bucket_path(root, i) for i in sorted(folding) if ledger.buckets[i].holder is not None]
    stored = spark.read.parquet(*paths).withColumn(BATCH, F.lit(-1).cast("bigint")) if paths else None
    layers = [rows for rows in (stored, _open_changes(spark, root, ledger, key, folding), new) if rows is not None]
    names = layers[-1].columns
    rows = reduce(DataFrame.unionByName, [layer.select(*names) for layer in layers])
    target = f"{root}/state/batch={ledger.version}"
    # A task for each bucket, several where there are fewer buckets than cores or where a bucket is more than a task should sort.
    parts = sum(origin(i, count) in folding for i in range(wanted))
    held = sum(ledger.buckets[i].rows + ledger.buckets[i].pending for i in folding)
    splits = max(spark.sparkContext.defaultParallelism // parts, math.ceil(held / parts / TASK_ROWS), 1)
    place = {"bucket": F.expr(bucket_of(key, wanted)), "_part": F.expr(f"pmod(hash({key}), {splits})")}
    dealt = rows.withColumns(place).repartition(max(parts * splits, spark.sparkContext.defaultParallelism), "bucket", "_part")
    newest = Window.partitionBy("bucket", "_part", key).orderBy(F.desc(BATCH))
    last = dealt.withColumn("_age", F.row_number().over(newest)).filter("_age = 1").drop("_age", BATCH)
    if new is not None:
        arrives = f"{KEY} IS NULL AND NOT {GONE}"
        sizes = new.filter(arrives).withColumns(place).groupBy("bucket", "_part").agg(F.count("*").alias("_size"))
        offsets = sizes.selectExpr(
            "bucket",
            "_part",
            """coalesce(sum(_size) OVER (ORDER BY bucket, _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _offset""",
        )
        inside = f"(PARTITION BY bucket, _part ORDER BY {key} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        last = last.withColumn("_place", F.expr(f"count_if({arrives}) OVER {inside}"))
        # One row a part of a bucket.
        last = last.join(F.broadcast(offsets), ["bucket", "_part"], "left")
        last = last.withColumn(KEY, F.expr(f"CASE WHEN {arrives} THEN {highest}L + _offset + _place ELSE {KEY} END"))
    placed = last.select(*[c for c in names if c != BATCH], "bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(target)
    sizes = spark.read.schema(placed.schema).parquet(target).groupBy("bucket").agg(F.count("*").alias("n"), F.max(KEY).alias("top")).collect()
    held = {row["bucket"]: row["n"] for row in sizes}  # those rewritten
    ledger.buckets = [
        Bucket(ledger.version if i in held else None, ledger.version, held.get(i, 0)) if origin(i, count) in folding else ledger.buckets[i]
        for i in range(wanted)
    ]
    behind = [b.folded for b in ledger.buckets if b.pending]
    ledger.deltas = {batch: n for batch, n in ledger.deltas.items() if behind and batch > min(behind)}
    return max((row["top"] for row in sizes if row["top"] is not None), default=None)


def _remove_superseded(spark: SparkSession, root: str, versions: list[int], before: Ledger) -> None:
    """Delete what ledgers before ``before`` named and it no longer does, and those ledgers."""
    for version in versions[:-1]:
        earlier = read_ledger(spark, root, version)
        gone = earlier.paths(root) - before.paths(root)
        gone |= {f"{root}/{folder}/batch={version}" for folder in ("latest", "moves")}
        if version not in before.deltas:
            gone.add(f"{root}/delta/batch={version}")  # a bucket may have taken it in at once
        # KPI rows go once two ledgers name the file that holds them.
        gone |= {f"{root}/kpi/batch={batch}" for batch in range(earlier.history - HISTORY, earlier.history + 1) if batch >= 0}
        for name in sorted(gone):
            delete(spark, name)
        delete(spark, f"{root}/ledger/batch={version}")


def refresh_stream(
    spark: SparkSession,
    arriving: str,
    schema: StructType,
    root: str,
    key: str = "customer_id",
    sequence: str = "version",
    files_per_batch: int = 1000,
    every: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
    fold_share: float = FOLD_SHARE,
) -> StreamingQuery:
    """Take in every file that has arrived and stop, or go on taking in what has arrived ``every`` so often (``15 minutes``).

    ``files_per_batch`` bounds a micro-batch. Changes may have a column ``operation``, see ``attrition.operators.incremental``.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(arriving)
    writer = source.writeStream.foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, root, key, sequence, bucket_rows, fold_share)
    ).option("checkpointLocation", f"{root}/progress")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
