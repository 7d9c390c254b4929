"""Every query by name, as a function of a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, FloatType, IntegerType, ShortType

from attrition import schemas
from attrition.functions import cleansing, derive
from attrition.operators import checks, filters, gold, incremental, silver
from attrition.operators.domains import literal_table
from attrition.operators.keys import with_key
from attrition.plans import charts, kpis, questions, visuals
from attrition.plans.measures import FOLDERS, MEASURES, RETENTION, evaluate
from attrition.plans.reload import PART, StateStore
from attrition.plans.warehouse import LAYERS, Warehouse, open_warehouse
from attrition.session import clear_scratch, kept, scratch  # noqa: F401
from attrition.sources import feed as feeds
from attrition.sources import landing
from attrition.sources.subscribers import read_questions
from attrition.streaming import cells, refresh

Query = Callable[[SparkSession, str], DataFrame]

# Filter sets the filtered variants run under.
FEED_FILTER = {"gender": "Male", "contract": "Month-to-month", "internet": "DSL", "tenure": "49-72"}
FACET_FILTER = {"gender": "Male", "contract": "Month-to-month", "pay": "Electronic check"}
MODEL_FILTER = {
    "Gender": "Female",
    "ContractType": ["Month-to-month", "One year"],
    "ServiceCategory": "Add-on",
    "PaymentMethod": "All",
}
COUNTED_LAYERS = [
    "bronze",
    "silver",
    "dim_customer",
    "dim_contract",
    "dim_service",
    "fact_customer_service",
    "fact_churn",
]
STAR = COUNTED_LAYERS[2:]
# Raw headers as a workbook would spell them; the rest are the column names in title case.
RAW_HEADERS = {
    "customer_id": "CustomerID",
    "zip_code": "Zip. Code",
    "lat_long": "Lat  Long",
    "churn_value": "(Churn) Value",
    "churn_score": "Churn Score %",
}


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as bigint, for comparison with other engines."""
    columns = []
    for field in df.schema:
        column = f"`{field.name}`"
        if isinstance(field.dataType, (DecimalType, FloatType)):
            column = f"CAST({column} AS DOUBLE) AS {column}"
        elif isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            column = f"CAST({column} AS BIGINT) AS {column}"
        columns.append(column)
    return df.selectExpr(*columns)


def tables(w: Warehouse, names: list[str]) -> dict[str, DataFrame]:
    return {name: w[name] for name in names}


# Landing.


def raw_headers(bronze: DataFrame) -> DataFrame:
    return bronze.toDF(*[RAW_HEADERS.get(name, name.replace("_", " ").title()) for name in bronze.columns])


def read_raw(w: Warehouse) -> DataFrame:
    path = scratch(w.spark, "raw")
    _write_csv(w["bronze"], path)
    return landing.read_raw(w.spark, path)


def _write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.option("header", "true").option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def read_raw_cells(w: Warehouse) -> DataFrame:
    """Free text with quotes, commas, line ends and blanks at the edges, through a text file and back."""
    path = scratch(w.spark, "cells")
    turns = w.spark.read.parquet(f"{w.source}/conversations.parquet")
    cell = """concat(' said "', role, '", then:\n', coalesce(text, ''), ',"" ')"""
    _write_csv(turns.selectExpr("CAST(conv_id AS STRING) AS conv_id", "CAST(turn AS STRING) AS turn", f"{cell} AS cell"), path)
    return landing.read_raw(w.spark, path)


def _ragged(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Records of text files some of which have a cell too many or too few: those read, and those rejected."""
    path = scratch(w.spark, "ragged")
    more = "CASE WHEN n % 50 = 0 THEN ',extra' ELSE '' END"
    less = "CASE WHEN n % 70 = 0 AND n % 50 <> 0 THEN customer_id ELSE concat_ws(',', customer_id, gender, contract) END"
    rows = w["bronze"].withColumn("n", _number())
    rows.selectExpr(f"concat({less}, {more}) AS value").write.text(path)
    read = landing.read_raw(w.spark, path, multiline=False, names=["customer_id", "gender", "contract"], rejects=f"{path}-rejects")
    return read, w.spark.read.parquet(f"{path}-rejects")


def stringified(w: Warehouse) -> DataFrame:
    return landing.stringify(w.spark.read.parquet(f"{w.source}/customer.parquet"))


def bulk_write(w: Warehouse) -> DataFrame:
    """Written twice: the second write replaces the first; what is there is read back."""
    path = scratch(w.spark, "bulk")
    for _ in range(2):
        landing.write_table(landing.stringify(w["bronze"]), path)
    return w.spark.read.parquet(path)


def one_line_text(w: Warehouse) -> DataFrame:
    turns = w.spark.read.parquet(f"{w.source}/conversations.parquet")
    return turns.selectExpr("conv_id", "turn", "role", f"{cleansing.one_line('text')} AS text")


def feed_sink(w: Warehouse) -> DataFrame:
    path = scratch(w.spark, "feed")
    rows = w["feed"]
    written = feeds.write_feed(rows, path)
    back = w.spark.read.schema(rows.schema).json(path)
    return back.withColumn("written", F.lit(written))


# Typed layer.


def _typed(w: Warehouse, *names: str) -> DataFrame:
    return silver.build_silver(w["bronze"], stamp=False).select("customer_id", *names)


_TEXT = [name for name in schemas.TEXT_WIDTHS if name not in ("customer_id", "churn_reason")]


def silver_reload(w: Warehouse) -> DataFrame:
    path = scratch(w.spark, "silver")
    for _ in range(2):
        landing.write_table(silver.build_silver(w["bronze"]), path, "overwrite")
    return w.spark.read.parquet(path).drop("dwh_create_date")


def silver_if_empty(w: Warehouse) -> DataFrame:
    """The first load writes, the second finds rows and leaves them."""
    path = scratch(w.spark, "silver")
    wrote = [landing.write_table(silver.build_silver(w["bronze"]), path, "if_empty") for _ in range(2)]
    rows = w.spark.read.parquet(path).drop("dwh_create_date")
    return rows.withColumn("first_wrote", F.lit(wrote[0])).withColumn("second_wrote", F.lit(wrote[1]))


# Star schema.


def keyed_distinct(w: Warehouse) -> DataFrame:
    orders = w.spark.read.parquet(f"{w.source}/orders.parquet")
    return with_key(orders.select("o_custkey", "o_orderpriority").distinct(), "row_key", distinct=True)


def keyed_copies(w: Warehouse) -> DataFrame:
    """A handful of distinct rows, each repeated many times."""
    lines = w.spark.read.parquet(f"{w.source}/lineitem.parquet")
    return with_key(lines.select("l_returnflag", "l_linestatus"), "row_key")


_RELOADED = ["CustomerID", "City", "ContractType", "PaymentMethod", "TenureMonths", "ChurnScore", "ChurnLabel", "ServiceMask"]


def full_reload(w: Warehouse) -> DataFrame:
    """Every layer built anew, seen through the last one."""
    fresh = Warehouse(w.spark, w.source, scratch(w.spark, "reload"))
    fresh.build_all()
    return fresh["model"].select("ChurnKey", "CustomerKey", *_RELOADED)


def facts_reload(w: Warehouse) -> DataFrame:
    fresh = Warehouse(w.spark, w.source, scratch(w.spark, "facts"))
    fresh.adopt(w, [layer for layer in LAYERS if layer in ("silver", "dim_customer", "dim_contract", "dim_service")])
    fresh.reload_facts()
    return fresh["model"].select("ChurnKey", "CustomerKey", *_RELOADED)


def changed_reload(w: Warehouse) -> DataFrame:
    """All states loaded, then again after one state's scores changed and another state went: only the first is rebuilt."""
    store = StateStore(w.spark, scratch(w.spark, "states"))
    store.load(w["bronze"])
    score = F.when(F.trim("state") == "NATION_1", F.expr("CAST(100 - CAST(churn_score AS INT) AS STRING)"))
    rows = w["bronze"].filter("coalesce(trim(state), '') <> 'NATION_2'")
    parts = store.load(rows.withColumn("churn_score", F.coalesce(score, "churn_score")))
    return store["model"].select("ChurnKey", "CustomerKey", *_RELOADED, F.col(PART).isin(parts).alias("reloaded"))


# Derived columns.


def service_flags(w: Warehouse) -> DataFrame:
    flags = derive.FEED_SUBSCRIBED
    return w["feed"].selectExpr("id", *[f"{hit} AS {name.lower().replace(' ', '_')}" for name, hit in flags.items()])


def service_categories(w: Warehouse) -> DataFrame:
    named = w["fact_customer_service"].join(F.broadcast(w["dim_service"]), "ServiceKey")
    return named.select("CustomerKey", "ServiceName", "ServiceCategory")


def city_status(w: Warehouse) -> DataFrame:
    rates = evaluate(w["model"], ["churn_rate"], ["City"])
    status, arrow = derive.rate_status("churn_rate"), derive.rate_arrow("churn_rate")
    return rates.selectExpr("*", f"{status} AS status", f"{arrow} AS arrow")


# Filters.


def bridge_filter(w: Warehouse) -> DataFrame:
    addon = F.col("ServiceCategory") == "Add-on"
    held = filters.through_bridge(w["fact_churn"], w["fact_customer_service"], w["dim_service"], addon)
    return held.select("ChurnKey", "CustomerKey", "ChurnLabel")


def model_filter(w: Warehouse) -> DataFrame:
    rows = filters.filter_model(w["model"], MODEL_FILTER | {"State": ["NATION_1", "NATION_2", "NATION_3"]})
    return rows.select("ChurnKey", "CustomerID", "ContractType", "ChurnLabel")


def saved_segments(spark: SparkSession) -> DataFrame:
    rows = [
        ("everyone", "All", "All", "All", "All", "All", "All"),
        ("monthly fiber", "All", "Month-to-month", "Fiber optic", "All", "All", "All"),
        ("new by check", "All", "All", "All", "Electronic check", "0-6", "All"),
        ("women gone", "Female", "All", "All", "All", "All", "Churned"),
        ("long and loyal", "Male", "Two year", "DSL", "Mailed check", "49-72", "Active"),
        ("nobody", "Other", "All", "All", "All", "All", "All"),
    ]
    return literal_table(spark, ["segment", *filters.DOMAINS], rows)


def entitlements(spark: SparkSession) -> DataFrame:
    rows = [
        ("ana", "Executive", ""),
        ("ben", "Regional", "NATION_1"),
        ("ben", "Regional", "NATION_7"),
        ("eve", "None", ""),
    ]
    return literal_table(spark, ["user", "role", "state"], rows)


def regional_rows(w: Warehouse) -> DataFrame:
    seen = filters.visible_rows(w["model"], kept(entitlements(w.spark), "grants"), "ben")
    return seen.select("ChurnKey", "State", "ChurnLabel")


def executive_rows(w: Warehouse) -> DataFrame:
    seen = filters.visible_rows(w["model"], kept(entitlements(w.spark), "grants"), "ana")
    return seen.select("ChurnKey", "State", "ChurnLabel")


def rows_by_user(w: Warehouse) -> DataFrame:
    """All users' rows in one job."""
    return filters.rows_by_user(w["model"], kept(entitlements(w.spark), "grants")).select("user", "ChurnKey", "State")


def sized_cities(w: Warehouse) -> DataFrame:
    cities = evaluate(w["model"], ["geo_customers", "geo_churn_rate"], ["City"])
    return filters.minimum_base(cities, "geo_customers", 10)


# Questions.


def tagged_questions(w: Warehouse) -> DataFrame:
    asked = read_questions(w.spark, w.source)
    return questions.explode_intents(asked).select("conv_id", "turn", "position", "intent")


def answered_questions(w: Warehouse) -> DataFrame:
    asked = read_questions(w.spark, w.source)
    return questions.answer_questions(asked, w["feed"]).select("conv_id", "turn", "answer")


def answered_suggestions(w: Warehouse) -> DataFrame:
    return questions.answer_questions(questions.suggested_questions(w.spark), w["feed"])


# Incremental loads.


def _number() -> Column:
    return F.expr("CAST(substring(customer_id, 2) AS BIGINT)")


def before_batch(w: Warehouse) -> DataFrame:
    """All but every tenth customer, at version 1."""
    rows = w["silver"].drop("dwh_create_date").withColumn("version", F.lit(1))
    return rows.filter(_number() % 10 != 0)


def batch(w: Warehouse) -> DataFrame:
    """New customers, two new versions of every seventh, and stale copies of every eleventh."""
    rows = w["silver"].drop("dwh_create_date")
    raised = rows.filter(_number() % 7 == 0)
    higher = (F.col("cltv") + F.col("version")).cast("int")
    arriving = rows.filter(_number() % 10 == 0).withColumn("version", F.lit(1))
    second = raised.withColumn("version", F.lit(2)).withColumn("cltv", higher)
    third = raised.withColumn("version", F.lit(3)).withColumn("cltv", higher).withColumn("city", F.lit("Moved"))
    stale = rows.filter(_number() % 11 == 0).withColumn("version", F.lit(0)).withColumn("city", F.lit("Stale"))
    return arriving.unionByName(second).unionByName(third).unionByName(stale)


def deletes(w: Warehouse) -> DataFrame:
    """Every thirteenth customer goes; deletes from before what is stored of every seventeenth, and of unknown customers, do nothing."""
    rows = w["silver"].drop("dwh_create_date").withColumn("operation", F.lit("delete"))
    last = rows.filter(_number() % 13 == 0).withColumn("version", F.lit(4))
    stale = rows.filter(_number() % 17 == 0).withColumn("version", F.lit(0))
    unknown = last.withColumn("customer_id", F.expr("concat('S9', substring(customer_id, 2))"))
    return last.unionByName(stale).unionByName(unknown)


def batch_with_deletes(w: Warehouse) -> DataFrame:
    return batch(w).withColumn("operation", F.lit(None).cast("string")).unionByName(deletes(w))


def _latest(rows: DataFrame) -> DataFrame:
    """One change a customer, written, of those that are not from before what is stored."""
    return kept(incremental.latest_versions(rows.filter(F.col("version") > 0), "customer_id", "version"), "latest")


def upserted(w: Warehouse) -> DataFrame:
    after = incremental.upsert(before_batch(w), batch(w))
    return after.select("customer_id", "city", "cltv", "version")


def deleted(w: Warehouse) -> DataFrame:
    after = incremental.upsert(before_batch(w), batch_with_deletes(w))
    return after.select("customer_id", "city", "cltv", "version")


def changes_made(w: Warehouse) -> DataFrame:
    latest = kept(incremental.latest_versions(batch_with_deletes(w), "customer_id", "version"), "latest")
    return incremental.change_feed(before_batch(w), latest, "customer_id", "version")


def _dimension_after(w: Warehouse, changes: DataFrame) -> DataFrame:
    """The stored dimension of the earlier customers, brought up to date with a batch."""
    dim_customer = kept(gold.build_dim_customer(before_batch(w)), "dim")
    after = incremental.upsert_dim_customer(dim_customer, _latest(changes))
    return after.select("CustomerKey", "CustomerID", "City")


def _star_after(w: Warehouse, changes: DataFrame) -> dict[str, DataFrame]:
    """Star tables of the earlier customers, stored, then brought up to date with a batch."""
    before = before_batch(w)
    customers, contracts = kept(gold.build_dim_customer(before), "customers"), kept(gold.build_dim_contract(before), "contracts")
    keyed = kept(gold.key_subscribers(before, customers), "keyed")
    facts = kept(gold.build_fact_churn(keyed, contracts), "facts")
    bridge = kept(gold.build_fact_customer_service(keyed, w["dim_service"]), "bridge")

    changed = _latest(changes)
    gone = kept(incremental.deleted_keys(changed, customers), "gone")
    customers = kept(incremental.upsert_dim_customer(customers, changed), "customers")
    contracts = kept(incremental.upsert_dim_contract(contracts, changed), "contracts")
    arrived = kept(incremental.keyed_changes(changed, customers), "arrived")
    return {
        "customers": customers,
        "contracts": contracts,
        "facts_before": facts,
        "facts": incremental.upsert_fact_churn(facts, arrived, contracts, gone),
        "bridge": incremental.upsert_bridge(bridge, arrived, w["dim_service"], gone),
    }


def _facts_after(w: Warehouse, changes: DataFrame) -> DataFrame:
    """Facts after a batch by their natural keys, and whether a key is the one from before."""
    star = _star_after(w, changes)
    earlier = star["facts_before"].select("CustomerKey", F.col("ChurnKey").alias("_before"))
    facts = star["facts"].join(earlier, "CustomerKey", "left").join(star["customers"], "CustomerKey")
    facts = facts.join(star["contracts"], "ContractKey")
    same = (F.col("_before").isNull() | (F.col("_before") == F.col("ChurnKey"))).alias("key_kept")
    return facts.select("CustomerID", "City", *schemas.CONTRACT_ATTRIBUTES, "TenureMonths", "CLTV", "ChurnLabel", same)


def _bridge_after(w: Warehouse, changes: DataFrame) -> DataFrame:
    star = _star_after(w, changes)
    return star["bridge"].join(star["customers"], "CustomerKey").select("CustomerID", "ServiceKey")


_STREAMS: dict[tuple, str] = {}


def _streamed(w: Warehouse, later: DataFrame) -> str:
    """Where a stream has taken in the earlier customers and the batch, twice; kept until scratch folders are cleared."""
    place = (w.spark.sparkContext.applicationId, w.root, "operation" in later.columns)
    if place in _STREAMS and refresh.current_version(w.spark, _STREAMS[place]) is not None:
        return _STREAMS[place]
    root = _STREAMS[place] = scratch(w.spark, "stream")
    before = before_batch(w)
    if "operation" in later.columns:
        before = before.withColumn("operation", F.lit("upsert"))
    later = later.select(*before.columns)
    for rows in (before, later, later):
        # Each drop of files is taken in by its own run; the last one is the same batch again.
        rows.write.mode("append").parquet(f"{root}/arriving")
        refresh.refresh_stream(w.spark, f"{root}/arriving", before.schema, root).awaitTermination()
    return root


def _streamed_rows(w: Warehouse, later: DataFrame) -> DataFrame:
    return refresh.read_current(w.spark, _streamed(w, later)).select("customer_id", "city", "cltv", "version")


def streamed_gold(w: Warehouse) -> DataFrame:
    """The wide model the stream has arrived at."""
    rows = refresh.read_model(w.spark, _streamed(w, batch(w)))
    return rows.select("CustomerID", "City", *schemas.CONTRACT_ATTRIBUTES, "CLTV", "ChurnLabel", "ServiceMask")


def _streamed_kpis(w: Warehouse, later: DataFrame) -> DataFrame:
    return refresh.read_kpis(w.spark, _streamed(w, later)).select("batch", "total", "churners", "avg_cltv")


def _streamed_page(w: Warehouse, page: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A page over the cells that the stream keeps, after deletes."""
    return page(refresh.read_cells(w.spark, _streamed(w, batch_with_deletes(w))))


def streamed_changes(w: Warehouse) -> DataFrame:
    return refresh.read_changes(w.spark, _streamed(w, batch_with_deletes(w)))


def _on_layer(layer: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    return lambda w: build(w[layer])


def _feed(build: Callable[[DataFrame], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    return _on_layer("feed", build)


def _model(build: Callable[[DataFrame], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    return _on_layer("model", build)


def _column(layer: str, key: str, name: str, derived: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w[layer].selectExpr(key, f"{derived} AS {name}")


QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "b1_read_raw": read_raw,
    "b1_read_raw_cells": read_raw_cells,
    "b1_ragged_rows": lambda w: _ragged(w)[0],
    "b1_ragged_rejects": lambda w: _ragged(w)[1].select("record"),
    "b2_snake_headers": lambda w: landing.snake_headers(raw_headers(w["bronze"])),
    "b3_width_profile": _on_layer("bronze", landing.width_profile),
    "b4_stringify": stringified,
    "b5_bulk_write": bulk_write,
    "b6_landing_check": _on_layer("bronze", landing.landing_check),
    "x1_feed": _on_layer("silver", feeds.build_feed),
    "x2_feed_flags": lambda w: feeds.build_feed(w["silver"]).select("id", "senior", "partner", "dep", "phone", "paper"),
    "x3_one_line_text": one_line_text,
    "x4_feed_sink": feed_sink,
    "s1_trim": lambda w: _typed(w, *_TEXT, "churn_reason"),
    "s2_flags": lambda w: _typed(w, *schemas.FLAG_COLUMNS),
    "s3_integers": lambda w: _typed(w, "count", "tenure_months", "churn_value", "churn_score", "cltv"),
    "s4_decimals": lambda w: _typed(w, "latitude", "longitude", "monthly_charges"),
    "s5_blank_total": lambda w: _typed(w, "total_charges"),
    "s6_blank_reason": lambda w: _typed(w, "churn_reason"),
    "s7_audit_stamp": _on_layer("silver", lambda s: s.agg(F.count("dwh_create_date").alias("stamped"))),
    "s8_silver": lambda w: silver.build_silver(w["bronze"], stamp=False),
    "s9_full_reload": silver_reload,
    "s10_load_if_empty": silver_if_empty,
    "s11_load_profile": _on_layer("silver", silver.load_profile),
    "s12_missing_ids": _on_layer("silver", checks.missing_ids),
    "s13_too_wide": _on_layer("silver", checks.too_wide),
    "g1_dense_key": keyed_distinct,
    "g1_dense_key_copies": keyed_copies,
    "g2_dim_customer": _on_layer("silver", gold.build_dim_customer),
    "g3_dim_contract": _on_layer("silver", gold.build_dim_contract),
    "g4_dim_service": lambda w: gold.build_dim_service(w.spark).join(
        F.broadcast(w["fact_customer_service"].groupBy("ServiceKey").agg(F.count(F.lit(1)).alias("subscriptions"))),
        "ServiceKey",
    ),
    "g5_unpivot_services": _on_layer("silver", lambda s: gold.unpivot_services(s, "customer_id")),
    "g6_fact_customer_service": lambda w: gold.build_fact_customer_service(w["keyed"], w["dim_service"]),
    "g7_fact_churn": lambda w: gold.build_fact_churn(w["keyed"], w["dim_contract"]),
    "g8_full_reload": full_reload,
    "g8_changed_reload": changed_reload,
    "g9_facts_reload": facts_reload,
    "v1_layer_counts": lambda w: checks.layer_counts(tables(w, COUNTED_LAYERS)),
    "v2_wide_counts": lambda w: checks.wide_counts(tables(w, STAR)),
    "v4_churn_sanity": _on_layer("fact_churn", checks.churn_sanity),
    "v5_duplicate_keys": lambda w: checks.duplicate_keys(tables(w, STAR), profiles=checks.Profiles(tables(w, STAR), w["profile"])),
    "v6_orphan_rows": lambda w: checks.orphan_rows(tables(w, STAR)),
    "v7_missing_values": lambda w: checks.missing_values(tables(w, STAR)),
    "v7_contract_gaps": _on_layer("silver", checks.contract_gaps),
    "v7_load_loss": lambda w: checks.load_loss(w["silver"], w["fact_churn"], w["dim_customer"]),
    "v8_reconcile": lambda w: checks.reconcile(
        checks.layer_counts(tables(w, COUNTED_LAYERS)), checks.expected_counts(w["bronze"], w["silver"])
    ),
    "d1_internet_tier": _column("feed", "id", "tier", derive.internet_tier("internet")),
    "d2_is_subscribed": service_flags,
    "d3_tenure_band": _column("feed", "id", "band", derive.tenure_band("tenure")),
    "d4_score_band": _column("feed", "id", "band", derive.score_band("score")),
    "d5_tenure_bucket": _on_layer(
        "fact_churn", lambda f: gold.with_derived(f).select("ChurnKey", "TenureBucket", "TenureBucketOrder")
    ),
    "d6_risk_band": _on_layer(
        "fact_churn", lambda f: gold.with_derived(f).select("ChurnKey", "ScoreBand", "ScoreBandOrder")
    ),
    "d7_addon_count": lambda w: gold.with_addon_count(
        w["dim_customer"], w["fact_customer_service"], w["dim_service"]
    ).select("CustomerKey", "addon_count"),
    "d8_service_category": service_categories,
    "d9_rate_status": city_status,
    "d10_score_status": _column("fact_churn", "ChurnKey", "status", derive.score_status("ChurnScore")),
    "d11_dot_level": _feed(
        lambda r: charts.zip_centroids(r).selectExpr("zip", f"{derive.dot_level('rate')} AS level")
    ),
    "d12_bubble_radius": _feed(lambda r: charts.zip_map(r).select("zip", "n", "radius")),
    "d13_payment_label": _column("feed", "id", "label", derive.short_payment("pay")),
    "f1_cross_filter": _feed(lambda r: filters.apply_filters(r, FEED_FILTER).select("id", "churn", "monthly")),
    "f2_filter_without": _feed(
        lambda r: filters.apply_filters(r, FEED_FILTER, without="contract").select("id", "contract")
    ),
    "f3_facets": _feed(lambda r: filters.facet_counts(r, FACET_FILTER)),
    "f3_facets_open": _feed(lambda r: filters.facet_counts(r, {"churn": "Churned", "internet": "No"})),
    "f4_bridge_filter": bridge_filter,
    "f4_model_filter": model_filter,
    "f5_threshold_sweep": _model(filters.threshold_sweep),
    "f6_segments": _feed(lambda r: filters.segment_kpis(r, saved_segments(r.sparkSession))),
    "f7_drill_through": _feed(lambda r: kpis.overview_by(r, "city", "zip")),
    "f8_regional_rows": regional_rows,
    "f8_executive_rows": executive_rows,
    "f8_rows_by_user": rows_by_user,
    "f8_access_summary": lambda w: filters.access_summary(w["model"], entitlements(w.spark)),
    "f9_minimum_base": sized_cities,
    "k1_overview": _feed(kpis.kpi_overview),
    "k2_churn": _feed(kpis.kpi_churn),
    "k3_services": _feed(kpis.kpi_services),
    "k4_revenue": _feed(kpis.kpi_revenue),
    "k5_geography": _feed(kpis.kpi_geography),
    "k1_overview_filtered": _feed(lambda r: kpis.kpi_overview(filters.apply_filters(r, FEED_FILTER))),
    "k2_churn_filtered": _feed(lambda r: kpis.kpi_churn(filters.apply_filters(r, FEED_FILTER))),
    "k3_services_filtered": _feed(lambda r: kpis.kpi_services(filters.apply_filters(r, FEED_FILTER))),
    "k4_revenue_filtered": _feed(lambda r: kpis.kpi_revenue(filters.apply_filters(r, FEED_FILTER))),
    "k5_geography_filtered": _feed(lambda r: kpis.kpi_geography(filters.apply_filters(r, FEED_FILTER))),
    "c1_contract": _feed(charts.by_contract),
    "c2_tenure": _feed(charts.by_tenure),
    "c3_payment": _feed(charts.by_payment),
    "c4_monthly_by_tenure": _feed(charts.monthly_by_tenure),
    "c5_churn_status": _feed(charts.churn_status),
    "c6_internet_mix": _feed(charts.internet_mix),
    "c7_top_reasons": _feed(charts.top_reasons),
    "c8_score_histogram": _feed(charts.score_histogram),
    "c9_service_adoption": _feed(charts.service_adoption),
    "c10_service_churn": _feed(charts.service_churn),
    "c11_category_subscriptions": _feed(charts.category_subscriptions),
    "c12_addons_by_contract": _feed(charts.addons_by_contract),
    "c13_revenue_by_contract": _feed(charts.revenue_by_contract),
    "c14_cltv_by_tenure": _feed(charts.cltv_by_tenure),
    "c15_trajectory": _feed(charts.trajectory),
    "c16_payment_mix": _feed(charts.payment_mix),
    "c17_zip_map": _feed(charts.zip_map),
    "c18_map_bounds": _feed(charts.map_bounds),
    "c19_top_cities": _feed(charts.top_cities),
    "c20_top_zips": _feed(charts.top_zips),
    "c21_group_sum": _feed(lambda r: charts.group_sum(r, "state", "monthly", "state")),
    "p0a_overview_cards": _model(visuals.overview_cards),
    "p0b_churn_cards": _model(visuals.churn_cards),
    "p0c_services_cards": _model(visuals.services_cards),
    "p0d_revenue_cards": _model(visuals.revenue_cards),
    "p0e_geography_cards": _model(visuals.geography_cards),
    "p1_churned_vs_active": _model(visuals.churned_vs_active),
    "p2_customers_by_contract": _model(visuals.customers_by_contract),
    "p3_churn_by_contract": _model(visuals.churn_by_contract),
    "p4_tenure_buckets": _model(visuals.tenure_buckets),
    "p5_top_reasons": _model(visuals.top_reasons),
    "p6_score_bands": _model(visuals.score_bands),
    "p7_revenue_by_payment": _model(visuals.revenue_by_payment),
    "p8_contract_rates": _model(visuals.contract_rates),
    "p9_tenure_churn": _model(visuals.tenure_churn),
    "p10_demographics": _model(visuals.demographics),
    "p11_payment_by_paperless": _model(visuals.payment_by_paperless),
    "p12_decomposition": _model(visuals.decomposition),
    "p13_reasons_by_contract": _model(visuals.reasons_by_contract),
    "p14_churn_by_service": _model(visuals.churn_by_service),
    "p15_churn_by_category": _model(visuals.churn_by_category),
    "p16_service_adoption": _model(visuals.service_adoption),
    "p17_service_contract_matrix": _model(visuals.service_contract_matrix),
    "p18_addon_distribution": _model(visuals.addon_distribution),
    "p19_adoption_vs_churn": _model(visuals.adoption_vs_churn),
    "p20_revenue_by_contract": _model(visuals.revenue_by_contract),
    "p21_revenue_share_by_payment": _model(visuals.revenue_share_by_payment),
    "p22_cltv_by_contract": _model(visuals.cltv_by_contract),
    "p23_risk_by_reason": _model(visuals.risk_by_reason),
    "p24_score_vs_cltv": _model(visuals.score_vs_cltv),
    "p25_top_zips_by_revenue": _model(visuals.top_zips_by_revenue),
    "p26_map_points": _model(visuals.map_points),
    "p26_map_states": _model(visuals.map_states),
    "p27_city_table": _model(visuals.city_table),
    "p28_top_cities_by_churned": _model(visuals.top_cities_by_churned),
    "p29_top_zips_by_rate": _model(visuals.top_zips_by_rate),
    "p30_city_quadrant": _model(visuals.city_quadrant),
    "p31_tooltip_contract": _model(lambda m: visuals.tooltip(m, "ContractType")),
    "p31_tooltip_service": _model(lambda m: visuals.tooltip(m, "ServiceName")),
    "p31_tooltip_reason": _model(lambda m: visuals.tooltip(m, "ChurnReason")),
    "q1_tag_intents": tagged_questions,
    "q2_answer_questions": answered_questions,
    "q3_suggested_questions": answered_suggestions,
    "r1_upsert": upserted,
    "r1_upsert_dimension": lambda w: _dimension_after(w, batch(w)),
    "r1_upsert_facts": lambda w: _facts_after(w, batch(w)),
    "r1_upsert_bridge": lambda w: _bridge_after(w, batch(w)),
    "r1_delete": deleted,
    "r1_delete_dimension": lambda w: _dimension_after(w, batch_with_deletes(w)),
    "r1_delete_facts": lambda w: _facts_after(w, batch_with_deletes(w)),
    "r1_delete_bridge": lambda w: _bridge_after(w, batch_with_deletes(w)),
    "r1_changes": changes_made,
    "r2_stream_gold": streamed_gold,
    "r2_stream_upsert": lambda w: _streamed_rows(w, batch(w)),
    "r2_stream_kpis": lambda w: _streamed_kpis(w, batch(w)),
    "r2_stream_delete": lambda w: _streamed_rows(w, batch_with_deletes(w)),
    "r2_stream_delete_kpis": lambda w: _streamed_kpis(w, batch_with_deletes(w)),
    "r2_stream_changes": streamed_changes,
    "r2_stream_churn_page": lambda w: _streamed_page(w, cells.kpi_churn),
    "r2_stream_services_page": lambda w: _streamed_page(w, lambda c: cells.kpi_services(c, FEED_FILTER)),
    "r2_stream_facets": lambda w: _streamed_page(w, lambda c: cells.facet_counts(c, FACET_FILTER)),
}

# The grouping each measure is registered under, by report page.
MEASURE_GROUPING = {
    "overview": ["ContractType"],
    "revenue": ["PaymentMethod"],
    "churn": ["ContractType", "Gender"],
    "services": ["ServiceName"],
    "geography": ["State"],
}


def _measure(name: str, by: list[str]) -> Callable[[Warehouse], DataFrame]:
    return _model(lambda m: evaluate(m, [name], by))


def measure_grouping(name: str, folder: str) -> list[str]:
    return ["ContractType"] if name.endswith("_retention_service") else MEASURE_GROUPING[folder]


_position = 0
for _folder, _names in FOLDERS.items():
    for _name in _names:
        _position += 1
        QUERIES[f"m{_position}_{_name}"] = _measure(_name, measure_grouping(_name, _folder))
# Contexts that name services in every way: all of them, none, and one of a group's own.
QUERIES["m_retention_all_services"] = _model(
    lambda m: evaluate(m, RETENTION, spec={"ServiceCategory": "All", "ServiceName": ["All"]})
)
QUERIES["m_retention_by_service"] = _model(lambda m: evaluate(m, RETENTION, ["ServiceName"]))
QUERIES["m_retention_by_category"] = _model(lambda m: evaluate(m, [*RETENTION, "service_customers"], ["ServiceCategory"]))
QUERIES["m_no_services"] = _model(lambda m: evaluate(m, ["service_customers"], ["ServiceName"], {"ServiceCategory": []}))
QUERIES["m_all_total"] = _model(lambda m: evaluate(m, MEASURES))
QUERIES["m_all_by_state_filtered"] = _model(lambda m: evaluate(m, MEASURES, ["State"], MODEL_FILTER, threshold=60))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(QUERIES[name](open_warehouse(spark, sf_dir)))
