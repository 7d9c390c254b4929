import os

import frames
import pytest
from pyspark.sql import functions as F

from attrition.operators import checks, filters, gold, incremental
from attrition.plans import kpis
from attrition.sources.feed import build_feed
from attrition.streaming import cells, refresh


def versions(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, version int, city string")


def state(df):
    return {r.customer_id: (r.version, r.city) for r in df.collect()}


def test_upsert_inserts_updates_and_ignores_stale(spark):
    now = versions(spark, [("a", 1, "A"), ("b", 5, "B"), ("c", 1, "C")])
    batch = versions(spark, [("b", 4, "old"), ("c", 2, "C2"), ("c", 3, "C3"), ("d", 1, "D")])
    after = incremental.upsert(now, batch)
    assert state(after) == {"a": (1, "A"), "b": (5, "B"), "c": (3, "C3"), "d": (1, "D")}
    assert after.count() == 4
    assert state(incremental.upsert(after, batch)) == state(after)


def test_upsert_of_everything_equals_a_full_reload(spark):
    rows = versions(spark, [(f"c{i}", 1, f"city{i % 3}") for i in range(50)])
    assert state(incremental.upsert(rows.limit(0), rows)) == state(rows)


def test_hot_key_with_many_versions(spark):
    batch = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.col("id").cast("int").alias("version"),
        F.lit("x").alias("city"),
    )
    after = incremental.upsert(versions(spark, [("hot", 5, "old")]), batch)
    assert after.count() == 2001 and state(after)["hot"] == (999, "x")


def test_dimension_keys_stay_and_continue(spark):
    before = frames.silver(spark, frames.ids([dict(city="A"), dict(city="B"), dict(city="C")]))
    dim = gold.build_dim_customer(before).cache()
    old = frames.pairs(dim, "CustomerID", "CustomerKey")
    changed = frames.silver(spark, [dict(customer_id="S1", city="Moved"), dict(customer_id="N1"), dict(customer_id="N2")])
    after = incremental.upsert_dim_customer(dim, changed)
    new = frames.pairs(after, "CustomerID", "CustomerKey")
    assert {k: new[k] for k in old} == old and {new["N1"], new["N2"]} == {4, 5}
    assert frames.pairs(after, "CustomerID", "City")["S1"] == "Moved"


def streamed(spark, rows, version):
    return frames.silver(spark, rows).withColumn("version", F.lit(version))


def run(spark, root, df):
    df.write.mode("append").parquet(f"{root}/arriving")
    refresh.refresh_stream(spark, f"{root}/arriving", df.schema, root).awaitTermination()


def test_stream(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        refresh.read_current(spark, root)
    run(spark, root, streamed(spark, frames.ids([{}, {}]), 1))
    run(spark, root, streamed(spark, [dict(customer_id="S1", city="Moved"), dict(customer_id="S9")], 2))
    run(spark, root, streamed(spark, [dict(customer_id="S1", city="Stale")], 1))
    rows = {r.customer_id: r.city for r in refresh.read_current(spark, root).collect()}
    assert rows == {"S0": "Town", "S1": "Moved", "S9": "Town"}
    assert frames.pairs(refresh.read_kpis(spark, root), "batch", "total") == {0: 2, 1: 3, 2: 3}
    # A batch that runs again starts from the state before it.
    again = streamed(spark, [dict(customer_id="S9", city="Again")], 3)
    refresh.apply_batch(again, 2, root, "customer_id", "version")
    rows = {r.customer_id: r.city for r in refresh.read_current(spark, root).collect()}
    assert rows == {"S0": "Town", "S1": "Moved", "S9": "Again"}


def files(root, folder):
    return {str(p): p.stat().st_mtime_ns for p in root.glob(f"{folder}/**/*.parquet")}


def test_stream_reaches_gold_and_leaves_buckets_alone(spark, tmp_path):
    root = str(tmp_path)
    run(spark, root, streamed(spark, frames.ids([{} for _ in range(40)]), 1))
    before = files(tmp_path, "state")
    keys = frames.pairs(refresh.read_gold(spark, root)["dim_customer"], "CustomerID", "CustomerKey")
    assert before and sorted(keys.values()) == list(range(1, 41))
    run(spark, root, streamed(spark, [dict(customer_id="S3", contract="Two year", tech_support="Yes")], 2))
    run(spark, root, streamed(spark, [dict(customer_id="N1")], 2))
    assert files(tmp_path, "state") == before
    star = refresh.read_gold(spark, root)
    now = frames.pairs(star["dim_customer"], "CustomerID", "CustomerKey")
    assert now == keys | {"N1": 41}
    checks.verify("fact_churn", star)
    checks.verify("fact_customer_service", star)
    row = frames.one(refresh.read_model(spark, root).filter("CustomerID = 'S3'"))
    assert row["ContractType"] == "Two year" and row["ServiceMask"] >> 6 & 1
    assert frames.pairs(refresh.read_kpis(spark, root), "batch", "total") == {0: 40, 1: 40, 2: 41}


def customers(spark, first, last, version, **columns):
    """Many customers alike but for their ids."""
    one = frames.silver(spark, [columns]).drop("customer_id").withColumn("version", F.lit(version))
    return spark.range(first, last).selectExpr("concat('S', id) AS customer_id").join(F.broadcast(one))


def test_a_small_batch_over_a_large_state_writes_little_and_splits_keep_keys(spark, tmp_path):
    root = str(tmp_path)

    def apply(df, batch_id):
        refresh.apply_batch(df, batch_id, root, "customer_id", "version", bucket_rows=10_000)

    def keys():
        return frames.pairs(refresh.read_gold(spark, root)["dim_customer"], "CustomerID", "CustomerKey")

    apply(customers(spark, 0, 100_000, 1), 0)
    ledger = refresh.read_ledger(spark, root, 0)
    assert len(ledger.buckets) == 10 and sum(b.rows for b in ledger.buckets) == 100_000 and not ledger.deltas
    before, first = files(tmp_path, "state"), keys()
    apply(customers(spark, 0, 100_000, 2, city="Moved").filter("pmod(xxhash64(customer_id), 200) = 0"), 1)
    changed = spark.read.parquet(f"{root}/delta/batch=1").count()
    assert 400 < changed < 600 and files(tmp_path, "state") == before
    assert refresh.read_current(spark, root).filter("city = 'Moved'").count() == changed and keys() == first
    # The state grows: buckets split one after the other, and only those are rewritten.
    apply(customers(spark, 100_000, 125_000, 1), 2)
    ledger = refresh.read_ledger(spark, root, 2)
    assert len(ledger.buckets) == 13 and {ledger.buckets[i].holder for i in (2, 3, 4, 10, 11, 12)} == {2}
    after = keys()
    assert {c: after[c] for c in first} == first and sorted(after.values()) == list(range(1, 125_001))
    assert refresh.read_current(spark, root).filter("city = 'Moved'").count() == changed
    apply(customers(spark, 125_000, 135_000, 1), 3)
    ledger = refresh.read_ledger(spark, root, 3)
    assert len(ledger.buckets) == 14 and {ledger.buckets[i].holder for i in (5, 13)} == {3}
    assert all(b.pending < 0.25 * b.rows for b in ledger.buckets) and any(b.holder != 3 for b in ledger.buckets)
    after = keys()
    assert {c: after[c] for c in first} == first and sorted(after.values()) == list(range(1, 135_001))
    assert frames.pairs(refresh.read_kpis(spark, root), "batch", "total") == {0: 100_000, 1: 100_000, 2: 125_000, 3: 135_000}


def test_buckets_split_in_order(spark):
    ids = [f"c{i}" for i in range(500)]
    rows = spark.createDataFrame([(c,) for c in ids], "id string")
    held = {n: frames.pairs(rows.selectExpr("id", f"{refresh.bucket_of('id', n)} AS b"), "id", "b") for n in range(1, 12)}
    for n in range(1, 11):
        assert set(held[n].values()) <= set(range(n))
        assert all(held[n + 1][c] == held[n][c] or (held[n + 1][c] == n and held[n][c] == refresh.origin(n, n)) for c in ids)


def gone(spark, rows, version):
    return streamed(spark, rows, version).withColumn("operation", F.lit("delete"))


def put(spark, rows, version):
    return streamed(spark, rows, version).withColumn("operation", F.lit(None).cast("string"))


def test_deletes_reach_the_star_and_stay_deleted(spark, tmp_path):
    root = str(tmp_path)

    def apply(df, batch_id):
        refresh.apply_batch(df, batch_id, root, "customer_id", "version")

    apply(put(spark, frames.ids([frames.gone(city=f"C{i}") if i % 2 else dict(city=f"C{i}") for i in range(9)]), 1), 0)
    apply(put(spark, [dict(customer_id="S2", city="New")], 3).unionByName(gone(spark, [dict(customer_id="S4"), dict(customer_id="X")], 2)), 1)
    star = refresh.read_gold(spark, root)
    now = frames.pairs(star["dim_customer"], "CustomerID", "CustomerKey")
    assert set(now) == {f"S{i}" for i in range(9)} - {"S4"}
    for layer in star:
        checks.verify(layer, star)
    rest = [dict(city="New") if i == 2 else frames.gone(city=f"C{i}") if i % 2 else dict(city=f"C{i}") for i in range(9)]
    reloaded = frames.star(spark, [r for i, r in enumerate(frames.ids(rest)) if i != 4])
    same = ["CustomerID", "City", "ContractType", "ChurnLabel", "MonthlyCharges", "ServiceMask"]
    assert sorted(refresh.read_model(spark, root).select(same).collect()) == sorted(reloaded["model"].select(same).collect())
    # From before the delete: refused, also where the customer was never there. Later: back under the old key.
    apply(put(spark, [dict(customer_id="S4"), dict(customer_id="X")], 1), 2)
    assert set(frames.pairs(refresh.read_gold(spark, root)["dim_customer"], "CustomerID", "City")) == set(now)
    apply(put(spark, [dict(customer_id="S4", city="Back")], 5), 3)
    back = refresh.read_gold(spark, root)["dim_customer"]
    assert frames.pairs(back, "CustomerID", "CustomerKey").keys() == set(now) | {"S4"} and frames.pairs(back, "CustomerID", "City")["S4"] == "Back"
    assert set(frames.pairs(back, "CustomerKey", "CustomerID")) == set(range(1, 10))
    told = sorted((r.batch, r.customer_id, r.change, r.version_before, r.version_after) for r in refresh.read_changes(spark, root).collect() if r.batch)
    assert told == [(1, "S2", "update", 1, 3), (1, "S4", "delete", 1, 2), (3, "S4", "insert", None, 5)]
    kpis = {r.batch: (r.total, r.churners) for r in refresh.read_kpis(spark, root).collect()}
    assert kpis == {0: (9, 4), 1: (8, 4), 2: (8, 4), 3: (9, 4)}


def test_pages_over_cells_equal_a_recomputation_after_every_batch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(refresh, "CELL_FILES", 2)
    some = [
        frames.gone(churn_reason=None, city=None, tech_support="Yes"),
        frames.gone(churn_reason="Price", contract="Two year", internet_service="No"),
        dict(total_charges="", churn_score="90", streaming_tv="Yes", state="", zip_code=None),
        dict(gender="Female", monthly_charges="x", tenure_months="30", online_security="Yes"),
        dict(payment_method="Electronic check", contract="One year", cltv="7", phone_service="No"),
    ]
    batches = [
        put(spark, frames.ids(some * 3), 1),
        put(spark, [dict(customer_id="S0", city="Moved"), dict(customer_id="N", gender="Female")], 2).unionByName(gone(spark, [dict(customer_id="S1")], 2)),
        put(spark, [frames.gone(customer_id="S2", churn_reason="Price"), dict(customer_id="S1", contract="Two year")], 3),
        gone(spark, [dict(customer_id=f"S{i}") for i in range(5, 12)], 9),
    ]
    male = {"gender": "Male", "tenure": "0-6", "churn": "All"}

    def rows(df):
        return sorted(tuple(map(str, r)) for r in df.collect())

    for i, batch in enumerate(batches):
        refresh.apply_batch(batch, i, root, "customer_id", "version")
        if i not in (1, 3):
            continue
        feed, held = build_feed(refresh.read_current(spark, root).drop("version")).cache(), refresh.read_cells(spark, root).cache()
        for spec in ({}, male) if i == 3 else ({},):
            for name in ("overview", "churn", "services", "revenue"):
                want = getattr(kpis, f"kpi_{name}")(filters.apply_filters(feed, spec))
                assert rows(getattr(cells, f"kpi_{name}")(held, spec)) == rows(want), (i, name)
            assert rows(cells.facet_counts(held, spec)) == rows(filters.facet_counts(feed, spec))
        assert rows(cells.kpi_geography(held, base=1)) == rows(kpis.kpi_geography(feed, base=1))
        if i == 1:  # a batch writes the cells and places its customers were or are in
            assert spark.read.parquet(f"{root}/cells/batch=1").filter("kind = 'cell'").count() <= 5
    assert len(refresh.read_ledger(spark, root, 3).cells) <= 3


def test_a_delete_comes_after_changes_of_its_version(spark):
    now = versions(spark, [("a", 1, "A"), ("b", 1, "B"), ("c", 9, "C")])
    rows = [("a", 2, "zzz", None), ("a", 2, "aaa", "delete"), ("b", 2, "B2", "Upsert"), ("c", 3, "", " DELETE "), ("d", 1, "D", "delete")]
    batch = spark.createDataFrame(rows, "customer_id string, version int, city string, operation string")
    assert state(incremental.upsert(now, batch)) == {"b": (2, "B2"), "c": (9, "C")}
    latest = incremental.latest_versions(batch, "customer_id", "version")
    told = sorted(map(tuple, incremental.change_feed(now, latest, "customer_id", "version").collect()))
    assert told == [("a", "delete", 1, 2), ("b", "update", 1, 2)]


def test_files_stay_few_over_many_batches(spark, tmp_path, monkeypatch):
    root, n = str(tmp_path), int(os.environ.get("TEST_BATCHES", "7"))
    monkeypatch.setattr(refresh, "HISTORY", 2)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        refresh.apply_batch(customers(spark, 0, 2_000, 1), 0, root, "customer_id", "version", bucket_rows=500)
        for i in range(1, n + 1):
            batch = customers(spark, i * 30, i * 30 + 20, i + 1, city=f"C{i}")
            refresh.apply_batch(batch, i, root, "customer_id", "version", bucket_rows=500)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    count = {folder: len(list(tmp_path.glob(f"{folder}/*"))) for folder in ("ledger", "kpi", "kpi-history", "delta", "latest", "moves", "contracts", "cells")}
    assert count["ledger"] <= 3 and count["kpi"] <= 2 * refresh.HISTORY + 3 and count["kpi-history"] <= 3
    assert count["delta"] <= 8 and count["cells"] <= refresh.CELL_FILES + 3 and max(count[f] for f in ("latest", "moves", "contracts")) <= 3
    assert len(refresh.read_ledger(spark, root, n).deltas) <= 4
    cities = frames.pairs(refresh.read_current(spark, root).groupBy("city").count(), "city", "count")
    assert cities == {"Town": 2000 - 20 * n} | {f"C{i}": 20 for i in range(1, n + 1)}
    kpis = frames.pairs(refresh.read_kpis(spark, root), "batch", "total")
    assert kpis == {i: 2000 for i in range(n + 1)}


def test_a_timed_stream_takes_in_batch_after_batch(spark, tmp_path):
    root = str(tmp_path)
    first = streamed(spark, frames.ids([{}, {}]), 1)
    first.write.mode("append").parquet(f"{root}/arriving")
    query = refresh.refresh_stream(spark, f"{root}/arriving", first.schema, root, every="1 second")
    try:
        query.processAllAvailable()
        streamed(spark, [dict(customer_id="S9")], 1).write.mode("append").parquet(f"{root}/arriving")
        query.processAllAvailable()
        assert frames.pairs(refresh.read_kpis(spark, root), "batch", "total") == {0: 2, 1: 3}
        assert query.lastProgress is not None and query.isActive
    finally:
        query.stop()


def test_facts_and_bridge_of_changed_customers_are_replaced(spark):
    rows = frames.ids([dict(city=f"C{i}") for i in range(6)])
    t = frames.star(spark, rows)
    changed = frames.silver(spark, [dict(customer_id="S2", contract="One year", phone_service="No"), dict(customer_id="N")]).cache()
    customers = incremental.upsert_dim_customer(t["dim_customer"], changed).cache()
    contracts = incremental.upsert_dim_contract(t["dim_contract"], changed).cache()
    keyed = incremental.keyed_changes(changed, customers).cache()
    facts = incremental.upsert_fact_churn(t["fact_churn"], keyed, contracts).cache()
    bridge = incremental.upsert_bridge(t["fact_customer_service"], keyed, t["dim_service"]).cache()
    after = {"dim_customer": customers, "dim_contract": contracts, "dim_service": t["dim_service"]}
    after |= {"fact_churn": facts, "fact_customer_service": bridge}
    for layer in after:
        checks.verify(layer, after)
    old, new = (frames.pairs(f, "CustomerKey", "ChurnKey") for f in (t["fact_churn"], facts))
    assert {c: new[c] for c in old} == old and len(new) == 7 and max(new.values()) == 7
    merged = [r for r in rows if r["customer_id"] != "S2"]
    merged += [dict(customer_id="S2", contract="One year", phone_service="No"), dict(customer_id="N")]
    again = frames.star(spark, merged)

    def seen(star):
        held = star["fact_customer_service"].join(star["dim_customer"], "CustomerKey").select("CustomerID", "ServiceKey")
        told = star["fact_churn"].join(star["dim_customer"], "CustomerKey").join(star["dim_contract"], "ContractKey")
        return sorted(held.collect()), sorted(map(str, told.drop("ChurnKey", "CustomerKey", "ContractKey").collect()))

    assert seen(after) == seen(again)


def test_deleted_customers_leave_dimension_facts_and_bridge(spark):
    rows = frames.ids([dict(city=f"C{i}") for i in range(6)])
    t = frames.star(spark, rows)
    changed = frames.silver(spark, [dict(customer_id=c, city="New") for c in ("S1", "S4", "N", "X")])
    changed = changed.withColumn("operation", F.expr("CASE WHEN customer_id IN ('S4', 'X') THEN 'delete' END")).cache()
    left = incremental.deleted_keys(changed, t["dim_customer"]).cache()
    dim = incremental.upsert_dim_customer(t["dim_customer"], changed).cache()
    contracts = incremental.upsert_dim_contract(t["dim_contract"], changed).cache()
    keyed = incremental.keyed_changes(changed, dim).cache()
    after = {"dim_customer": dim, "dim_contract": contracts, "dim_service": t["dim_service"]}
    after["fact_churn"] = incremental.upsert_fact_churn(t["fact_churn"], keyed, contracts, left).cache()
    after["fact_customer_service"] = incremental.upsert_bridge(t["fact_customer_service"], keyed, t["dim_service"], left).cache()
    for layer in after:
        checks.verify(layer, after)
    old, new = (frames.pairs(d, "CustomerID", "CustomerKey") for d in (t["dim_customer"], dim))
    assert new == {c: k for c, k in old.items() if c != "S4"} | {"N": 7}
    held = after["fact_customer_service"].join(dim, "CustomerKey").select("CustomerID", "ServiceKey")
    again = frames.star(spark, [r for r in rows if r["customer_id"] not in ("S1", "S4")] + [dict(customer_id=c, city="New") for c in ("S1", "N")])
    want = again["fact_customer_service"].join(again["dim_customer"], "CustomerKey").select("CustomerID", "ServiceKey")
    assert sorted(held.collect()) == sorted(want.collect()) and after["fact_churn"].count() == 6


def test_equal_versions_are_settled_by_content(spark):
    batch = versions(spark, [("a", 2, "x"), ("a", 2, "y"), ("a", 1, "z"), ("b", None, "n"), (None, 1, "q")])
    got = sorted(map(tuple, incremental.latest_versions(batch, "customer_id", "version").collect()), key=str)
    assert got == [("a", 2, "y"), ("b", None, "n"), (None, 1, "q")]


def test_batch_without_ids_is_refused(spark, tmp_path):
    bad = streamed(spark, [dict(customer_id=None)], 1)
    with pytest.raises(ValueError, match="missing_ids"):
        refresh.apply_batch(bad, 0, str(tmp_path), "customer_id", "version")
    assert refresh.current_version(spark, str(tmp_path)) is None


def test_a_large_bucket_is_rewritten_by_many_tasks_with_dense_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "TASK_ROWS", 20)
    root = str(tmp_path)
    refresh.apply_batch(customers(spark, 0, 600, 1), 0, root, "customer_id", "version")
    assert len(files(tmp_path, "state")) > spark.sparkContext.defaultParallelism
    first = frames.pairs(refresh.read_gold(spark, root)["dim_customer"], "CustomerID", "CustomerKey")
    assert sorted(first.values()) == list(range(1, 601))
    refresh.apply_batch(customers(spark, 300, 900, 2), 1, root, "customer_id", "version")
    second = frames.pairs(refresh.read_gold(spark, root)["dim_customer"], "CustomerID", "CustomerKey")
    assert {k: second[k] for k in first} == first and sorted(second.values()) == list(range(1, 901))
