"""Physical plans of the registered queries, and the shared folder."""

import re

import pyarrow.parquet as pq
import pytest

from attrition import schemas, session
from attrition.operators import checks, incremental
from attrition.operators.keys import with_key
from attrition.plans import registered
from attrition.plans.warehouse import Warehouse, open_warehouse

WRITERS = [n for n in registered.QUERIES if n.startswith(("b1_", "b5_", "x4_", "s9_", "s10_", "g8_", "g9_", "r2_"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registered.QUERIES if n not in WRITERS])
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(registered.run(name, spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


@pytest.fixture
def shuffled(spark):
    """No join is a broadcast by size, as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in registered.QUERIES if n not in WRITERS])
def test_large_plans_have_no_cross_joins_and_few_scans(spark, sf_dir, shuffled, name):
    plan = plan_of(registered.run(name, spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan
    if name.startswith(("k", "c", "d")):
        assert plan.count("FileScan") <= (3 if name.startswith("d") else 1)
    if name in ("c17_zip_map", "c20_top_zips", "d12_bubble_radius"):
        # Names are compared on collapsed rows: the aggregate next to the scan is a hash aggregate.
        assert [x for x in re.findall(r"(\w*Aggregate)\(", plan)][-1] == "HashAggregate"


@pytest.mark.parametrize("name", ["r1_upsert", "r1_upsert_dimension", "r1_delete", "r1_delete_dimension", "r1_changes"])
def test_upserts_read_their_inputs_few_times(spark, sf_dir, shuffled, name):
    plan = plan_of(registered.run(name, spark, sf_dir))
    assert plan.count("FileScan") <= 6 and plan.count("Exchange") <= 12


def test_a_small_batch_does_not_shuffle_the_stored_table(spark, sf_dir):
    # The stored rows are joined with a batch that is small enough to be a broadcast, and with its keys.
    plan = plan_of(registered.run("r1_upsert", spark, sf_dir))
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 0


def test_latest_versions_are_one_aggregate(spark, sf_dir):
    changes = registered.batch(open_warehouse(spark, sf_dir))
    plan = plan_of(incremental.latest_versions(changes, "customer_id", "version"))
    assert plan.count("FileScan") == 4 and plan.count("Exchange") == 1 and "Join" not in plan


def test_key_shuffle_carries_only_the_columns(spark, sf_dir):
    plan = plan_of(registered.run("g2_dim_customer", spark, sf_dir))
    assert "_key" not in " ".join(re.findall(r"Exchange [^\n]*", plan))


def test_access_reads_only_the_listed_states(spark, sf_dir):
    for name in ("f8_regional_rows", "f8_rows_by_user"):
        plan = plan_of(registered.run(name, spark, sf_dir))
        assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning[^\]]*StatePart", plan) or re.search(
            r"PartitionFilters: \[[^\]]*StatePart[^\]]*dynamicpruning", plan
        )


def test_key_checks_shuffle_no_rows(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    star = {name: w[name] for name in registered.STAR}
    profiles = checks.Profiles(star, w["profile"])
    for report in (checks.duplicate_keys(star, profiles=profiles), checks.orphan_rows(star, profiles=profiles)):
        assert "Exchange hashpartitioning" not in plan_of(report)
    plan = plan_of(checks.key_profile(star["fact_churn"], "ChurnKey"))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_bitmap_construct_agg" in plan


def test_keyed_rows_carry_no_column_of_the_dimension(spark, sf_dir):
    keyed = open_warehouse(spark, sf_dir)["keyed"].columns
    assert not set(keyed) & (set(schemas.CUSTOMER_ATTRIBUTES.values()) - {"customer_id"})
    assert len(keyed) == len(set(keyed)) == 2 + len(schemas.SERVICES) + len(schemas.CONTRACT_ATTRIBUTES) + len(schemas.FACT_ATTRIBUTES)


def test_content_is_hashed_once_a_row_unless_its_copies_make_further_runs(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, y int").write.parquet(str(tmp_path / "t"))
    plan = plan_of(with_key(spark.read.parquet(str(tmp_path / "t")), "k"))
    assert all(re.search(r"_run#\d+L? = 0\) THEN _first", line) for line in plan.splitlines() if "md5(" in line and "_run" in line)
    assert re.search(r"Exchange hashpartitioning\(x#\d+, y#\d+, _first#\d+", plan)


def test_a_later_session_takes_over_stored_layers(spark, tmp_path, sf_dir):
    first = Warehouse(spark, sf_dir, str(tmp_path / "w"))
    rows = first["model"].count()
    later = Warehouse(spark, sf_dir, str(tmp_path / "w"))
    assert later["model"].count() == rows and not later.seconds
    later.remove()
    assert not (tmp_path / "w").exists()


def test_scan_reads_only_needed_columns_and_takes_filters(spark, sf_dir):
    plan = registered.run("k1_overview_filtered", spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {
        "gender", "tenure", "internet", "contract", "monthly", "total", "churn", "cltv",
    }
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "EqualTo(contract,Month-to-month)" in pushed and "EqualTo(internet,DSL)" in pushed


def test_typed_layer_and_feed_do_not_shuffle(spark, sf_dir):
    for name in ("s8_silver", "x1_feed", "g5_unpivot_services", "p24_score_vs_cltv"):
        assert "Exchange" not in plan_of(registered.run(name, spark, sf_dir))


def test_warehouse_is_reused_until_an_input_changes(spark, tmp_path, sf_dir):
    import shutil

    for name in ("orders", "lineitem", "customer", "nation", "region"):
        shutil.copyfile(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = open_warehouse(spark, str(tmp_path))
    assert open_warehouse(spark, str(tmp_path)) is first
    table = pq.read_table(f"{sf_dir}/nation.parquet")
    pq.write_table(table.slice(0, table.num_rows - 1), tmp_path / "nation.parquet")
    assert open_warehouse(spark, str(tmp_path)) is not first


class FakeSession:
    """A session on a cluster master, as far as the shared folder looks at it."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession)


def test_scratch_is_removed(spark, sf_dir):
    import os

    registered.run("b5_bulk_write", spark, sf_dir).count()
    root = session.scratch_root(spark)
    assert os.listdir(root)
    registered.clear_scratch(spark)
    assert not os.path.exists(root)


def test_customers_are_shuffled_once(spark, sf_dir):
    from attrition.operators import gold

    plan = plan_of(gold.build_dim_customer(open_warehouse(spark, sf_dir)["silver"]))
    assert "hashpartitioning(_bucket" in plan and "hashpartitioning(CustomerID" not in plan


def test_latest_versions_sort_rows_once_after_the_shuffle(spark, sf_dir):
    changes = registered.batch(open_warehouse(spark, sf_dir))
    assert plan_of(incremental.latest_versions(changes, "customer_id", "version")).count("Sort [") == 1


def test_tasks_take_bounded_shares_unless_told_otherwise(spark, sf_dir):
    spark.conf.unset(session.ADVISORY)
    open_warehouse(spark, sf_dir)
    assert spark.conf.get(session.ADVISORY) == session.TASK_BYTES
    spark.conf.set(session.ADVISORY, "8m")
    open_warehouse(spark, sf_dir)
    assert spark.conf.get(session.ADVISORY) == "8m"
    spark.conf.unset(session.ADVISORY)
