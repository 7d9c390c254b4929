"""Semantic-model measures, visuals, slicers, thresholds and access."""

import frames
import pytest
from frames import gone, ids, model, one, pairs
from pyspark.sql import functions as F

from attrition.operators import filters
from attrition.plans import visuals
from attrition.plans.measures import FOLDERS, MEASURES, evaluate


def test_there_are_37_measures():
    assert len(MEASURES) == len(set(MEASURES)) == 37
    assert [len(names) for names in FOLDERS.values()] == [8, 8, 7, 6, 8]


def test_averages_skip_missing_values(spark):
    m = model(spark, ids([dict(monthly_charges="30", churn_score="x"), dict(monthly_charges="n/a", churn_score="40")]))
    row = one(evaluate(m, ["avg_monthly_charge", "avg_churn_score", "total_customers"]))
    assert row == {"avg_monthly_charge": 30.0, "avg_churn_score": 40.0, "total_customers": 2}


def test_avg_addons_is_over_customers_who_have_some(spark):
    m = model(spark, ids([dict(online_security="Yes", tech_support="Yes"), {}, dict(online_backup="Yes")]))
    assert one(evaluate(m, ["avg_addons"]))["avg_addons"] == 1.5


def test_empty_context(spark):
    m = model(spark, [{}]).limit(0)
    row = one(evaluate(m, MEASURES))
    assert row["churn_rate"] == 0.0 and row["retention_rate"] == 0.0 and row["top_churn_reason_count"] == 0
    assert row["avg_cltv"] is None and row["top_churn_reason"] is None and row["monthly_revenue"] == 0
    assert row["month_to_month_churn_rate"] == 0.0 and row["top_city_churn_rate"] is None


def test_contract_rates_override_the_contract_in_context(spark):
    rows = ids([gone(), {}, gone(contract="One year"), dict(contract="Two year", gender="Female")])
    got = evaluate(model(spark, rows), ["month_to_month_churn_rate", "one_year_churn_rate"], ["ContractType"])
    assert {tuple(r)[1:] for r in got.collect()} == {(0.5, 1.0)}
    one_row = one(evaluate(model(spark, rows), ["month_to_month_churn_rate"], spec={"ContractType": "Two year"}))
    assert one_row["month_to_month_churn_rate"] == 0.5
    by_gender = evaluate(model(spark, rows), ["month_to_month_churn_rate", "churn_rate"], ["Gender", "ContractType"])
    assert pairs(by_gender.filter("Gender = 'Female'"), "ContractType", "month_to_month_churn_rate") == {"Two year": 0.0}


def test_reason_ties_take_the_last_name_and_blank_stays(spark):
    m = model(spark, ids([gone(churn_reason=r) for r in ["A", "B", "A", "B"]]))
    assert one(evaluate(m, ["top_churn_reason", "top_churn_reason_count"])) == {
        "top_churn_reason": "B",
        "top_churn_reason_count": 2,
    }
    blank = model(spark, ids([gone(), gone(), gone(churn_reason="A")]))
    row = one(evaluate(blank, ["top_churn_reason", "top_churn_reason_count"]))
    assert row == {"top_churn_reason": None, "top_churn_reason_count": 2}


def test_service_context_counts_customers_once(spark):
    m = model(spark, ids([gone(online_security="Yes", tech_support="Yes"), dict(phone_service="No", internet_service="No")]))
    by = pairs(evaluate(m, ["service_customers"], ["ServiceCategory"]), "ServiceCategory", "service_customers")
    assert by == {"Phone": 1, "Internet": 1, "Add-on": 1}
    held = evaluate(m, ["total_customers"], spec={"ServiceName": ["Online Security", "Tech Support"]})
    assert one(held)["total_customers"] == 1


def test_service_slicer_limits_the_listed_services(spark):
    m = model(spark, ids([dict(online_security="Yes")]))
    got = evaluate(m, ["service_customers"], ["ServiceName"], {"ServiceCategory": "Add-on"})
    assert pairs(got, "ServiceName", "service_customers") == {"Online Security": 1}


def test_retention_services(spark):
    rows = ids([gone(), dict(online_security="Yes"), dict(online_backup="Yes")])
    row = one(evaluate(model(spark, rows), ["best_retention_service", "worst_retention_service"]))
    # Every service but phone and internet is at 0 %, and the last name wins a tie.
    assert row["best_retention_service"] == "Tech Support"
    assert row["worst_retention_service"] == "Phone Service"
    names = ["best_retention_service", "worst_retention_service"]
    by_service = evaluate(model(spark, rows), names, ["ServiceName"]).collect()
    assert all(r.best_retention_service == r.worst_retention_service == r.ServiceName for r in by_service)
    by_category = {r.ServiceCategory: tuple(r)[1:] for r in evaluate(model(spark, rows), names, ["ServiceCategory"]).collect()}
    assert by_category["Add-on"] == ("Tech Support", "Tech Support") and len(by_category) == 3


@pytest.mark.parametrize("everything", ["All", ["All"], None])
def test_all_services_pass(spark, everything):
    m = model(spark, ids([gone(), dict(online_security="Yes")]))
    for names, by in ((MEASURES, []), (["service_customers"], ["ServiceName"]), (["best_retention_service"], ["ServiceCategory"])):
        spec = {"ServiceCategory": everything, "ServiceName": everything, "ContractType": everything}
        assert evaluate(m, names, by, spec).collect() == evaluate(m, names, by).collect()


def test_no_service_passes(spark):
    m = model(spark, ids([gone(), dict(online_security="Yes")]))
    for names, by in ((["service_customers"], ["ServiceName"]), (["best_retention_service"], ["ServiceCategory"]), (MEASURES, ["State"])):
        assert evaluate(m, names, by, {"ServiceCategory": []}).count() == 0
    assert one(evaluate(m, ["total_customers", "best_retention_service"], spec={"ServiceName": []})) == dict(
        total_customers=0, best_retention_service=None
    )


def test_each_single_measure_is_one_scan(spark, tmp_path):
    model(spark, ids([gone(), {}])).write.parquet(str(tmp_path / "m"))
    m = spark.read.parquet(str(tmp_path / "m"))
    for name in MEASURES:
        for by in ([], ["ContractType"], ["State"]):
            plan = evaluate(m, [name], by)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan parquet") == 1, (name, by)


def test_top_n_keeps_all_ties(spark):
    rows = ids([gone(city=f"C{i:02}") for i in range(14)] + [gone(city="Most")])
    top = visuals.top_cities_by_churned(model(spark, [*rows, gone(customer_id="X", city="Most")]))
    assert top.count() == 15


def test_place_minimums(spark):
    rows = ids(
        [gone(city="Nine", zip_code="9")] * 9
        + [gone(city="Ten", zip_code="2")] * 2
        + [dict(city="Ten", zip_code="8")] * 8
        + [gone(city="Ben", zip_code="3")] * 2
        + [dict(city="Ben", zip_code="8")] * 8
    )
    row = one(evaluate(model(spark, rows), FOLDERS["geography"]))
    assert (row["top_city_churn_rate"], row["top_city_churn_rate_value"]) == ("Ten", 0.2)
    assert (row["top_zip_churn_rate"], row["top_zip_churn_rate_value"]) == ("9", 1.0)


def test_null_groups_keep_their_measures(spark):
    rows = ids([gone(city=None, churn_reason="A"), dict(city="X")])
    got = {r.City: r for r in evaluate(model(spark, rows), ["churn_rate", "top_churn_reason"], ["City"]).collect()}
    assert got[None].top_churn_reason == "A" and got["X"].top_churn_reason is None


def test_threshold_is_a_parameter(spark):
    m = model(spark, ids([dict(churn_score="65"), dict(churn_score="70"), gone(churn_score="99")]))
    measures = ["high_risk_active_customers", "high_risk_revenue_exposure"]
    assert one(evaluate(m, measures))["high_risk_active_customers"] == 1
    assert one(evaluate(m, measures, threshold=60))["high_risk_active_customers"] == 2
    sweep = {r.threshold: r.high_risk_active for r in filters.threshold_sweep(m).collect()}
    assert len(sweep) == 101 and (sweep[0], sweep[65], sweep[66], sweep[71]) == (2, 2, 1, 0)


def test_unknown_names_raise(spark):
    m = model(spark, [{}])
    with pytest.raises(ValueError):
        evaluate(m, ["margin"])
    with pytest.raises(ValueError):
        evaluate(m, ["churn_rate"], spec={"Colour": "red"})


def test_rates_add_up(spark):
    m = model(spark, ids([gone(), {}, {}]))
    row = one(evaluate(m, ["churn_rate", "retention_rate", "active_customers", "churned_customers", "total_customers"]))
    assert row["churn_rate"] + row["retention_rate"] == 1.0
    assert row["active_customers"] + row["churned_customers"] == row["total_customers"]


def test_decomposition_levels(spark):
    rows = ids([dict(phone_service="No", internet_service="No"), dict(online_security="Yes", tech_support="Yes")])
    got = {(r.level, r.ServiceCategory): r.total_customers for r in visuals.decomposition(model(spark, rows)).collect()}
    assert got == {
        (0, None): 2,
        (1, None): 2,
        (2, None): 2,
        (3, "Phone"): 1,
        (3, "Internet"): 1,
        (3, "Add-on"): 1,
    }


def test_matrix_total_row_is_not_a_sum(spark):
    rows = ids([gone(), {}, dict(phone_service="No", internet_service="No", contract="One year")])
    got = {r.ServiceName: r for r in visuals.service_contract_matrix(model(spark, rows)).collect()}
    assert got["Total"].month_to_month == 0.5 and got["Total"].one_year == 0.0 and got["Total"].two_year is None
    assert got["Total"].total == 1 / 3 and got["Phone Service"].total == 0.5


def test_addon_histogram_includes_none(spark):
    m = model(spark, ids([{}, {}, dict(tech_support="Yes")]))
    assert pairs(visuals.addon_distribution(m), "addon_count", "total_customers") == {0: 2, 1: 1}


def test_bridge_filter_equals_mask_filter(spark):
    t = frames.star(spark, ids([dict(online_security="Yes", tech_support="Yes"), {}, dict(phone_service="No")]))
    semi = filters.through_bridge(
        t["fact_churn"], t["fact_customer_service"], t["dim_service"], F.col("ServiceCategory").isin("Add-on", "Phone")
    )
    mask = filters.filter_model(t["model"], {"ServiceCategory": ["Add-on", "Phone"]})
    assert sorted(r.ChurnKey for r in semi.collect()) == sorted(r.ChurnKey for r in mask.collect())
    assert semi.count() == 2


def test_access(spark):
    m = model(spark, ids([dict(state="A"), gone(state="B"), dict(state="C"), dict(state=None)]))
    rules = spark.createDataFrame(
        [("ann", "Executive", None), ("bob", "Regional", "A"), ("bob", "Regional", "B"), ("cat", "Guest", "A")],
        "user string, role string, state string",
    )
    seen = {u: filters.visible_rows(m, rules, u).count() for u in ("ann", "bob", "cat", "nobody")}
    assert seen == {"ann": 4, "bob": 2, "cat": 0, "nobody": 0}
    summary = {r.user: (r.customers, r.churned, r.churn_rate) for r in filters.access_summary(m, rules).collect()}
    assert summary == {"ann": (4, 1, 0.25), "bob": (2, 1, 0.5), "cat": (0, 0, 0.0)}
