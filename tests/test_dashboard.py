"""Dashboard semantics on literal feed rows."""

from decimal import Decimal

import pytest
from frames import churn, feed, one, pairs
from pyspark.sql import functions as F

from attrition.functions import derive
from attrition.operators import filters
from attrition.plans import charts, kpis

D = Decimal


def test_missing_values_count_as_zero_in_averages(spark):
    row = one(kpis.kpi_overview(feed(spark, [dict(monthly=D(30), cltv=None), dict(monthly=None, cltv=500)])))
    assert row["avg_monthly"] == 15.0 and row["avg_cltv"] == 250.0 and row["total"] == 2


def test_empty_input(spark):
    empty = feed(spark, [{}]).limit(0)
    overview = one(kpis.kpi_overview(empty))
    assert overview["total"] == 0 and overview["churn_rate"] == 0.0 and overview["avg_monthly"] == 0.0
    assert one(kpis.kpi_churn(empty))["top_reason"] is None
    services = one(kpis.kpi_services(empty))
    assert (services["worst_service"], services["best_service"]) == ("Phone Service", "Streaming Movies")
    assert services["subscriptions"] == 0 and services["avg_addons"] == 0.0
    assert one(kpis.kpi_revenue(empty))["top_contract"] == "Month-to-month"
    assert one(kpis.kpi_geography(empty)) == {
        "states": 0, "cities": 0, "zips": 0, "top_city": None, "top_city_n": None, "top_zip": None,
        "top_zip_n": None, "top_zip_rate": None, "hot_city": None, "hot_city_n": None, "hot_city_rate": None,
    }
    assert pairs(charts.by_contract(empty), "contract", "total") == dict.fromkeys(
        ["Month-to-month", "One year", "Two year"], 0
    )
    assert one(charts.map_bounds(empty))["south"] is None
    assert charts.zip_map(empty).count() == 0


def test_unknown_reason_and_ties(spark):
    rows = [churn(reason=r) for r in ["B", "A", "B", "A", None, ""]]
    row = one(kpis.kpi_churn(feed(spark, rows)))
    assert (row["top_reason"], row["top_reason_count"]) == ("A", 2)
    assert pairs(charts.top_reasons(feed(spark, rows)), "reason", "total") == {"A": 2, "B": 2, "Unknown": 2}


def test_high_risk_needs_the_threshold_and_an_active_customer(spark):
    rows = [dict(score=70), dict(score=69), dict(score=None), churn(score=99), dict(score=71, churn=None)]
    assert one(kpis.kpi_churn(feed(spark, rows)))["high_risk_active"] == 2
    assert one(kpis.kpi_churn(feed(spark, rows), threshold=69))["high_risk_active"] == 3


def test_service_ties_follow_the_catalogue(spark):
    rows = [dict(mlines="Yes"), churn(mlines="Yes")]
    row = one(kpis.kpi_services(feed(spark, rows)))
    # Phone, lines and internet all churn at 50 %, the six others at 0 %.
    assert (row["worst_service"], row["best_service"]) == ("Phone Service", "Streaming Movies")


def test_addons_and_streaming(spark):
    rows = [dict(osec="Yes", oback="Yes"), dict(stv="Yes", smov="Yes"), dict(tech="yes"), dict(smov="Yes")]
    row = one(kpis.kpi_services(feed(spark, rows)))
    assert row["avg_addons"] == 0.5 and row["streaming_n"] == 2 and row["suite_n"] == 1


def test_top_contract_ties_keep_domain_order(spark):
    row = one(kpis.kpi_revenue(feed(spark, [dict(contract="Two year"), dict(contract="One year")])))
    assert row["top_contract"] == "One year" and row["top_contract_n"] == 1


def test_geography(spark):
    rows = (
        [dict(city="Nine", zip="9")] * 9
        + [churn(city="Ten", zip="10")] * 4
        + [dict(city="Ten", zip="10")] * 6
        + [churn(city="Tie", zip=None)] * 4
        + [dict(city="Tie", zip=None)] * 6
        + [churn(city="", zip="2"), churn(city=None, zip="2")]
        + [dict(state="", lat=None, lng=None)]
    )
    row = one(kpis.kpi_geography(feed(spark, rows)))
    assert (row["states"], row["cities"], row["zips"]) == (1, 4, 5)
    assert (row["top_city"], row["top_city_n"]) == ("Ten", 10)
    assert (row["top_zip"], row["top_zip_n"]) == ("0", 10)
    assert (row["hot_city"], row["hot_city_n"], row["hot_city_rate"]) == ("Ten", 10, 40.0)
    cities = pairs(charts.top_cities(feed(spark, rows)), "city", "total")
    assert cities == {"Ten": 10, "Tie": 10, "Nine": 9, "Unknown": 2, "Town": 1}


def test_hot_city_prefers_the_larger_of_equal_rates(spark):
    rows = [churn(city="A")] * 10 + [churn(city="B")] * 11 + [churn(city="C")] * 9
    assert one(kpis.kpi_geography(feed(spark, rows)))["hot_city"] == "B"


def test_map_labels_and_missing_coordinates(spark):
    rows = [dict(zip="1", city="", state=None, lat=None), dict(zip="1", city=None, state="", lat=D(4)), dict(zip="2")]
    got = {r.zip: r for r in charts.zip_map(feed(spark, rows)).collect()}
    assert (got["1"].city, got["1"].state, got["1"].lat) == ("?", "CA", 2.0)
    assert got["1"].radius == 22.0 and got["2"].radius == 6 + 16 * (1 / 2) ** 0.5


@pytest.mark.parametrize(
    "tenure,band,bucket",
    [
        (0, "0-6", "0-12"), (6, "0-6", "0-12"), (7, "7-12", "0-12"), (12, "7-12", "0-12"), (13, "13-24", "13-24"),
        (24, "13-24", "13-24"), (25, "25-48", "25-36"), (36, "25-48", "25-36"), (37, "25-48", "37-48"),
        (48, "25-48", "37-48"), (49, "49-72", "49-60"), (60, "49-72", "49-60"), (61, "49-72", "60+"),
        (72, "49-72", "60+"), (None, "0-6", None),
    ],
)
def test_tenure_bands(spark, tenure, band, bucket):
    df = spark.createDataFrame([(tenure,)], "t smallint")
    assert df.selectExpr(derive.tenure_band("t"), derive.tenure_bucket("t")).first()[:] == (band, bucket)


@pytest.mark.parametrize(
    "score,band,risk,status",
    [
        (0, "0-19", "0-39", "green"), (19, "0-19", "0-39", "green"), (20, "20-39", "0-39", "green"),
        (39, "20-39", "0-39", "green"), (40, "40-59", "40-59", "green"), (49, "40-59", "40-59", "green"),
        (50, "40-59", "40-59", "amber"), (59, "40-59", "40-59", "amber"), (60, "60-79", "60-69", "amber"),
        (69, "60-79", "60-69", "amber"), (70, "60-79", "70-84", "orange"), (79, "60-79", "70-84", "orange"),
        (80, "80-100", "70-84", "orange"), (84, "80-100", "70-84", "orange"), (85, "80-100", "85+", "red"),
        (100, "80-100", "85+", "red"), (-1, "80-100", "0-39", "green"), (None, "0-19", None, None),
    ],
)
def test_score_bands(spark, score, band, risk, status):
    df = spark.createDataFrame([(score,)], "s smallint")
    got = df.selectExpr(derive.score_band("s"), derive.risk_band("s"), derive.score_status("s")).first()
    assert got[:] == (band, risk, status)


def test_negative_score_is_in_no_bar(spark):
    assert sum(pairs(charts.score_histogram(feed(spark, [dict(score=-1), dict(score=None)])), "band", "total").values()) == 1


def test_rate_status(spark):
    df = spark.createDataFrame([(0.1,), (0.15,), (0.3,), (0.31,)], "r double")
    got = [(r[0], r[1]) for r in df.selectExpr(derive.rate_status("r"), derive.rate_arrow("r")).collect()]
    assert got == [("green", "▼"), ("amber", "➖"), ("amber", "▲"), ("red", "▲")]


def test_filters(spark):
    rows = feed(
        spark,
        [
            dict(id="a", internet="Cable", churn=None, tenure=None),
            churn(id="b", internet=None, tenure=49),
            dict(id="c", internet="Fiber optic", tenure=12),
        ],
    )

    def kept(**spec):
        return sorted(r.id for r in filters.apply_filters(rows, spec).collect())

    assert kept() == kept(gender="All") == ["a", "b", "c"]
    assert kept(internet="No") == ["a", "b"] and kept(internet="Fiber optic") == ["c"]
    assert kept(churn="Active") == ["a", "c"] and kept(churn="Churned") == ["b"]
    assert kept(tenure="0-6") == ["a"] and kept(tenure="7-12") == ["c"] and kept(tenure="49-72") == ["b"]
    assert kept(tenure="1-2") == [] and kept(gender="Male", internet="No", churn="Churned") == ["b"]
    with pytest.raises(ValueError):
        filters.apply_filters(rows, {"colour": "red"})


def test_facets_equal_field_by_field_filtering(spark):
    rows = feed(
        spark,
        [
            dict(
                gender=["Male", "Female", None][i % 3],
                contract=["Month-to-month", "One year", "Odd"][i % 4 % 3],
                internet=["DSL", "No", "Fiber optic"][i % 5 % 3],
                tenure=i % 73,
                churn="Yes" if i % 7 < 3 else "No",
            )
            for i in range(200)
        ],
    )
    spec = {"gender": "Male", "tenure": "25-48", "churn": "Active"}
    got = {(r.field, r.value): r["count"] for r in filters.facet_counts(rows, spec).collect()}
    for field, domain in filters.DOMAINS.items():
        base = filters.apply_filters(rows, spec, without=field)
        for value in domain:
            assert got[field, value] == base.filter(F.expr(filters.FIELD_VALUES[field]) == value).count()
    assert got["churn", "All"] == filters.apply_filters(rows, spec, without="churn").count()


def test_segments_equal_filtering_one_by_one(spark):
    rows = feed(spark, [dict(gender=g, churn=c, tenure=t) for g in ("Male", "Female", None) for c in ("Yes", "No") for t in (3, 60)])
    names = list(filters.DOMAINS)
    specs = {"all": {}, "m": {"gender": "Male"}, "f old": {"gender": "Female", "tenure": "49-72"}, "none": {"pay": "x"}}
    table = spark.createDataFrame([(n, *[s.get(f, "All") for f in names]) for n, s in specs.items()], ["segment", *names])
    got = pairs(filters.segment_kpis(rows, table), "segment", "total")
    assert got == {n: filters.apply_filters(rows, s).count() for n, s in specs.items()}


def test_chart_invariants(spark):
    rows = feed(spark, [dict(churn="Yes" if i % 3 == 0 else "No", tenure=i, score=i, osec="Yes" if i % 2 else "No") for i in range(73)])
    for chart in (charts.by_contract, charts.by_tenure, charts.by_payment, charts.churn_status, charts.score_histogram):
        assert sum(r.total for r in chart(rows).collect()) == 73
    services = pairs(charts.service_adoption(rows), "service", "total")
    assert sum(services.values()) == one(kpis.kpi_services(rows))["subscriptions"]
    assert sum(r.subscriptions for r in charts.category_subscriptions(rows).collect()) == sum(services.values())
    assert abs(sum(r.share for r in charts.category_subscriptions(rows).collect()) - 100) < 1e-9


def test_payment_labels(spark):
    got = pairs(charts.payment_mix(feed(spark, [{}])), "pay", "label")
    assert got["Credit card (automatic)"] == "Credit card · Auto" and got["Mailed check"] == "Mailed check"
