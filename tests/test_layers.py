"""Landing, typed layer, feed, star schema and checks on literal rows."""

from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from attrition import schemas
from attrition.functions import cleansing as clean
from attrition.operators import checks, gold, keys, silver
from attrition.sources import feed as feeds
from attrition.sources import landing


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [row.v for row in df.select("i", F.expr(expression("x")).alias("v")).orderBy("i").collect()]


def test_headers(spark):
    raw = ["CustomerID", "Lat Long", "Monthly Charges (USD)", "Churn %", "Zip. Code", "", "_c6"]
    df = spark.createDataFrame([tuple("x" * len(raw))], [f"h{i}" for i in range(len(raw))]).toDF(*raw)
    got = landing.snake_headers(df).columns
    assert got == ["customer_id", "lat_long", "monthly_charges_usd", "churn", "zip_code", "col_6", "col_7"]


def test_colliding_headers_raise(spark):
    df = spark.createDataFrame([("a", "b")], ["a", "b"]).toDF("Zip Code", "zip_code")
    with pytest.raises(ValueError, match="zip_code"):
        landing.snake_headers(df)


def test_width_counts_utf16_units_and_is_at_least_one(spark):
    df = spark.createDataFrame([("ab", None, "😀😀"), ("abc", None, "é")], "a string, b string, c string")
    assert frames.pairs(landing.width_profile(df), "column", "max_len") == {"a": 3, "b": 1, "c": 4}


def test_tinyint_is_unsigned_and_strict(spark):
    texts = ["", "12.5", "300", "256", "255", "200", "-1", " 42 ", "x", None]
    got = values(spark, texts, lambda c: clean.safe_int(c, "tinyint"))
    assert got == [None, None, None, None, 255, 200, None, 42, None, None]


def test_decimal_notation(spark):
    texts = ["", "12.5", "1e3", "53.855", "1,234.5", " 42 ", "999999999.99", "-7", ".5", "n/a", None]
    got = values(spark, texts, lambda c: clean.safe_decimal(c, 10, 2))
    want = [None, "12.50", None, "53.86", None, "42.00", None, "-7.00", "0.50", None, None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_flags_ignore_case_and_trailing_blanks_only(spark):
    texts = ["Yes", "yes ", " Yes", "NO", "Y", "", None]
    assert values(spark, texts, clean.yes_no) == [True, True, None, False, None, None, None]


def test_blank_total_and_reason(spark):
    rows = [
        dict(total_charges=t, churn_reason=r) for t, r in [("", ""), ("   ", "  "), (" 5 ", " Moved "), (None, None)]
    ]
    got = frames.silver(spark, frames.ids(rows)).orderBy("customer_id").collect()
    assert [r.total_charges for r in got] == [None, None, Decimal("5.00"), None]
    assert [r.churn_reason for r in got] == [None, None, "Moved", None]


def test_trim_keeps_tabs(spark):
    row = frames.one(frames.silver(spark, [dict(city="  A\t ", payment_method="  Mailed check")]))
    assert (row["city"], row["payment_method"]) == ("A\t", "Mailed check")


def test_silver_has_33_columns_and_a_stamp(spark):
    df = silver.build_silver(frames.bronze(spark, [{}]))
    assert df.columns == [*schemas.BRONZE_COLUMNS, "dwh_create_date"]
    assert df.first().dwh_create_date is not None


def test_too_wide_and_missing_ids(spark):
    df = frames.silver(spark, [dict(customer_id="12345678901"), dict(gender="😀" * 6, customer_id=None)])
    wide = frames.pairs(checks.too_wide(df), "column", "too_wide")
    assert wide["customer_id"] == 1 and wide["gender"] == 1 and wide["city"] == 0
    assert frames.one(checks.missing_ids(df)) == {"missing_ids": 1}
    with pytest.raises(ValueError, match="expectations failed"):
        checks.require_clean(checks.missing_ids(df), "missing_ids")
    checks.require_clean(checks.missing_ids(frames.silver(spark, [{}])), "missing_ids")


def test_feed_text_and_flags(spark):
    typed = frames.silver(spark, [dict(churn_reason='a\r\nb\tc "q" \\', phone_service="?", senior_citizen="Yes")])
    row = frames.one(feeds.build_feed(typed))
    assert row["reason"] == 'a b c "q" \\' and row["phone"] == 0 and row["senior"] == 1
    assert len(row) == 31


def test_feed_sink_round_trip(spark, tmp_path):
    rows = frames.feed(spark, [dict(id="a", reason='say "x" \\ y'), dict(id="b", total=None)])
    assert feeds.write_feed(rows, str(tmp_path / "feed")) == 2
    back = spark.read.schema(rows.schema).json(str(tmp_path / "feed"))
    assert sorted(back.collect()) == sorted(rows.collect())
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "feed")).collect())
    assert '"total":null' in text


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert landing.write_table(spark.range(3), path, "if_empty")
    assert not landing.write_table(spark.range(5), path, "if_empty")
    assert spark.read.parquet(path).count() == 3
    assert landing.write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    landing.write_table(spark.range(0), path)
    assert landing.write_table(spark.range(2), path, "if_empty")
    with pytest.raises(ValueError):
        landing.write_table(spark.range(1), path, "append")


# Star schema.


def test_exact_duplicate_row_gives_one_customer_two_facts_and_a_reported_bridge_repeat(spark):
    t = frames.star(spark, [{}, {}])
    assert t["dim_customer"].count() == 1 and t["fact_churn"].count() == 2
    report = {r.table: (r.repeated_keys, r.extra_rows) for r in checks.duplicate_keys(t).collect()}
    assert report["fact_customer_service"] == (2, 2)
    assert report["fact_churn"] == (0, 0) and report["dim_customer"] == (0, 0)


def test_two_addresses_fan_out(spark):
    t = frames.star(spark, [dict(city="A"), dict(city="B")])
    assert t["dim_customer"].count() == 2 and t["fact_churn"].count() == 4


def test_null_contract_or_id_stops_the_load(spark):
    t = frames.star(spark, frames.ids([dict(contract=None), {}]))
    with pytest.raises(ValueError, match="contract"):
        checks.verify("silver", t)
    with pytest.raises(ValueError, match="ContractType"):
        checks.verify("dim_contract", t)
    with pytest.raises(ValueError, match="customer_id"):
        checks.verify("silver", {"silver": frames.silver(spark, [dict(customer_id=None), {}])})
    assert frames.one(checks.load_loss(t["silver"], t["fact_churn"], t["dim_customer"])) == dict(due=2, facts=1, lost=1)
    gaps = frames.pairs(checks.contract_gaps(t["silver"]), "column", "nulls")
    assert gaps == {"contract": 1, "paperless_billing": 0, "payment_method": 0}
    missing = {(r.table, r.column): r.nulls for r in checks.missing_values(t).collect()}
    assert missing["dim_contract", "ContractType"] == 1 and sum(missing.values()) == 1


def test_null_city_still_has_a_dimension_row(spark):
    t = frames.star(spark, [dict(city=None)])
    assert frames.one(t["model"])["City"] is None


def test_orphans(spark):
    t = frames.star(spark, frames.ids([{}, {}]))
    t["dim_customer"] = t["dim_customer"].filter("CustomerID = 'S0'")
    lost = {(r.table, r.column): r.orphans for r in checks.orphan_rows(t).collect()}
    assert lost["fact_churn", "CustomerKey"] == 1 and lost["fact_customer_service", "CustomerKey"] == 2
    assert lost["fact_churn", "ContractKey"] == 0


def test_reconcile_shows_both_sides(spark):
    actual = checks.layer_counts({"a": spark.range(2), "b": spark.range(3)})
    got = {r.layer: (r.expected, r.actual, r.matches) for r in checks.reconcile(actual, spark.createDataFrame([("a", 2), ("c", 1)], "layer string, expected long")).collect()}
    assert got == {"a": (2, 2, True), "b": (None, 3, False), "c": (1, None, False)}


def test_churn_sanity_rounds_to_one_decimal_and_is_null_on_empty(spark):
    labels = [("Yes",)] * 1869 + [("No",)] * 5174
    df = spark.createDataFrame(labels, "ChurnLabel string")
    assert frames.one(checks.churn_sanity(df))["churn_rate_pct"] == Decimal("26.5")
    assert frames.one(checks.churn_sanity(df.limit(0)))["churn_rate_pct"] is None


def test_services_unpivot(spark):
    rows = frames.ids(
        [
            dict(phone_service="No", internet_service="No"),
            dict(phone_service="No", internet_service="No", tech_support="Yes", online_backup="Yes"),
            dict(streaming_tv="Yes", streaming_movies="Yes", online_security="No internet service"),
        ]
    )
    held = gold.unpivot_services(frames.silver(spark, rows), "customer_id")
    got = sorted((r.customer_id, r.ServiceName) for r in held.collect())
    assert got == [
        ("S1", "Online Backup"),
        ("S1", "Tech Support"),
        ("S2", "Internet Service"),
        ("S2", "Phone Service"),
        ("S2", "Streaming Movies"),
        ("S2", "Streaming TV"),
    ]
    profile = {r.CustomerID: (r.ServiceMask, r.addon_count) for r in frames.star(spark, rows)["profile"].collect()}
    assert profile == {"S0": (0, None), "S1": (0b1010000, 2), "S2": (0b110000101, None)}


# Surrogate keys.


def _keys(df, **more):
    return sorted(tuple(r) for r in keys.with_key(df, "key", **more).collect())


def test_keys_are_dense_and_do_not_depend_on_layout(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    first = _keys(df.repartition(7))
    assert [r[0] for r in first] == list(range(1, 5001))
    assert first == _keys(df.repartition(2, "b"))


def test_null_and_text_never_share_a_content_key(spark):
    df = spark.createDataFrame([("-", "a"), (None, "a"), ("1:a", None), ("", "a")], "a string, b string")
    assert df.selectExpr(f"{keys.content_key(['a', 'b'])} AS k").distinct().count() == 4


def test_hot_copies_are_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_ROW", 10)
    df = spark.range(1000).select(F.when(F.col("id") < 337, F.lit(0)).otherwise(F.col("id")).alias("a"))
    got = _keys(df)
    assert [r[0] for r in got] == list(range(1, 1001))
    assert sum(1 for r in got if r[1] == 0) == 337
    hot = [r[0] for r in got if r[1] == 0]
    # 34 runs of at most ten copies, spread over the key range rather than in one block.
    assert max(hot) - min(hot) > 337


def test_hot_customer(spark):
    """One id holds a third of the rows; nothing is lost or multiplied wrongly."""
    rows = [dict(customer_id=f"S{i}" if i % 3 else "HOT") for i in range(300)]
    t = frames.star(spark, rows)
    assert t["dim_customer"].count() == 201 and t["fact_churn"].count() == 300
    assert t["model"].filter("CustomerID = 'HOT'").count() == 100


def test_rebuild_gives_identical_gold(spark):
    rows = frames.ids([dict(city=f"C{i % 7}", churn_score=str(i)) for i in range(50)])
    first, again = frames.star(spark, rows), frames.star(spark, list(reversed(rows)))
    for name in ("dim_customer", "dim_contract", "fact_churn", "fact_customer_service"):
        assert sorted(map(str, first[name].collect())) == sorted(map(str, again[name].collect()))


def test_repeated_bridge_rows_and_orphans_stop_the_load(spark):
    t = frames.star(spark, [{}, {}])
    checks.verify("dim_customer", t)
    checks.verify("fact_churn", t)
    with pytest.raises(ValueError, match="repeated_keys"):
        checks.verify("fact_customer_service", t)
    t["dim_customer"] = t["dim_customer"].limit(0)
    with pytest.raises(ValueError, match="orphans"):
        checks.verify("fact_churn", t)


def test_every_broken_rule_is_shown(spark):
    report = spark.range(30).selectExpr("id AS rule", "1 AS nulls")
    with pytest.raises(ValueError) as error:
        checks.require_clean(report, "nulls")
    assert str(error.value).count("'rule'") == 30


def test_build_stops_at_the_broken_layer(spark, tmp_path, sf_dir, monkeypatch):
    from attrition.plans import warehouse

    broken = dict(warehouse._BUILDERS)
    broken["silver"] = lambda w: frames.silver(spark, frames.ids([dict(payment_method=None), {}]))
    monkeypatch.setattr(warehouse, "_BUILDERS", broken)
    w = warehouse.Warehouse(spark, sf_dir, str(tmp_path))
    with pytest.raises(ValueError, match="payment_method"):
        w["model"]


@pytest.mark.parametrize("shift", [10**9, 10**18])
def test_long_order_keys_stay_whole(spark, tmp_path, sf_dir, shift):
    from attrition.sources import subscribers

    for name in subscribers.INPUT_TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        keys = {c: F.col(c) + shift for c in table.columns if c in ("o_orderkey", "l_orderkey")}
        table.withColumns(keys).write.parquet(f"{tmp_path}/{name}.parquet")
    bronze = subscribers.read_bronze(spark, str(tmp_path))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert bronze.select("customer_id").distinct().count() == bronze.count() == orders
    assert {len(r.customer_id) for r in bronze.select("customer_id").collect()} == {len(str(shift)) + 1}


def test_raw_cells_keep_quotes_commas_and_line_ends(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"say ""hi"", now","two\nlines"\n,"x"\n')
    assert [tuple(r) for r in landing.read_raw(spark, str(tmp_path / "x.csv")).collect()] == [
        ('say "hi", now', "two\nlines"),
        (None, "x"),
    ]


RAGGED = 'a,b\n1,2\n3,4,5\n6\n"x, y","z"\n\n7,8\n'


def test_a_ragged_record_stops_the_load(spark, tmp_path):
    (tmp_path / "x.csv").write_text(RAGGED)
    for multiline in (True, False):
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            landing.read_raw(spark, str(tmp_path / "x.csv"), multiline=multiline).select("a").collect()


def test_ragged_records_go_to_a_reject_table_with_their_text(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.csv").write_text(RAGGED)
    (tmp_path / "in/y.csv").write_text('a,b\n,"two\nlines"\n')
    good = landing.read_raw(spark, str(tmp_path / "in"), rejects=str(tmp_path / "bad"))
    assert sorted(map(tuple, good.collect()), key=str) == sorted([("1", "2"), ("x, y", "z"), ("7", "8"), (None, "two\nlines")], key=str)
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r._file[-5:], r.record.strip()) for r in bad) == [("x.csv", "3,4,5"), ("x.csv", "6")]


def test_files_with_other_headers_stop_the_load(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_raw(spark, str(tmp_path)).collect()


def test_names_stand_for_a_missing_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,2\n3,\n")
    read = landing.read_raw(spark, str(tmp_path / "x.csv"), names=["a", "b"])
    assert read.columns == ["a", "b"] and sorted(map(tuple, read.collect())) == [("1", "2"), ("3", None)]


def test_keys_with_gaps_repeats_and_nulls_are_looked_at(spark):
    t = {"p": spark.createDataFrame([(1,), (3,), (3,), (70_000,), (None,)], "k long"), "q": spark.createDataFrame([(2,), (1,), (3,)], "k long")}
    t["c"] = spark.createDataFrame([(1,), (2,), (2,), (None,), (70_000,)], "k long")
    profiles = checks.Profiles(t)
    found = profiles.of("p", "k")
    assert (found.rows, found.nulls, found.low, found.high, found.bits) == (5, 1, 1, 70_000, 3)
    assert not profiles.unique("p", ["k"]) and profiles.unique("q", ["k"])
    assert profiles.dense("p", "k") is None and profiles.dense("q", "k") == 3
    report = {r.table: (r.repeated_keys, r.extra_rows) for r in checks.duplicate_keys(t, {"p": ["k"], "q": ["k"]}).collect()}
    assert report == {"p": (1, 1), "q": (0, 0)}
    lost = {(r.parent): r.orphans for r in checks.orphan_rows(t, [("c", "k", "p"), ("c", "k", "q")]).collect()}
    assert lost == {"p": 2, "q": 1}
