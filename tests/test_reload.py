"""Reloads by state: the changed states' folders only, and the same tables as a reload of everything."""

import os

import frames
import pytest
from attrition.plans.reload import PART, StateStore
from attrition.session import scratch
from pyspark.sql import functions as F

ROWS = frames.ids([dict(state=s, city=f"{s}{i}", tech_support="Yes" if i % 2 else "No") for s in ("A", "B", "C") for i in range(4)])
SHOWN = ["CustomerID", "State", "City", "ContractType", "ChurnScore", "ServiceMask", "addon_count"]


def files(store):
    """Folder by folder, the data files there are."""
    return {
        (table, os.path.basename(folder)): sorted(n for n in names if n.endswith(".parquet"))
        for table in ("silver", "dim_customer", "fact_churn", "fact_customer_service", "model")
        for folder, _, names in os.walk(f"{store.root}/{table}")
        if PART in os.path.basename(folder)
    }


def loaded(spark, rows):
    store = StateStore(spark, scratch(spark, "states"))
    store.load(frames.bronze(spark, rows))
    return store


def content(model):
    return sorted(model.select(SHOWN).collect(), key=str)


def keys(store):
    return {r.CustomerID: (r.CustomerKey, r.ChurnKey) for r in store["model"].collect()}


def parts(store, *states):
    table = store["model"].select("State", PART).distinct()
    return {r[PART] for r in table.filter(F.col("State").isin(*states)).collect()}


def check(spark, store, rows):
    assert content(store["model"]) == content(frames.model(spark, rows))
    model, customers = store["model"], store["dim_customer"]
    assert customers.select("CustomerKey").distinct().count() == customers.count()
    assert model.select("ChurnKey").distinct().count() == model.count()
    assert store["fact_customer_service"].join(customers, "CustomerKey", "left_anti").count() == 0


def test_nothing_changed_writes_nothing(spark):
    store = loaded(spark, ROWS)
    check(spark, store, ROWS)
    before = files(store)
    assert store.load(frames.bronze(spark, ROWS[::-1]).repartition(5)) == []
    assert files(store) == before


def test_a_change_rewrites_its_state_only(spark):
    store = loaded(spark, ROWS)
    before, known = files(store), keys(store)
    rows = [r | dict(churn_score="99", city="Z") if i == 5 else r for i, r in enumerate(ROWS)]
    done = store.load(frames.bronze(spark, rows))
    assert set(done) == parts(store, "B") and len(done) == 1
    after = files(store)
    assert {folder for table, folder in before if after[table, folder] != before[table, folder]} == {f"{PART}={done[0]}"}
    check(spark, store, rows)
    assert keys(store) == known


def test_moves_arrivals_and_departures(spark):
    """One customer moves from A to B, one is new, no service is left in A, C goes as a whole, and comes back under keys of its own."""
    store = loaded(spark, ROWS)
    known = keys(store)
    none = dict(phone_service="No", internet_service="No")
    rows = [r | dict(state="B") if i == 0 else r | none if i < 4 else r for i, r in enumerate(ROWS[:8])]
    rows.append(dict(customer_id="new", state="B"))
    store.load(frames.bronze(spark, rows))
    check(spark, store, rows)
    now = keys(store)
    assert all(now[c][0] == known[c][0] for c in now if c in known)
    assert not {folder for _, folder in files(store)} - {f"{PART}={p}" for p in parts(store, "A", "B")}
    store.load(frames.bronze(spark, ROWS))
    check(spark, store, ROWS)
    again = keys(store)
    used = {k for k, _ in now.values()} | {k for k, _ in known.values()}
    assert not {again[f"S{i}"][0] for i in range(8, 12)} & used


def test_a_customer_of_two_states_reaches_both(spark):
    """Its rows fan out over both addresses, so a change in one state changes facts in the other."""
    other = dict(customer_id="S0", state="B", phone_service="No", internet_service="No")
    rows = [*ROWS, other | dict(churn_score="7")]
    store = loaded(spark, rows)
    check(spark, store, rows)
    rows = [*ROWS, other | dict(churn_score="8")]
    assert set(store.load(frames.bronze(spark, rows))) == parts(store, "A", "B")
    check(spark, store, rows)


def test_null_state_odd_names_and_empty_input(spark):
    rows = frames.ids([dict(state=s) for s in (None, "a=b/c", "A", "a", "1e5", "")])
    store = loaded(spark, rows)
    check(spark, store, rows)
    store.load(frames.bronze(spark, rows[:2]))
    check(spark, store, rows[:2])
    store.load(frames.bronze(spark, rows[:2]).limit(0))
    assert not files(store)


def test_a_broken_constraint_touches_nothing(spark):
    store = loaded(spark, ROWS)
    before = files(store)
    with pytest.raises(ValueError, match="customer_id"):
        store.load(frames.bronze(spark, ROWS + [dict(customer_id=None, state="A")]))
    with pytest.raises(ValueError, match="fact_customer_service"):
        store.load(frames.bronze(spark, ROWS + ROWS[:1]))
    assert files(store) == before
    check(spark, store, ROWS)


def test_an_interrupted_load_is_done_again(spark, monkeypatch):
    store = loaded(spark, ROWS)
    known = keys(store)
    rows = [r | dict(churn_score="99") if i in (1, 5) else r for i, r in enumerate(ROWS)]
    write = StateStore._replace

    def stops(self, table, *rest):
        if table == "model":
            raise RuntimeError("lost")
        write(self, table, *rest)

    monkeypatch.setattr(StateStore, "_replace", stops)
    with pytest.raises(RuntimeError, match="lost"):
        store.load(frames.bronze(spark, rows))
    monkeypatch.undo()
    assert len(store.load(frames.bronze(spark, rows))) == 2
    check(spark, store, rows)
    assert keys(store) == known
