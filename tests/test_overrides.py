"""Override gate and override table: operators 14, 32-38 and the gated price chain (29)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricestream.operators import overrides
from pricestream.plans.pricing import PricingPlan

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
EV = ("event_seq bigint, arrival_ts timestamp, event_type string, product_id string, user_id string, "
      "timestamp bigint, price double")
CMD = "cmd_seq bigint, cmd_ts timestamp, product_id string, op string, override_price double, reason string"


def at(sec, ms=0):
    return T0 + dt.timedelta(seconds=sec, milliseconds=ms)


def ms_of(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def plan(spark, events, commands, catalog=(("PA", 299.0),), cell=100_000):
    ev = spark.createDataFrame(events, EV)
    cm = spark.createDataFrame(commands, CMD)
    cat = spark.createDataFrame(list(catalog), "product_id string, base_price double")
    return PricingPlan(ev, cm, cat, rows_per_cell=cell)


def ev(seq, sec, pid="PA", etype="view", ts=None, price=100.0):
    t = at(sec)
    return (seq, t, etype, pid, "u", ms_of(t) if ts is None else ts, price)


def accepted(p):
    return sorted(r.event_seq for r in p.priced.collect())


def gates(p):
    return {r.event_seq: r.gate for r in p.gated.collect()}


@pytest.mark.parametrize("cell", [100_000, 1])
def test_active_override_skips_events(spark, cell):
    events = [ev(1, 0), ev(3, 20), ev(5, 40)]
    cmds = [(2, at(10), "PA", "set", 150.0, None), (4, at(30), "PA", "remove", None, None)]
    p = plan(spark, events, cmds, cell=cell)
    g = gates(p)
    assert g[1] is None and g[3] == "override_active" and g[5] is None
    pr = {r.event_seq: (r.demand, r.new_price) for r in p.priced.collect()}
    assert pr == {1: (1, 105.0), 5: (2, 100.0 + 2 ** 0.5 * 5)}


def test_stale_after_removal_is_inclusive(spark):
    rm = at(30)
    events = [ev(1, 0),
              (5, at(40), "view", "PA", "u", ms_of(rm), 10.0),        # event ms == removed_at -> dropped
              (6, at(41), "view", "PA", "u", ms_of(rm) + 1, 10.0),    # +1 ms -> kept
              (7, at(42), "view", "PA", "u", ms_of(rm) // 1000, 10.0),  # seconds value, normalised -> dropped
              (8, at(43), "view", "PA", "u", None, 10.0),             # missing timestamp -> 0 -> dropped
              (9, at(44), "view", "PA", "u", ms_of(rm) // 1000 + 1, 10.0)]  # next second -> kept
    cmds = [(2, at(10), "PA", "set", 150.0, None), (4, rm, "PA", "remove", None, None)]
    g = gates(plan(spark, events, cmds))
    assert g[5] == "stale_after_removal" and g[6] is None and g[7] == "stale_after_removal"
    assert g[8] == "stale_after_removal" and g[9] is None


def test_remove_without_set_is_ignored(spark):
    events = [ev(1, 0), (3, at(20), "view", "PA", "u", ms_of(at(5)), 1.0)]
    cmds = [(2, at(10), "PA", "remove", None, None)]
    assert gates(plan(spark, events, cmds)) == {1: None, 3: None}


@pytest.mark.parametrize("cell", [100_000, 1])
def test_set_set_remove_and_intervals(spark, cell):
    events = [ev(1, 0), ev(4, 25), ev(7, 60)]
    cmds = [(2, at(10), "PA", "set", 150.0, None), (3, at(20), "PA", "set", 160.0, "x"),
            (5, at(30), "PA", "remove", None, None), (6, at(35), "PA", "remove", None, None),
            (8, at(70), "PA", "set", 170.0, None)]
    p = plan(spark, events, cmds, cell=cell)
    assert accepted(p) == [1, 7]
    eff = sorted(r.cmd_seq for r in p.effective.collect())
    assert eff == [2, 3, 5, 8]                       # the second remove deleted nothing
    iv = sorted((r.set_at, r.removed_at) for r in overrides.override_intervals(p.effective, cell).collect())
    assert iv == [(at(10), at(30)), (at(70), None)]
    st = p.overrides.collect()
    assert [(r.product_id, r.override_price, r.set_time) for r in st] == [("PA", 170.0, at(70))]


def test_set_on_unknown_product_is_not_effective(spark):
    # PX is not in the catalog and has no event before the set: the set is refused,
    # so PX's later events are not gated; PA (catalog) is gated.
    events = [ev(3, 20, pid="PX"), ev(4, 21, pid="PA"), ev(6, 40, pid="PX")]
    cmds = [(1, at(10), "PX", "set", 5.0, None), (2, at(11), "PA", "set", 5.0, None),
            (5, at(30), "PX", "set", 7.0, None)]
    p = plan(spark, events, cmds)
    assert sorted(r.cmd_seq for r in p.effective.collect()) == [2, 5]
    assert accepted(p) == [3]


def test_padded_id_gated_by_trimmed_id_counted_under_raw_id(spark):
    events = [ev(1, 0, pid="PA"), ev(2, 1, pid=" PA"), ev(4, 20, pid=" PA"), ev(5, 21, pid="PA")]
    cmds = [(3, at(10), "PA", "set", 9.0, None)]
    p = plan(spark, events, cmds)
    assert accepted(p) == [1, 2]
    d = {r.event_seq: (r.product_id, r.demand) for r in p.priced.collect()}
    assert d == {1: ("PA", 1), 2: (" PA", 1)}


def test_override_history_points_and_live_price(spark):
    events = [ev(1, 0, price=100.0)]
    cmds = [(2, at(10), "PA", "set", 149.99, None), (3, at(20), "PA", "remove", None, None)]
    p = plan(spark, events, cmds)
    h = sorted((r.price_source, r.price) for r in overrides.override_history_points(p.effective).collect())
    assert h == [("override", 149.99)]                # a remove adds no history row
    ls = {r.product_id: (r.demand, r.price) for r in p.live_state.collect()}
    assert ls == {"PA": (1, 149.99)}                  # removal does not restore the dynamic price
    cur = p.current.collect()[0]
    assert (cur.price, cur.price_source) == (149.99, "dynamic")


def test_upsert_then_delete_lifecycle(spark):
    snap0 = spark.createDataFrame([], "product_id string, override_price double, reason string, set_time timestamp")
    s1 = spark.createDataFrame([(1, at(0), "PA", "set", 150.25, "a")], CMD)
    snap1 = overrides.override_upsert(snap0, s1)
    assert [(r.product_id, r.override_price, r.reason) for r in snap1.collect()] == [("PA", 150.25, "a")]
    s2 = spark.createDataFrame([(2, at(5), "PA", "set", 199.99, "b")], CMD)
    snap2 = overrides.override_upsert(snap1, s2)
    assert [(r.override_price, r.reason, r.set_time) for r in snap2.collect()] == [(199.99, "b", at(5))]
    req = spark.createDataFrame([("PA",)], "product_id string")
    survivors, flags = overrides.override_delete(snap2, req)
    assert survivors.count() == 0 and [r.deleted for r in flags.collect()] == [True]
    _, again = overrides.override_delete(survivors, req)
    assert [r.deleted for r in again.collect()] == [False]


def test_snapshot_null_reason_reads_as_empty(spark):
    df = spark.createDataFrame([("PA", 1.0, None, at(0))],
                               "product_id string, override_price double, reason string, set_time timestamp")
    assert overrides.price_overrides_snapshot(df).first().reason == ""


def test_known_product_commands(spark):
    cmds = spark.createDataFrame([(1, at(10), "PA", "set", 1.0, None), (2, at(10), "PB", "set", 1.0, None),
                                  (3, at(30), "PB", "set", 1.0, None), (4, at(30), "PC", "set", 1.0, None)],
                                 CMD).select("cmd_seq", "cmd_ts", "product_id", "op", "override_price", "reason")
    valid_ev = spark.createDataFrame([ev(9, 20, pid="PB")], EV)
    cat = spark.createDataFrame([("PA", 1.0)], "product_id string, base_price double")
    out = overrides.known_product_commands(cmds, overrides.known_since(cat, valid_ev))
    assert sorted(r.cmd_seq for r in out.collect()) == [1, 3]
