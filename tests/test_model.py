"""Brute force: the Spark plan against a one-message-at-a-time model of the service.

The model keeps the service's key/value state (demand and price per raw id,
override row / active flag / removal time per id) and applies events and
sequences come from hypothesis; Spark must agree on accepted events, demand,
price, effective sets, gate reasons and the final live state, in both the plain
and the time-bucketed form.
"""

import datetime as dt
import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricestream.operators import overrides
from pricestream.plans.pricing import PricingPlan

T0 = dt.datetime(2024, 1, 1)
EPOCH = dt.datetime(1970, 1, 1)
WEIGHTS = {"view": 1, "cart": 3, "purchase": 5}
ID_RE = re.compile(r"[A-Za-z0-9_-]+")
CATALOG = {"PA": 299.0}
RAW_IDS = ["PA", "PB", "PC", " PB", "PB\t", "  "]


def ms(t):
    return int((t - EPOCH) / dt.timedelta(milliseconds=1))


def norm(ts):
    ts = ts or 0
    return ts if ts >= 1_000_000_000_000 else ts * 1000


def model(events, commands):
    """events: (seq, arrival, type, pid, ts, price); commands: (seq, at, pid, op, price)."""
    demand, price, row, active, removed = {}, {}, {}, {}, {}
    for pid, base in CATALOG.items():
        demand[pid], price[pid] = 0, base
    msgs = [(e[1], 2, e[0], "e", e) for e in events] + [(c[1], 1, c[0], "c", c) for c in commands]
    accepted, sets, gates = {}, [], {}
    for _, _, _, kind, m in sorted(msgs, key=lambda x: x[:3]):
        if kind == "c":
            seq, at, pid, op, p = m
            if op == "set":
                tid = pid.strip()
                if ID_RE.fullmatch(tid) and (p or 0) > 0 and (tid in demand or tid in price):
                    row[tid], active[tid], price[tid] = p, True, p
                    sets.append(seq)
            elif ID_RE.fullmatch(pid) and pid in row:
                del row[pid]
                active[pid] = False
                removed[pid] = ms(at)
            continue
        seq, at, etype, pid, ts, p = m
        if etype not in WEIGHTS or pid.strip() == "" or not (p or 0) > 0:
            continue
        tid = pid.strip()
        if active.get(tid):
            gates[seq] = "override_active"
            continue
        if tid in removed and norm(ts) <= removed[tid]:
            gates[seq] = "stale_after_removal"
            continue
        demand[pid] = demand.get(pid, 0) + WEIGHTS[etype]
        new_price = p + math.sqrt(demand[pid]) * 5
        price[pid] = new_price
        accepted[seq] = (pid, demand[pid], new_price)
        gates[seq] = None
    return accepted, sorted(sets), gates, demand, price, row


@st.composite
def scenario(draw):
    n_ev = draw(st.integers(1, 16))
    n_cmd = draw(st.integers(0, 10))
    times = draw(st.lists(st.integers(0, 120), min_size=n_ev + n_cmd, max_size=n_ev + n_cmd))
    events, commands = [], []
    for i in range(n_ev):
        at = T0 + dt.timedelta(seconds=times[i])
        pid = draw(st.sampled_from(RAW_IDS))
        etype = draw(st.sampled_from(["view", "cart", "purchase", "click"]))
        p = draw(st.sampled_from([0.0, 1.5, 10.0, 99.99]))
        unit = draw(st.sampled_from(["ms", "s", "late", "near", "near"]))
        stamp = {"ms": ms(at), "s": ms(at) // 1000, "late": ms(at) - 60_000,
                 "near": ms(at) - draw(st.integers(0, 90)) * 1000}[unit]
        events.append((100 + i, at, etype, pid, stamp, p))
    for j in range(n_cmd):
        at = T0 + dt.timedelta(seconds=times[n_ev + j])
        op = draw(st.sampled_from(["set", "remove"]))
        pid = draw(st.sampled_from(["PA", "PB", "PA", "PB", "PC", " PB", "P$"]))
        p = draw(st.sampled_from([0.0, 120.0, 7.5])) if op == "set" else None
        commands.append((500 + j, at, pid, op, p))
    return events, commands


@st.composite
def removal_scenario(draw):
    """A set and a removal on one product, then events whose own timestamps sit
    around the removal time (seconds and milliseconds, both sides of it)."""
    events, commands = draw(scenario())
    t_set, t_rm = draw(st.integers(0, 40)), draw(st.integers(41, 80))
    pid = draw(st.sampled_from(["PA", "PB"]))
    rm = T0 + dt.timedelta(seconds=t_rm)
    commands = commands + [(900, T0 + dt.timedelta(seconds=t_set), pid, "set", 50.0),
                           (901, rm, pid, "remove", None)]
    for i in range(draw(st.integers(1, 6))):
        at = rm + dt.timedelta(seconds=draw(st.integers(0, 30)))
        delta = draw(st.integers(-2000, 2000))
        stamp = ms(rm) + delta if draw(st.booleans()) else (ms(rm) + delta) // 1000
        events.append((700 + i, at, "view", draw(st.sampled_from([pid, " " + pid])), stamp, 3.0))
    return events, commands


EV = ("event_seq bigint, arrival_ts timestamp, event_type string, product_id string, "
      "user_id string, timestamp bigint, price double")
CMD = "cmd_seq bigint, cmd_ts timestamp, product_id string, op string, override_price double, reason string"


def spark_run(spark, events, commands, cell):
    ev = spark.createDataFrame([(s, a, t, p, "u", ts, pr) for s, a, t, p, ts, pr in events], EV)
    cm = spark.createDataFrame([(s, a, p, op, pr, None) for s, a, p, op, pr in commands], CMD)
    cat = spark.createDataFrame(list(CATALOG.items()), "product_id string, base_price double")
    plan = PricingPlan(ev, cm, cat, rows_per_cell=cell)
    acc = {r.event_seq: (r.product_id, r.demand, r.new_price) for r in plan.priced.collect()}
    sets = sorted(r.cmd_seq for r in plan.effective.where("op = 'set'").collect())
    gates = {r.event_seq: r.gate for r in plan.gated.collect()}
    live = {r.product_id: (r.demand, r.price) for r in plan.live_state.collect()}
    ovr = {r.product_id: r.override_price for r in overrides.override_state(plan.effective).collect()}
    return acc, sets, gates, live, ovr


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(scenario(), removal_scenario()), st.sampled_from([100_000, 1]))
def test_plan_equals_sequential_model(spark, sc, cell):
    events, commands = sc
    m_acc, m_sets, m_gates, m_demand, m_price, m_row = model(events, commands)
    acc, sets, gates, live, ovr = spark_run(spark, events, commands, cell)
    assert acc.keys() == m_acc.keys()
    for k, (pid, d, p) in m_acc.items():
        assert acc[k][0] == pid and acc[k][1] == d and math.isclose(acc[k][2], p, rel_tol=0, abs_tol=0)
    assert sets == m_sets
    assert gates == m_gates
    assert ovr == m_row
    model_live = {k: (m_demand.get(k), m_price.get(k)) for k in set(m_demand) | set(m_price)}
    assert live == model_live
