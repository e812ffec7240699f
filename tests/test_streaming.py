"""Streaming: sources 1-2, sinks 5-7, stateful pricing 31 (stream equals batch)."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pricestream.operators import demand as D
from pricestream.operators import ingest
from pricestream.plans.pricing import PricingPlan
from pricestream.sources import fixtures
from pricestream.streaming import sinks
from pricestream.streaming import sources as S
from pricestream.streaming.sinks import PricingSinks, start_pricing_stream

from conftest import SF001


def _messages(spark, sf):
    pe = fixtures.product_events(spark, sf)
    cm = fixtures.override_commands(spark, sf)
    ev = S.envelope(pe, S.TOPIC_EVENTS, "event_seq", "arrival_ts",
                    F.to_json(F.struct("event_type", "product_id", "user_id", "timestamp", "price")))
    sets = S.envelope(cm.where("op = 'set'"), S.TOPIC_SET, "cmd_seq", "cmd_ts",
                      F.to_json(F.struct("product_id", "override_price", "reason")))
    rms = S.envelope(cm.where("op = 'remove'"), S.TOPIC_REMOVE, "cmd_seq", "cmd_ts", F.col("product_id"))
    return ev.unionByName(sets).unionByName(rms)


def _drop_files(pdf, inbox, chunks, root):
    """Write message chunks in arrival order, one Parquet file each (test fixture writer)."""
    for c in chunks:
        part = pdf[pdf.chunk == c].drop(columns=["chunk"])
        part = part.assign(arrival_ts=part["arrival_ts"].dt.tz_localize("UTC"))
        tmp = os.path.join(root, f"chunk{c}.parquet")
        part.to_parquet(tmp, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.rename(tmp, os.path.join(inbox, f"chunk{c}.parquet"))
        time.sleep(0.02)


def test_stream_equals_batch_with_restart(spark, tmp_dir):
    msgs = _messages(spark, SF001).withColumn("chunk", F.floor((F.dayofmonth("arrival_ts") - 1) / 10))
    pdf = msgs.toPandas()
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    cat = fixtures.catalog(spark, SF001)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    _drop_files(pdf, inbox, [0], tmp_dir)
    q = start_pricing_stream(S.message_stream(spark, inbox, max_files_per_trigger=1), cat, out, ckpt)
    q.awaitTermination()
    _drop_files(pdf, inbox, [1, 2], tmp_dir)          # restart from the checkpoint
    q = start_pricing_stream(S.message_stream(spark, inbox, max_files_per_trigger=1), cat, out, ckpt)
    q.awaitTermination()

    hist = spark.read.parquet(os.path.join(out, "price_history"))
    assert hist.select("batch_id").distinct().count() == 3
    dyn = hist.where("price_source = 'dynamic'").select(F.col("seq").alias("event_seq"), "product_id",
                                                        F.col("price").alias("new_price"))
    batch = PricingPlan.from_tables(spark, SF001).priced \
                       .select("event_seq", "product_id", "new_price")
    assert dyn.count() == batch.count() > 0
    assert dyn.exceptAll(batch).count() == 0 and batch.exceptAll(dyn).count() == 0

    # price-update messages: one per accepted event, JSON that re-parses to the same values
    ups = spark.read.json(os.path.join(out, "price_updates")).select("value")
    parsed = ingest.parse_price_updates(ups.withColumn("event_seq", F.lit(0)))
    assert parsed.count() == batch.count()

    # the latest live-state version has the final demand of every product seen
    last = sinks.live_state_table(spark, out).read()
    totals = PricingPlan.from_tables(spark, SF001).demand_totals
    a = last.where(F.col("demand").isNotNull()).select("product_id", "demand")
    assert a.exceptAll(totals).count() == 0 and totals.exceptAll(a).count() == 0


def test_replayed_batch_does_not_duplicate(spark, tmp_dir):
    import datetime as dt
    rows = [("dynamic", "PA", 1, dt.datetime(2024, 1, 1), 10.0, 1, 1704067200),
            ("override", "PA", 2, dt.datetime(2024, 1, 1, 0, 1), 20.0, None, None)]
    batch = spark.createDataFrame(rows, "kind string, product_id string, seq long, ts timestamp, "
                                        "price double, demand long, update_ts long")
    sink = PricingSinks(tmp_dir)
    sink(batch, 0)
    sink(batch, 0)                                      # replay of the same batch id
    hist = spark.read.parquet(os.path.join(tmp_dir, "price_history"))
    assert hist.count() == 2
    st = sinks.live_state_table(spark, tmp_dir).read().collect()
    assert [(r.product_id, r.demand, r.price) for r in st] == [("PA", 1, 20.0)]


def test_encode_price_update_reparses(spark):
    df = spark.createDataFrame([("PA", 115.0, 1700000000)], "product_id string, new_price double, timestamp long")
    from pricestream.functions import exprs as X
    text = df.select(X.encode_price_update().alias("v")).first().v
    assert json.loads(text) == {"product_id": "PA", "new_price": 115.0, "timestamp": 1700000000}


def test_update_stream_changed_products(spark, tmp_dir):
    from pricestream.operators import serving
    from pricestream.plans import queries as Q
    from pricestream.streaming.sinks import start_update_stream
    p = PricingPlan.from_tables(spark, SF001)
    msgs = S.envelope(Q.price_updates_json(spark, SF001, p).join(p.priced.select("event_seq", "arrival_ts"),
                                                                   "event_seq"),
                      S.TOPIC_UPDATES, "event_seq", "arrival_ts", F.col("value"))
    pdf = msgs.withColumn("chunk", F.lit(0)).toPandas()
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    _drop_files(pdf, inbox, [0], tmp_dir)
    shop = fixtures.catalog(spark, SF001)
    out = os.path.join(tmp_dir, "out")
    q = start_update_stream(S.message_stream(spark, inbox), shop, lambda ids: p.current, out,
                            os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(out, "changed_products")).drop("batch_id")
    ups = ingest.catalog_updates(Q._updates(spark, SF001, p), shop)
    want = serving.changed_product_snapshot(ups, p.current)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("cell", [100_000, 20])
def test_microbatch_engine_equals_batch(spark, tmp_dir, cell):
    from pricestream.streaming.microbatch import start_microbatch_pricing
    msgs = _messages(spark, SF001).withColumn("chunk", F.floor((F.dayofmonth("arrival_ts") - 1) / 8))
    pdf = msgs.toPandas()
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    cat = fixtures.catalog(spark, SF001)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    _drop_files(pdf, inbox, [0, 1], tmp_dir)
    kw = dict(rows_per_cell=cell)
    start_microbatch_pricing(S.message_stream(spark, inbox, max_files_per_trigger=1), cat, out, ckpt,
                             **kw).awaitTermination()
    _drop_files(pdf, inbox, [2, 3], tmp_dir)
    start_microbatch_pricing(S.message_stream(spark, inbox, max_files_per_trigger=1), cat, out, ckpt,
                             **kw).awaitTermination()
    hist = spark.read.parquet(os.path.join(out, "price_history"))
    assert hist.select("batch_id").distinct().count() == 4
    p = PricingPlan.from_tables(spark, SF001)
    dyn = hist.where("price_source = 'dynamic'").select(F.col("seq").alias("event_seq"), "product_id",
                                                        F.col("price").alias("new_price"))
    batch = p.priced.select("event_seq", "product_id", "new_price")
    assert dyn.exceptAll(batch).count() == 0 and batch.exceptAll(dyn).count() == 0
    ovr = hist.where("price_source = 'override'").select("product_id", "price", "event_time")
    want = p.history_core.where("price_source = 'override'").select("product_id", "price", "event_time")
    assert ovr.exceptAll(want).count() == 0 and want.exceptAll(ovr).count() == 0
    from pricestream.streaming.microbatch import current_prices, latest_state, recent_history, recent_table
    got = latest_state(spark, out).select("product_id", "demand", "price")
    assert got.exceptAll(p.live_state).count() == 0 and p.live_state.exceptAll(got).count() == 0
    from pricestream.operators import serving
    q = PricingPlan.from_tables(spark, SF001, run_ts=fixtures.RUN_TS, history_limit=3)
    top = serving.price_history_topn(recent_history(recent_table(spark, out).read(), cat, fixtures.RUN_TS), 3)
    assert top.exceptAll(q.topn).count() == 0 and q.topn.exceptAll(top).count() == 0
    now = current_prices(latest_state(spark, out))
    assert now.exceptAll(p.current).count() == 0 and p.current.exceptAll(now).count() == 0


def test_microbatch_engine_batch_without_events_keeps_state(spark, tmp_dir):
    import datetime as dt
    from pricestream.streaming.microbatch import MicroBatchPricing
    schema = "topic string, seq bigint, arrival_ts timestamp, value string"
    t = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([
        (S.TOPIC_EVENTS, 1, t, '{"event_type":"view","product_id":"PA","price":10.0,"timestamp":1}'),
        (S.TOPIC_SET, 2, t + dt.timedelta(seconds=5), '{"product_id":"PA","override_price":50.0}')], schema)
    other = spark.createDataFrame([(S.TOPIC_UPDATES, 3, t + dt.timedelta(seconds=9), '{"x":1}')], schema)
    cat = spark.createDataFrame([("PA", 299.0)], "product_id string, base_price double")
    sink = MicroBatchPricing(tmp_dir, cat)
    sink(first, 0)
    sink(other, 1)                                       # nothing to price in this batch
    from pricestream.streaming.microbatch import latest_state
    s0, s1 = ({r.product_id: r for r in latest_state(spark, tmp_dir, v).collect()} for v in (0, 1))
    assert s0 == s1 and s0["PA"].demand == 1 and s0["PA"].last_op == "set" and s0["PA"].override_price == 50.0
    assert spark.read.parquet(f"{tmp_dir}/price_history/batch_id=1").count() == 0


def test_microbatch_engine_replayed_batch_is_idempotent(spark, tmp_dir):
    import datetime as dt
    from pricestream.streaming.microbatch import MicroBatchPricing
    schema = "topic string, seq bigint, arrival_ts timestamp, value string"
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([
        (S.TOPIC_EVENTS, 1, t, '{"event_type":"cart","product_id":"PA","price":10.0,"timestamp":1}'),
        (S.TOPIC_EVENTS, 2, t + dt.timedelta(seconds=1), '{"event_type":"view","product_id":"PA","price":10.0}')],
        schema)
    cat = spark.createDataFrame([("PA", 299.0)], "product_id string, base_price double")
    sink = MicroBatchPricing(tmp_dir, cat)
    sink(batch, 0)
    sink(batch, 0)                                       # the same batch again after a failure
    hist = spark.read.parquet(f"{tmp_dir}/price_history")
    assert hist.count() == 2
    from pricestream.streaming.microbatch import latest_state
    state = latest_state(spark, tmp_dir, 0).collect()
    assert [(r.product_id, r.demand) for r in state] == [("PA", 4)]


def test_stream_job_command(spark, tmp_dir):
    from pricestream.plans import job
    msgs = _messages(spark, SF001).withColumn("chunk", F.lit(0))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    _drop_files(msgs.toPandas(), inbox, [0], tmp_dir)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    job.main(["stream", "--inbox", inbox, "--tables", SF001, "--out", out, "--checkpoint", ckpt,
              "--available-now"])
    priced = spark.read.parquet(os.path.join(out, "priced"))
    assert priced.count() == PricingPlan.from_tables(spark, SF001).priced.count()


MESSAGES = "topic string, seq bigint, arrival_ts timestamp, value string"


def _event(seq, sec, pid, own_ms=None, etype="cart"):
    import datetime as dt
    t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)
    ms = int(t.timestamp() * 1000) if own_ms is None else own_ms
    return (S.TOPIC_EVENTS, seq, t, json.dumps({"event_type": etype, "product_id": pid, "price": 10.0, "timestamp": ms}))


def _engines(spark, tmp_dir, batches):
    """Demand per product after the batches, from both engines and the batch plan."""
    from pricestream.streaming.microbatch import MicroBatchPricing, latest_state
    cat = spark.createDataFrame([("PA", 299.0), ("PZ", 7.0)], "product_id string, base_price double")
    sink = MicroBatchPricing(os.path.join(tmp_dir, "m"), cat)
    inbox, out = os.path.join(tmp_dir, "inbox"), os.path.join(tmp_dir, "s")
    os.makedirs(inbox)
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, MESSAGES)
        sink(df, i)
        df.coalesce(1).write.mode("append").parquet(inbox)
        start_pricing_stream(S.message_stream(spark, inbox), cat, out, os.path.join(tmp_dir, "c")).awaitTermination()
    one = {r.product_id: r.demand for r in latest_state(spark, os.path.join(tmp_dir, "m")).collect()}
    two = {}
    for r in sorted(spark.read.parquet(os.path.join(out, "priced")).collect(), key=lambda r: r.demand):
        two[r.product_id] = r.demand
    return one, two


def test_late_event_after_removal_is_judged_by_the_removal_time(spark, tmp_dir):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    base = int(t.timestamp() * 1000)
    first = [_event(1, 0, "PA"), (S.TOPIC_SET, 2, t + dt.timedelta(seconds=10), '{"product_id":"PA","override_price":50.0}'),
             (S.TOPIC_REMOVE, 3, t + dt.timedelta(seconds=100), "PA")]
    # arrives in a later batch with an earlier arrival time; its own time is after the removal
    late = [_event(4, 50, "PA", base + 200_000), _event(5, 51, "PA", base + 90_000)]
    one, two = _engines(spark, tmp_dir, [first, late])
    assert one["PA"] == two["PA"] == 6


def test_padded_ids_and_absurd_timestamps_on_both_engines(spark, tmp_dir):
    rows = [_event(1, 0, "PA"), _event(2, 1, " PA"), _event(3, 2, "PA", -(2 ** 63)), _event(4, 3, " PA", 2 ** 63 - 1)]
    one, two = _engines(spark, tmp_dir, [rows, [_event(5, 9, " PA"), _event(6, 9, "PA")]])
    assert one == {"PA": 9, " PA": 9, "PZ": 0} and two == {"PA": 9, " PA": 9}


def test_state_fails_closed_and_old_versions_go(spark, tmp_dir):
    import shutil

    from pricestream.session import checkpoint_dir
    from pricestream.streaming.microbatch import MicroBatchPricing
    cat = spark.createDataFrame([("PA", 299.0)], "product_id string, base_price double")
    sink = MicroBatchPricing(tmp_dir, cat)
    batch = spark.createDataFrame([_event(1, 0, "PA")], MESSAGES)
    tables = os.path.join(checkpoint_dir(spark), "pricestream-tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    for i in range(4):
        sink(batch, i)
    assert set(os.listdir(tables)) == before            # no intermediate table is left
    assert sorted(d for d in os.listdir(f"{tmp_dir}/state/manifest")) == ["version=2", "version=3"]
    with pytest.raises(RuntimeError):
        sink(batch, 0)                                   # a new stream over another run's state
    with pytest.raises(RuntimeError):
        sink(batch, 9)                                   # the state before it is not there


def test_renamed_topics_lose_no_event(spark):
    rows = [("my-events", 1, None, "a"), ("override-set", 2, None, "b")]
    df = spark.createDataFrame(rows, MESSAGES)
    named = S.with_own_names(df, {S.TOPIC_EVENTS: "my-events"})
    assert [r.value for r in S.product_event_stream(named).collect()] == ["a"]


def test_keyed_state_of_a_hot_product_follows_the_touched_keys(spark, tmp_dir):
    """One product has all rows of a batch, in many Arrow batches; the next batch touches one other product."""
    cat = spark.createDataFrame([("PA", 299.0), ("PZ", 7.0)], "product_id string, base_price double")
    inbox, out, ckpt = (os.path.join(tmp_dir, d) for d in ("inbox", "out", "ckpt"))
    batches = [[_event(i, i % 7, "PA", etype="view") for i in range(3000)], [_event(9000, 50, "PZ")],
               [_event(9001, 60, "PA")]]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        updated = []
        for rows in batches:
            spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(inbox)
            q = start_pricing_stream(S.message_stream(spark, inbox), cat, out, ckpt)     # a restart each time
            q.awaitTermination()
            updated.append(sum(op["numRowsUpdated"] for p in q.recentProgress for op in p["stateOperators"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    priced = spark.read.parquet(os.path.join(out, "priced"))
    hot = priced.where("product_id = 'PA'")
    want = sorted((i % 7, i) for i in range(3000))
    assert [r.event_seq for r in hot.where("event_seq < 9000").orderBy("demand").collect()] == [i for _, i in want]
    assert {r.event_seq: r.demand for r in priced.where("event_seq >= 9000").collect()} == {9000: 3, 9001: 3003}
    assert max(updated[1:]) <= 2                       # a gate and a raw id at most, whatever came before


def test_published_twice_is_read_once(spark, tmp_dir):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(S.TOPIC_UPDATES, i, t + dt.timedelta(seconds=i), json.dumps({"product_id": "PA", "new_price": 1.0 + i, "timestamp": 9}))
            for i in range(5)]
    inbox, out = os.path.join(tmp_dir, "inbox"), os.path.join(tmp_dir, "out")
    for _ in range(2):                                  # the batch is run again and publishes again
        spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(inbox)
        q = (S.price_update_stream(S.message_stream(spark, inbox), "1 hour").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    assert sorted(r.event_seq for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_outbox_is_replaced_by_a_replayed_batch(spark, tmp_dir):
    ups = spark.createDataFrame([(1, "a"), (2, "b")], "event_seq long, value string")
    for _ in range(2):
        sinks.publish_updates(ups, tmp_dir, 0)
    assert spark.read.json(os.path.join(tmp_dir, "price_updates")).count() == 2
