"""Skew-safe scans equal plain windows; plan shape checks."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricestream.operators import demand, ingest, overrides
from pricestream.operators.scan import CELL, WHOLE, Running, deal, running_last, running_sum, scan
from pricestream.plans import replay
from pricestream.plans.pricing import PricingPlan
from pricestream.sources import fixtures
from pricestream.sources.tables import read_table

from conftest import SF01

ORDER = ["arrival_ts", "event_seq"]


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plain(key="product_id", end=Window.currentRow):
    return Window.partitionBy(key).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, end)


@pytest.mark.parametrize("cell", [100_000, 50])
def test_running_sum_equals_plain_window_on_one_hot_key(spark, cell):
    ev = fixtures.product_events(spark, SF01).withColumn("product_id", F.lit("HOT")).withColumn("w", F.lit(1).cast("bigint"))
    a = ev.withColumn("d", F.sum("w").over(plain())).select("event_seq", "d")
    b = running_sum(ev, "product_id", ORDER, "w", "d", cell).select("event_seq", "d")
    assert same(a, b) and b.agg(F.max("d")).first()[0] == ev.count()


@pytest.mark.parametrize("cell", [100_000, 50])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_last_equals_plain_window(spark, cell, inclusive):
    ev = fixtures.product_events(spark, SF01)
    d = ev.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_seq")))
    a = d.withColumn("o", F.last("v", ignorenulls=True).over(plain(end=Window.currentRow if inclusive else -1)))
    b = running_last(d, "product_id", ORDER, "v", "o", inclusive, cell)
    assert same(a.select("event_seq", "o"), b.select("event_seq", "o"))


@pytest.mark.parametrize("cell", [100_000, 50])
def test_next_equals_plain_window(spark, cell):
    ev = fixtures.product_events(spark, SF01)
    d = ev.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_seq")))
    w = Window.partitionBy("product_id").orderBy(*ORDER).rowsBetween(1, Window.unboundedFollowing)
    a = d.withColumn("o", F.first("v", ignorenulls=True).over(w))
    b = scan(deal(d, "product_id", ORDER, cell), o=Running("next", "v"))
    assert same(a.select("event_seq", "o"), b.select("event_seq", "o"))


def test_intervals_cost_no_square_of_a_products_commands(spark):
    # a frame from each row to the end of its key is gone through anew for every row
    t = dt.datetime(2024, 1, 1)
    op = F.when(F.col("id") % 3 == 2, F.lit("remove")).otherwise(F.lit("set"))
    log = spark.range(3000).select(F.col("id").alias("cmd_seq"), F.lit(t).alias("cmd_ts"),
                                   F.lit("P1").alias("product_id"), op.alias("op"))
    for cell in (100_000, 500):
        done = overrides.override_intervals(log, cell)
        assert "unboundedfollowing" not in _plan_text(done).lower()
        assert done.where("removed_at IS NOT NULL").count() == done.count() == 1000


def test_cells_split_a_burst_evenly(spark):
    # all rows of one product in one second
    t = dt.datetime(2024, 1, 1)
    ev = spark.range(20_000).select(F.lit("P1").alias("product_id"), F.lit(t).alias("arrival_ts"),
                                    F.col("id").alias("event_seq"), F.lit(1).cast("bigint").alias("w"))
    sizes = [r["count"] for r in deal(ev, "product_id", ORDER, rows_per_cell=1000).cut.groupBy(CELL).count().collect()]
    assert 15 <= len(sizes) <= 20 and max(sizes) < 2500
    d = running_sum(ev, "product_id", ORDER, "w", "d", 1000)
    assert d.where("d <> event_seq + 1").count() == 0


def test_priced_does_not_depend_on_the_cells(spark):
    cols = ("event_seq", "product_id", "demand", "new_price")
    a = PricingPlan.from_tables(spark, SF01).priced.select(*cols)
    b = PricingPlan.from_tables(spark, SF01, rows_per_cell=40).priced.select(*cols)
    assert a.count() > 0 and same(a, b)


def test_single_hot_product_through_the_plan(spark):
    ev = fixtures.product_events(spark, SF01).withColumn("product_id", F.lit("P7"))
    cm = fixtures.override_commands(spark, SF01).withColumn("product_id", F.lit("P7"))
    cat = fixtures.catalog(spark, SF01)
    a = PricingPlan(ev, cm, cat).priced.select("event_seq", "demand", "new_price")
    b = PricingPlan(ev, cm, cat, rows_per_cell=200).priced.select("event_seq", "demand", "new_price")
    assert a.count() > 0 and same(a, b)


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    """Exchanges of the executed plan, by kind."""
    df.write.format("noop").mode("overwrite").save()
    text = _plan_text(df)
    return text.count("Exchange hashpartitioning"), text.count("Exchange rangepartitioning"), text


def test_event_side_is_shuffled_once(spark):
    p = PricingPlan.from_tables(spark, SF01, stream="lineitem", shared=False)
    p.effective
    hashed, ranged, text = _exchanges(p.priced.select("event_seq", "demand", "new_price"))
    # the gate and the demand read one exchange; no Python and no sample on the way
    assert (hashed, ranged) == (1, 0)
    assert "Python" not in text and "Arrow" not in text


def test_only_long_keys_are_cut(spark):
    t = dt.datetime(2024, 1, 1)
    pid = F.when(F.col("id") < 5000, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id") % 100))
    ev = spark.range(10_000).select(pid.alias("product_id"), F.lit(t).alias("arrival_ts"),
                                    F.col("id").alias("event_seq"), F.lit(1).cast("bigint").alias("w"))
    d = deal(ev, "product_id", ORDER, rows_per_cell=500)
    assert d.cut.select("product_id").distinct().collect() == [("HOT",)] and d.cut.count() == 5000
    assert d.rows.count() == 10_000 and d.rows.where(F.col(CELL) == WHOLE).count() == 5000
    out = running_sum(ev, "product_id", ORDER, "w", "d", 500)
    assert out.where("product_id = 'HOT' AND d <> event_seq + 1").count() == 0
    assert out.where("product_id <> 'HOT'").agg(F.max("d")).first()[0] == 50


def test_replay_reads_even_files_once(spark, monkeypatch):
    monkeypatch.setattr(replay, "ROWS_PER_FILE", 2_000)
    events = read_table(spark, SF01, "events")
    spread = replay.spread_events(spark, SF01, events.count())
    sizes = [r["count"] for r in spread.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.5 * min(sizes) and same(events, spread)
    messages = replay.table_messages(spark, SF01, spread)
    assert _plan_text(messages).count("FileScan") == 1
    topics = {r["topic"]: r["count"] for r in messages.groupBy("topic").count().collect()}
    kinds = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert topics == {"product-events": 10_000, "override-set": kinds["signup"], "override-remove": kinds["error"]}


def test_a_null_key_is_a_key(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.lit("A")).alias("product_id"), F.lit(t).alias("arrival_ts"),
                                 F.col("id").alias("event_seq"), F.lit(1).cast("bigint").alias("w"))
    a = ev.withColumn("d", F.sum("w").over(plain())).select("event_seq", "d")
    assert same(a, running_sum(ev, "product_id", ORDER, "w", "d", 100).select("event_seq", "d"))


def test_running_demand_equals_plain_window(spark):
    valid = ingest.valid_product_events(fixtures.product_events(spark, SF01))
    a = demand.with_weight(valid).withColumn("demand", F.sum("w").over(plain())).select("event_seq", "demand")
    b = demand.running_demand(valid, rows_per_cell=60).select("event_seq", "demand")
    assert a.count() == 5969 and same(a, b)


def test_valid_events_filter_reaches_scan(spark):
    ev = fixtures.product_events(spark, SF01)
    txt = _plan_text(ingest.valid_product_events(ev))
    pushed = txt.split("PushedFilters")[1][:300]
    assert "GreaterThan(value,0.0)" in pushed


def test_history_limit_texts_fixture_covers_variants(spark):
    t = fixtures.history_limit_texts(spark, SF01)
    assert t.count() == 10000


def test_fused_live_state_equals_operator_39(spark):
    p = PricingPlan.from_tables(spark, SF01)
    a, b = p.live_state, p.live_state_joined
    assert a.count() == 2161
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
