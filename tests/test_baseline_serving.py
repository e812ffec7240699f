"""Seeding (39, 40) and serving views (3, 41-47)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricestream.operators import baseline, serving

T0 = dt.datetime(2024, 1, 1)
HIST = "product_id string, price double, price_source string, event_time timestamp, seq bigint"


def at(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_seed_only_missing_values(spark):
    cat = spark.createDataFrame([("PB", 349.0), ("PA", 299.0)], "product_id string, base_price double")
    live = spark.createDataFrame([("PB", 4, None)], "product_id string, demand bigint, price double")
    out = {r.product_id: (r.demand, r.price) for r in baseline.seed_live_state(cat, live).collect()}
    assert out == {"PA": (0, 299.0), "PB": (4, 349.0)}
    live2 = spark.createDataFrame([("PB", 4, 400.0), ("PX", 1, 5.0)], "product_id string, demand bigint, price double")
    out2 = {r.product_id: (r.demand, r.price) for r in baseline.seed_live_state(cat, live2).collect()}
    assert out2 == {"PA": (0, 299.0), "PB": (4, 400.0), "PX": (1, 5.0)}
    # idempotent: seeding the seeded state changes nothing
    again = baseline.seed_live_state(cat, baseline.seed_live_state(cat, live2))
    assert {r.product_id: (r.demand, r.price) for r in again.collect()} == out2


def test_missing_base_price_fails(spark):
    cat = spark.createDataFrame([("PA", None)], "product_id string, base_price double")
    live = spark.createDataFrame([], "product_id string, demand bigint, price double")
    with pytest.raises(Exception, match="catalog base price missing for PA"):
        baseline.seed_live_state(cat, live).collect()


def test_base_history_backfill_is_idempotent(spark):
    cat = spark.createDataFrame([("PA", 299.0), ("PB", 349.0), ("PC", 129.0)], "product_id string, base_price double")
    hist = spark.createDataFrame([("PA", 300.0, "dynamic", at(10), 1), ("PA", 301.0, None, at(5), 2),
                                  ("PC", 1.0, "base", at(1), -1)], HIST)
    run_ts = "2024-02-01 00:00:00"
    base = baseline.base_price_history(cat, hist, run_ts)
    rows = {r.product_id: (r.price, r.price_source, r.event_time) for r in base.collect()}
    assert rows == {"PA": (299.0, "base", at(5) - dt.timedelta(milliseconds=1)),
                    "PB": (349.0, "base", dt.datetime(2024, 2, 1))}
    assert baseline.base_price_history(cat, hist.unionByName(base), run_ts).count() == 0


def test_topn_latest_first_with_defaulted_source(spark):
    hist = spark.createDataFrame([("PA", 1.0, "dynamic", at(1), 1), ("PA", 2.0, None, at(2), 2),
                                  ("PA", 3.0, "override", at(3), 3), ("PB", 9.0, "base", at(0), -1)], HIST)
    top = serving.price_history_topn(hist, 2, product_id="PA").collect()
    assert [(r.rn, r.price, r.price_source) for r in top] == [(1, 3.0, "override"), (2, 2.0, "dynamic")]
    allp = serving.price_history_topn(hist, "999")
    assert allp.count() == 4
    with pytest.raises(ValueError):
        serving.price_history_topn(hist, "abc")


def test_topn_uses_window_group_limit(spark):
    hist = spark.createDataFrame([("PA", 1.0, "dynamic", at(1), 1)], HIST)
    plan = serving.price_history_topn(hist, 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_current_price_override_precedence(spark):
    live = spark.createDataFrame([("PA", 9, None), ("PB", 3, 120.5), ("PC", None, 5.0), ("PD", 2, None),
                                  (" PE", 1, 1.0)],
                                 "product_id string, demand bigint, price double")
    ovr = spark.createDataFrame([("PA", 188.75)], "product_id string, override_price double")
    out = {r.product_id: (r.price, r.demand, r.price_source) for r in serving.current_price(live, ovr).collect()}
    # PC has no demand entry and PD no price: both absent; " PE" is not a servable id
    assert out == {"PA": (188.75, 9, "override"), "PB": (120.5, 3, "dynamic")}


def test_chart_series_cut_after_last_override_when_active(spark):
    hist = spark.createDataFrame([("PA", 1.004, "base", at(0), -1), ("PA", 2.0, "override", at(1), 1),
                                  ("PA", 3.0, "dynamic", at(2), 2), ("PB", 1.0, "override", at(1), 1),
                                  ("PB", 2.0, "dynamic", at(2), 2)], HIST)
    top = serving.price_history_topn(hist, 50)
    cur = spark.createDataFrame([("PA", 2.0, 1, "override"), ("PB", 2.0, 1, "dynamic")],
                                "product_id string, price double, demand bigint, price_source string")
    s = sorted((r.product_id, r.pos, r.price, r.price_source) for r in serving.price_chart_series(top, cur).collect())
    assert s == [("PA", 1, 1.0, "base"), ("PA", 2, 2.0, "override"),
                 ("PB", 1, 1.0, "override"), ("PB", 2, 2.0, "dynamic")]
    flags = {r.product_id: (r.has_base, r.has_override) for r in serving.history_source_flags(top).collect()}
    assert flags == {"PA": (True, True), "PB": (False, True)}


def test_known_products_and_history_exists(spark):
    live = spark.createDataFrame([("PA", 0, None), ("PB", None, 1.0), ("PC", None, None)],
                                 "product_id string, demand bigint, price double")
    assert sorted(r.product_id for r in serving.known_products(live).collect()) == ["PA", "PB"]
    cat = spark.createDataFrame([("PA", 1.0), ("PB", 1.0)], "product_id string, base_price double")
    hist = spark.createDataFrame([("PA", 1.0, "dynamic", at(0), 1)], HIST)
    assert {r.product_id: r.has_history for r in serving.history_exists(cat, hist).collect()} == \
           {"PA": True, "PB": False}


def test_changed_product_snapshot(spark):
    cur = spark.createDataFrame([("PA", 2.0, 1, "dynamic"), ("PB", 3.0, 1, "dynamic")],
                                "product_id string, price double, demand bigint, price_source string")
    ups = spark.createDataFrame([("PB",), ("PB",)], "product_id string")
    assert [r.product_id for r in serving.changed_product_snapshot(ups, cur).collect()] == ["PB"]


def test_batch_job_writes_tables_idempotently(spark, tmp_dir):
    from pricestream.plans.pricing import PricingPlan
    from conftest import SF001
    p = PricingPlan.from_tables(spark, SF001)
    p.write(tmp_dir)
    p.write(tmp_dir)                                   # re-run: same tables, no duplicates
    hist = spark.read.parquet(f"{tmp_dir}/price_history")
    assert hist.count() == p.history.count()
    assert hist.select("event_date").distinct().count() > 1
    assert hist.where("price_source = 'base'").count() == p.catalog.count()
    cur = spark.read.parquet(f"{tmp_dir}/current_price")
    assert cur.exceptAll(p.current).count() == 0 and p.current.exceptAll(cur).count() == 0
    assert spark.read.parquet(f"{tmp_dir}/price_overrides").count() == p.overrides.count()


def test_second_run_adds_no_second_base_row(spark, tmp_dir):
    from pricestream.plans.pricing import PricingPlan
    ev = "event_seq bigint, arrival_ts timestamp, event_type string, product_id string, user_id string, timestamp bigint, price double"
    cm = "cmd_seq bigint, cmd_ts timestamp, product_id string, op string, override_price double, reason string"
    cat = spark.createDataFrame([("PA", 10.0), ("PZ", 7.0)], "product_id string, base_price double")
    rows = [(1, at(10), "view", "PA", "u", 1, 10.0)]
    none = spark.createDataFrame([], cm)
    for events, now in ((rows, "2024-03-01 00:00:00"), (rows + [(2, at(20), "view", "PZ", "u", 1, 7.0)], "2024-03-02 00:00:00")):
        PricingPlan(spark.createDataFrame(events, ev), none, cat, run_ts=now).write(tmp_dir)
    base = spark.read.parquet(f"{tmp_dir}/price_history").where("price_source = 'base'").collect()
    assert sorted(r.product_id for r in base) == ["PA", "PZ"]
    assert spark.read.parquet(f"{tmp_dir}/price_history").where("price_source = 'dynamic'").count() == 2


def test_single_product_lookups(spark):
    from pricestream.operators import overrides
    live = spark.createDataFrame([("PA", 9, 1.0), ("PB", 3, 120.5)], "product_id string, demand bigint, price double")
    ovr = spark.createDataFrame([("PA", 188.75, None, at(0))],
                                "product_id string, override_price double, reason string, set_time timestamp")
    one = serving.current_price(live, ovr, product_id="PA").collect()
    assert [(r.product_id, r.price, r.price_source) for r in one] == [("PA", 188.75, "override")]
    snap = overrides.price_overrides_snapshot(ovr, product_id="PA").collect()
    assert [(r.product_id, r.reason) for r in snap] == [("PA", "")]
    assert overrides.price_overrides_snapshot(ovr, product_id="PB").count() == 0


def test_batch_job_command(spark, tmp_dir):
    from pricestream.plans import job
    from conftest import SF001
    job.main(["batch", "--tables", SF001, "--out", tmp_dir])
    cur = spark.read.parquet(f"{tmp_dir}/current_price")
    assert cur.count() >= 200 and spark.read.parquet(f"{tmp_dir}/rejected_events").count() > 0
    assert set(cur.columns) == {"product_id", "price", "demand", "price_source"}


def test_lookup_reads_a_bounded_number_of_row_groups(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from pricestream.plans.pricing import write_by_product
    df = spark.range(5000).select(F.concat(F.lit("P"), (F.col("id") * 7 % 5000).cast("string")).alias("product_id"),
                                  F.col("id").alias("demand"), F.lit(1.0).alias("price"))
    write_by_product(df, tmp_dir, rows_per_group=100)
    groups = [pq.ParquetFile(f).metadata.row_group(g).column(0).statistics for f in glob.glob(f"{tmp_dir}/*.parquet")
              for g in range(pq.ParquetFile(f).num_row_groups)]
    assert len(groups) >= 40
    for pid in ("P0", "P77", "P4999", "absent"):
        assert sum(s.min <= pid <= s.max for s in groups) <= 1
    one = serving.current_price(spark.read.parquet(tmp_dir), spark.createDataFrame([], "product_id string, override_price double"),
                                "P77")
    assert one.count() == 1 and "EqualTo(product_id,P77)" in one._jdf.queryExecution().executedPlan().toString()
