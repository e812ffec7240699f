"""Decode, validate and filter: operators 8-10, 12, 13, 15."""

import pytest
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.operators import ingest


def decode_one(spark, text):
    df = spark.createDataFrame([(1, text)], "event_seq bigint, value string")
    return ingest.decode_events(df, keep=("event_seq",)).first().asDict()


GOOD = '{"event_type":"view","product_id":"PA","user_id":"u1","timestamp":1700000000,"price":2.5}'


def test_decode_good_and_zero_values(spark):
    r = decode_one(spark, GOOD)
    assert r["decoded"] and r["event_type"] == "view" and r["price"] == 2.5 and r["timestamp"] == 1700000000
    r = decode_one(spark, '{"event_type":"cart","product_id":"PB","price":3,"extra":{"a":[1]}}')
    assert r["decoded"] and r["user_id"] == "" and r["timestamp"] == 0 and r["price"] == 3.0
    r = decode_one(spark, '{"event_type":null,"product_id":"PA"}')
    assert r["decoded"] and r["event_type"] == ""


@pytest.mark.parametrize("text", [
    '{"event_type":"view"',                       # truncated
    '{"event_type":"view","price":NaN}',          # NaN literal
    "{'event_type':'view'}",                      # single quotes
    '[1]',                                        # array root
    '{"event_type":"view","price":"2"}',          # price as string
    '{"event_type":"view","timestamp":1.5}',      # fractional timestamp
    '{"event_type":"view","product_id":7}',       # id as number
    '{"event_type":"view","price":1e400}',        # out of double range
    '{"event_type":"view"} x',                    # trailing text
    '{"event_type":"view"}{"a":1}',               # second object
    '{"event_type":"view"}]',                     # stray bracket
    '',                                           # empty text
    '{"event_type":"view","timestamp":99999999999999999999}',  # int64 overflow
])
def test_decode_rejects(spark, text):
    assert decode_one(spark, text)["decoded"] is False


def test_json_null_document_is_zero_event(spark):
    r = decode_one(spark, "null")
    assert r["decoded"] and r["event_type"] == "" and r["price"] == 0.0


def rejects(spark, rows):
    df = spark.createDataFrame(rows, "event_seq bigint, value string")
    out = ingest.rejected_product_events(ingest.decode_events(df, keep=("event_seq",)))
    return {r["event_seq"]: r["reason"] for r in out.collect()}


def test_reject_reasons_in_rule_order(spark):
    rows = [(1, '{"event_type":"click","product_id":"PA","price":1}'),
            (2, '{"event_type":"view","product_id":"  ","price":1}'),
            (3, '{"event_type":"view","product_id":"PA","price":0}'),
            (4, '{"event_type":"view","product_id":"PA","price":-2}'),
            (5, '{"event_type":"click","product_id":" ","price":0}'),   # first rule wins
            (6, '{"event_type":"view","product_id":"\\u3000","price":1}'),
            (7, '{"event_type":"view"'),
            (8, '{"event_type":"View","product_id":"PA","price":1}'),     # case-sensitive
            (9, GOOD)]
    assert rejects(spark, rows) == {1: K.REASON_EVENT_TYPE, 2: K.REASON_PRODUCT_ID, 3: K.REASON_PRICE,
                                    4: K.REASON_PRICE, 5: K.REASON_EVENT_TYPE, 6: K.REASON_PRODUCT_ID,
                                    7: K.REASON_DECODE, 8: K.REASON_EVENT_TYPE}


def test_valid_predicate_pushes_into_scan(spark):
    from pricestream.sources import tables
    ev = tables.read_table(spark, "/root/testdata/sf0.001", "events")
    plan = ev.where(ingest.valid_predicate("event_type", F.lit("PA"), "value"))._jdf \
             .queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "event_type" in plan.split("PushedFilters")[1][:200]


def test_parse_price_updates(spark):
    rows = [(1, '{"product_id":" PA ","new_price":10.5,"timestamp":1700000000}'),
            (2, '{"product_id":"PA","new_price":10.5,"timestamp":1700000000'),   # truncated
            (3, '{"product_id":"  ","new_price":10.5,"timestamp":1700000000}'),  # blank id
            (4, '{"product_id":"PA","new_price":0,"timestamp":1700000000}'),     # zero price
            (5, '{"product_id":"PA","new_price":10.5,"timestamp":0}')]           # zero timestamp
    df = spark.createDataFrame(rows, "event_seq bigint, value string")
    out = ingest.parse_price_updates(df).collect()
    assert [(r.event_seq, r.type, r.product_id, r.new_price, r.timestamp) for r in out] == \
           [(1, "price_update", "PA", 10.5, 1700000000)]


def test_catalog_updates_semi_join(spark):
    ups = spark.createDataFrame([(1, "price_update", "PA", 1.0, 5), (2, "price_update", "PZ", 1.0, 5),
                                 (3, "other", "PA", 1.0, 5)],
                                "event_seq bigint, type string, product_id string, new_price double, timestamp bigint")
    cat = spark.createDataFrame([("PA", 1.0)], "product_id string, base_price double")
    assert [r.event_seq for r in ingest.catalog_updates(ups, cat).collect()] == [1]


def commands(spark, rows):
    return spark.createDataFrame(rows, "cmd_seq bigint, cmd_ts timestamp, product_id string, op string, "
                                       "override_price double, reason string")


def test_valid_override_commands(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, " PA ", "set", 149.99, None), (2, t, "PA$", "set", 10.0, "x"), (3, t, "PA", "set", 0.0, "x"),
            (4, t, "PA", "remove", None, None), (5, t, " PA", "remove", None, None),
            (6, t, "PB", "set", 1.0, "  promo ")]
    out = {r.cmd_seq: (r.product_id, r.reason) for r in ingest.valid_override_commands(commands(spark, rows)).collect()}
    assert out == {1: ("PA", "manual override"), 4: ("PA", None), 6: ("PB", "promo")}


def test_override_request_decoding(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, '{"product_id":"PA","override_price":188.75}'),
            (2, t, '{"product_id":"PA","override_price":"bad"}'),
            (3, t, '{"product_id":"PA","override_price":1,"extra":1}'),    # unknown field
            (4, t, '{"product_id":"PA","override_price":1} {}'),            # trailing object
            (5, t, '{"product_id":"PA","override_price":2,"reason":"r"}')]
    df = spark.createDataFrame(rows, "cmd_seq bigint, cmd_ts timestamp, value string")
    out = ingest.decode_override_requests(df)
    assert sorted((r.cmd_seq, r.override_price) for r in out.collect()) == [(1, 188.75), (5, 2.0)]


def test_json_keys_in_any_case_and_last_key_wins(spark):
    texts = ['{"EVENT_TYPE":"view","Product_Id":"PA","PRICE":2.5,"timestamp":7}',
             '{"event_type":"view","product_id":"PA","price":1.0,"PRICE":3.0}',
             '{"event_type":"view","product_id":"a \\"PRICE\\": b","price":1.0}']
    raw = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "event_seq long, arrival_ts timestamp, value string")
    got = {r.event_seq: (r.event_type, r.product_id, r.price, r.timestamp) for r in ingest.decode_product_events(raw).collect()}
    assert got == {0: ("view", "PA", 2.5, 7), 1: ("view", "PA", 3.0, 0), 2: ("view", 'a "PRICE": b', 1.0, 0)}
    body = spark.createDataFrame([(1, None, '{"PRODUCT_ID":"PA","Override_Price":5.0}'), (2, None, '{"product_id":"PA","OTHER":1}')],
                                 "cmd_seq long, cmd_ts timestamp, value string")
    assert [(r.cmd_seq, r.override_price) for r in ingest.decode_override_requests(body).collect()] == [(1, 5.0)]
