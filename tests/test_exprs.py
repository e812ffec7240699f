"""Scalar operators 11, 16-25 (literal cases carried over from the reference tests)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pricestream.functions import exprs as X


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("etype,weight", [("view", 1), ("cart", 3), ("purchase", 5),
                                          ("random", None), ("View", None), (None, None)])
def test_demand_weight(spark, etype, weight):
    assert one(spark, X.demand_weight(F.col("v")), etype) == weight


def test_compute_price_literal(spark):
    df = spark.createDataFrame([(100.0, 9)], "p double, d bigint")
    assert df.select(X.compute_price("p", "d")).first()[0] == 115.0
    df = spark.createDataFrame([(10.0, 2)], "p double, d bigint")
    assert df.select(X.compute_price("p", "d")).first()[0] == 10.0 + math.sqrt(2) * 5


@pytest.mark.parametrize("ts,ms", [(1_700_000_000, 1_700_000_000_000),
                                   (1_700_000_000_123, 1_700_000_000_123),
                                   (999_999_999_999, 999_999_999_999_000),
                                   (1_000_000_000_000, 1_000_000_000_000),
                                   (0, 0), (None, 0)])
def test_normalize_event_ms(spark, ts, ms):
    assert one(spark, X.normalize_event_ms(F.col("v")), ts, "v bigint") == ms


@pytest.mark.parametrize("raw,out", [(" PA\t", "PA"), ("　PA ", "PA"), ("\u0085PA ", "PA"),
                                     ("\x0bPA\n\r", "PA"), ("P A", "P A"), ("  ", ""), ("PA", "PA"),
                                     ("​PA", "​PA")])
def test_trim_unicode(spark, raw, out):
    # U+200B (zero width space) is not white space, so it stays.
    assert one(spark, X.trim_unicode(F.col("v")), raw) == out


def test_spark_trim_differs(spark):
    assert one(spark, F.trim(F.col("v")), "\t a ") == "\t a"
    assert one(spark, X.trim_unicode(F.col("v")), "\t a ") == "a"


@pytest.mark.parametrize("pid,ok", [("PA", True), ("P_a-9", True), ("PA$", False), ("PA\n", False),
                                    ("", False), (" PA", False), (None, False), ("PÄ", False)])
def test_valid_product_id(spark, pid, ok):
    assert one(spark, X.valid_product_id(F.col("v")), pid) is ok


@pytest.mark.parametrize("raw,lim", [(None, 50), ("", 50), ("  ", 50), ("7", 7), (" 25 ", 25),
                                     ("+7", 7), ("999", 500), ("500", 500), ("abc", None), ("0", None),
                                     ("-3", None), ("1.5", None), ("99999999999999999999", None),
                                     ("9999999999", 500)])
def test_history_limit_column(spark, raw, lim):
    assert one(spark, X.history_limit(F.col("v")), raw) == lim


def test_history_limit_driver_side():
    assert X.check_history_limit(None) == 50
    assert X.check_history_limit("") == 50
    assert X.check_history_limit("999") == 500
    assert X.check_history_limit(" 2 ") == 2
    for bad in ("abc", "0", "-1", "1.5", "+", "99999999999999999999"):
        with pytest.raises(ValueError):
            X.check_history_limit(bad)


@pytest.mark.parametrize("s,out", [(None, "dynamic"), ("", "dynamic"), ("  ", "dynamic"),
                                   (" override ", "override"), ("base", "base")])
def test_default_price_source(spark, s, out):
    assert one(spark, X.default_price_source(F.col("v")), s) == out


@pytest.mark.parametrize("s,out", [(None, "manual override"), ("", "manual override"),
                                   ("\t", "manual override"), (" promo ", "promo")])
def test_default_override_reason(spark, s, out):
    assert one(spark, X.default_override_reason(F.col("v")), s) == out


@pytest.mark.parametrize("p,out", [(1.234, 1.23), (1.235, 1.24), (2.0, 2.0), (129.999, 130.0)])
def test_round_price_2dp(spark, p, out):
    assert one(spark, X.round_price_2dp(F.col("v")), p, "v double") == out


def test_base_seed_time(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    r = one(spark, X.base_seed_time(F.col("v")), t, "v timestamp")
    assert r == dt.datetime(2023, 12, 31, 23, 59, 59, 999000)


def test_update_timestamp_s(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 1, 999999)
    assert one(spark, X.update_timestamp_s(F.col("v")), t, "v timestamp") == 1704067201
