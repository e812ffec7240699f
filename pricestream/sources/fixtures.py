"""Deterministic inputs derived from the driver tables (see FIXTURES.md, part B).

The driver tables carry no product events, so these adapters define them:

- ``product_events`` from ``events``: one product event per row;
- ``override_commands`` from every ``signup`` / ``error`` row of ``events``;
- ``catalog`` from ``part`` (every part); some products (prefix X) are outside it;
- ``bench_events`` from ``lineitem`` (the ten times larger stream).

Everything is lazy; every column is computed by built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.session import ensure_utc
from pricestream.sources.tables import read_table

LATE_OFFSET_MS = 21_600_000          # six hours, for the late-event variant
SPLIT_TS = "2024-01-16 00:00:00"     # first / second half of the command log
CHANGED_SINCE_TS = "2024-01-29 00:00:00"
RUN_TS = "2024-02-01 00:00:00"       # fixed "now" for base rows without history


BENCH_TIES = ("tb_supplier", "tb_price", "tb_quantity", "tb_flag")


def _pid() -> Column:
    """P and the key in ``props``; users divisible by 29 look at products outside the catalog (X)."""
    prefix = F.when(F.col("user_id") % 29 == 0, F.lit("X")).otherwise(F.lit("P"))
    return F.concat(prefix, F.get_json_object(F.col("props"), "$.k"))


def event_columns() -> list[Column]:
    """event_seq, arrival_ts, event_type, product_id, user_id, timestamp, price of a row of ``events``."""
    arrival = F.col("ts").cast("timestamp")
    ms = F.unix_millis(arrival)
    seq = F.col("event_id")
    stamp = (F.when(seq % 10 == 0, ms - F.lit(LATE_OFFSET_MS))
             .when(seq % 499 == 7, F.lit(-(2 ** 63)))
             .when(seq % 499 == 8, F.lit(2 ** 63 - 1))
             .when(seq % 2 == 0, F.unix_seconds(arrival))
             .otherwise(ms))
    # some ids come padded: the gate reads them trimmed, demand counts them as they are
    pid = F.when(seq % 23 == 3, F.concat(F.lit(" "), _pid(), F.lit("\t"))).otherwise(_pid())
    return [
        seq.alias("event_seq"),
        arrival.alias("arrival_ts"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
         .otherwise(F.col("event_type")).alias("event_type"),
        pid.alias("product_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
        stamp.cast("bigint").alias("timestamp"),
        F.col("value").alias("price"),
    ]


def is_command() -> Column:
    return F.col("event_type").isin("signup", "error")


def command_columns() -> list[Column]:
    """cmd_seq, cmd_ts, product_id, op, override_price, reason of a row of ``events`` that is a command."""
    is_set = F.col("event_type") == "signup"
    return [F.col("event_id").alias("cmd_seq"),
            F.col("ts").cast("timestamp").alias("cmd_ts"),
            _pid().alias("product_id"),
            F.when(is_set, F.lit(K.OP_SET)).otherwise(F.lit(K.OP_REMOVE)).alias("op"),
            F.when(is_set, F.col("value")).cast("double").alias("override_price"),
            F.when(F.col("event_id") % 2 == 0, F.lit(None).cast("string"))
             .otherwise(F.lit("campaign")).alias("reason")]


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_seq, arrival_ts, event_type, product_id, user_id, timestamp, price."""
    ensure_utc(spark)
    return read_table(spark, sf_dir, "events").select(*event_columns())


def override_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cmd_seq, cmd_ts, product_id, op, override_price, reason."""
    ensure_utc(spark)
    return read_table(spark, sf_dir, "events").where(is_command()).select(*command_columns())


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, base_price for every part."""
    part = read_table(spark, sf_dir, "part")
    return part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
                       F.col("p_retailprice").alias("base_price"))


def bench_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product events from lineitem: A/R/N -> view/cart/purchase.

    (l_orderkey, l_linenumber) repeats, so the supplier, price, quantity and flag break ties
    of the arrival order (``BENCH_TIES``); rows equal in these too are interchangeable.
    """
    ensure_utc(spark)
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    etype = (F.when(flag == "A", F.lit("view")).when(flag == "R", F.lit("cart"))
             .when(flag == "N", F.lit("purchase")).otherwise(flag))
    arrival = F.col("l_shipdate").cast("timestamp")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("event_seq"),
        arrival.alias("arrival_ts"),
        etype.alias("event_type"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("user_id"),
        F.unix_millis(arrival).alias("timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_suppkey").cast("bigint").alias("tb_supplier"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("tb_price"),
        F.round(F.col("l_quantity") * 100).cast("bigint").alias("tb_quantity"),
        F.ascii(flag).cast("bigint").alias("tb_flag"),
    )


def product_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_seq, arrival_ts, value: product events as JSON message text.

    Variants by event_seq: %11 truncated (malformed), %7 without user_id,
    %13 with an unknown extra field, %17 with a white-space product id.
    """
    pe = product_events(spark, sf_dir)
    seq = F.col("event_seq")
    pid = F.when(seq % 17 == 0, F.lit("\t ")).otherwise(F.col("product_id")).alias("product_id")
    base = [F.col("event_type"), pid, F.col("user_id"), F.col("timestamp"), F.col("price")]
    full = F.to_json(F.struct(*base))
    no_user = F.to_json(F.struct(F.col("event_type"), pid, F.col("timestamp"), F.col("price")))
    extra = F.to_json(F.struct(*base, F.lit("x").alias("note")))
    text = F.when(seq % 7 == 0, no_user).when(seq % 13 == 0, extra).otherwise(full)
    cut = F.when(seq % 11 == 0, F.expr("substring(__t, 1, length(__t) - 1)")).otherwise(F.col("__t"))
    return (pe.withColumn("__t", text)
              .select("event_seq", "arrival_ts", cut.alias("value")))


def history_limit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_seq, raw: limit query texts, one per event, from its user id and type (blank,
    padded, signed, non-numeric, negative and overflowing ones)."""
    ev = read_table(spark, sf_dir, "events")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    raw = (F.when(kind == "view", F.concat(F.lit(" "), user, F.lit("\t")))
           .when(kind == "click", F.concat(F.lit("+"), user))
           .when(kind == "purchase", F.concat(F.lit("-"), user))
           .when(kind == "signup", F.concat(user, F.lit("0000000000000000000000")))
           .when(F.col("user_id") % 2 == 0, F.lit(" \t"))
           .otherwise(F.concat(kind, user)))
    return ev.select(F.col("event_id").alias("event_seq"), raw.alias("raw"))


def price_source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_seq, raw: source texts from the event type (missing, blank, padded)."""
    ev, kind = read_table(spark, sf_dir, "events"), F.col("event_type")
    raw = (F.when(kind == "signup", F.lit(None).cast("string")).when(kind == "error", F.lit("\t \t"))
           .otherwise(F.concat(F.lit(" "), kind, F.lit("\t"))))
    return ev.select(F.col("event_id").alias("event_seq"), raw.alias("raw"))


def override_reason_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_seq, raw: reason texts from user and props (missing, blank, padded)."""
    ev, user = read_table(spark, sf_dir, "events"), F.col("user_id")
    raw = (F.when(user % 4 == 0, F.lit(None).cast("string")).when(user % 4 == 1, F.lit("   "))
           .otherwise(F.concat(F.lit(" by "), user.cast("string"), F.lit(": "), F.col("props"), F.lit(" "))))
    return ev.select(F.col("event_id").alias("event_seq"), raw.alias("raw"))
