"""One Spark query per operator key of the inventory, over the driver tables.

Each function takes (spark, sf_dir) and returns a lazy DataFrame whose column
names and types match the DuckDB SQL of ``plans/oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.operators import demand, ingest, overrides, serving
from pricestream.plans.pricing import PricingPlan, normalize_output
from pricestream.session import checkpoint_dir
from pricestream.sources import fixtures
from pricestream.streaming import sources as S

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize_output(fn(spark, sf_dir))
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    _REGISTRY[fn.__name__] = wrapped
    return wrapped


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _plan(spark: SparkSession, sf_dir: str, **kw) -> PricingPlan:
    """The batch plan over the events fixture."""
    return PricingPlan.from_tables(spark, sf_dir, run_ts=fixtures.RUN_TS, **kw)


def price_updates_json(spark: SparkSession, sf_dir: str, plan: PricingPlan | None = None) -> DataFrame:
    """event_seq, value: price-update messages of the accepted events, with
    variants by event_seq % 7: 1 blank id, 2 zero price, 3 zero timestamp,
    4 truncated text, 5 id padded with white space."""
    p = plan or _plan(spark, sf_dir)
    seq = F.col("event_seq")
    pid = (F.when(seq % 7 == 1, F.lit("  "))
           .when(seq % 7 == 5, F.concat(F.lit(" "), F.col("product_id"), F.lit("\t")))
           .otherwise(F.col("product_id")))
    price = F.when(seq % 7 == 2, F.lit(0.0)).otherwise(F.col("new_price"))
    ts = F.when(seq % 7 == 3, F.lit(0).cast("bigint")).otherwise(F.col("update_ts"))
    txt = X.encode_price_update(pid, price, ts)
    return (p.priced.select("event_seq", txt.alias("__t"))
                    .select("event_seq",
                            F.when(seq % 7 == 4, F.expr("substring(__t, 1, length(__t) - 1)"))
                             .otherwise(F.col("__t")).alias("value")))


def _updates(spark: SparkSession, sf_dir: str, plan: PricingPlan | None = None) -> DataFrame:
    return ingest.parse_price_updates(price_updates_json(spark, sf_dir, plan))


# --- 2.1 sources -----------------------------------------------------------

@query
def catalog_prices(spark, sf_dir):
    return serving.catalog_prices(fixtures.catalog(spark, sf_dir))


@query
def price_overrides_snapshot(spark, sf_dir):
    return overrides.price_overrides_snapshot(_plan(spark, sf_dir).overrides)


# --- 2.2 decode, validate, filter ------------------------------------------

@query
def decode_product_events(spark, sf_dir):
    raw = fixtures.product_event_json(spark, sf_dir)
    return ingest.decode_product_events(raw).select(
        "event_seq", "event_type", "product_id", "user_id", "timestamp", "price")


@query
def valid_product_events(spark, sf_dir):
    return ingest.valid_product_events(fixtures.product_events(spark, sf_dir)).select(
        "event_seq", "arrival_ts", "event_type", "product_id", "user_id", "timestamp", "price")


@query
def rejected_product_events(spark, sf_dir):
    return ingest.rejected_product_events(ingest.decode_events(fixtures.product_event_json(spark, sf_dir)))


@query
def valid_product_id(spark, sf_dir):
    pe = fixtures.product_events(spark, sf_dir)
    seq, pid = F.col("event_seq"), F.col("product_id")
    v = (F.when(seq % 5 == 0, F.lit(""))
         .when(seq % 5 == 1, F.concat(pid, F.lit("$")))
         .when(seq % 5 == 2, F.concat(pid, F.lit("\n")))
         .when(seq % 5 == 3, F.concat(F.lit(" "), pid))
         .otherwise(pid))
    return pe.select("event_seq", v.alias("product_id")).select(
        "event_seq", "product_id", X.valid_product_id(F.col("product_id")).alias("is_valid"))


@query
def parse_price_updates(spark, sf_dir):
    return _updates(spark, sf_dir)


@query
def valid_override_commands(spark, sf_dir):
    return ingest.valid_override_commands(fixtures.override_commands(spark, sf_dir)).select(
        "cmd_seq", "op", "product_id", "override_price", "reason")


@query
def known_product_commands(spark, sf_dir):
    valid_cmds = ingest.valid_override_commands(fixtures.override_commands(spark, sf_dir))
    valid_ev = ingest.valid_product_events(fixtures.product_events(spark, sf_dir))
    known = overrides.known_since(fixtures.catalog(spark, sf_dir), valid_ev)
    return overrides.known_product_commands(valid_cmds, known).select("cmd_seq", "product_id")


@query
def catalog_updates(spark, sf_dir):
    return ingest.catalog_updates(_updates(spark, sf_dir), fixtures.catalog(spark, sf_dir)) \
                 .select("event_seq", "product_id", "new_price", "timestamp")


# --- 2.3 scalar expressions ------------------------------------------------

@query
def demand_weight(spark, sf_dir):
    pe = ingest.valid_product_events(fixtures.product_events(spark, sf_dir))
    return pe.select("event_seq", X.demand_weight(F.col("event_type")).alias("value"))


@query
def compute_price(spark, sf_dir):
    valid = ingest.valid_product_events(fixtures.product_events(spark, sf_dir))
    d = demand.running_demand(valid)
    return d.select("event_seq", X.compute_price(F.col("price"), F.col("demand")).alias("value"))


@query
def normalize_event_ms(spark, sf_dir):
    pe = fixtures.product_events(spark, sf_dir)
    return pe.select("event_seq", X.normalize_event_ms(F.col("timestamp")).alias("value"))


@query
def update_timestamp_s(spark, sf_dir):
    pe = fixtures.product_events(spark, sf_dir)
    return pe.select("event_seq", X.update_timestamp_s(F.col("arrival_ts")).alias("value"))


@query
def trim_unicode(spark, sf_dir):
    pe = fixtures.product_events(spark, sf_dir)
    seq, pid = F.col("event_seq"), F.col("product_id")
    v = (F.when(seq % 5 == 0, F.concat(F.lit(" "), pid, F.lit("\t")))
         .when(seq % 5 == 1, F.concat(F.lit("\u3000"), pid, F.lit("\u00a0")))
         .when(seq % 5 == 2, F.lit("\u000b  "))
         .when(seq % 5 == 3, F.concat(F.lit("\u0085"), pid, F.lit(" x\n\r")))
         .otherwise(pid))
    return pe.select("event_seq", X.trim_unicode(v).alias("value"))


@query
def default_price_source(spark, sf_dir):
    t = fixtures.price_source_texts(spark, sf_dir)
    return t.select("event_seq", X.default_price_source(F.col("raw")).alias("value"))


@query
def default_override_reason(spark, sf_dir):
    t = fixtures.override_reason_texts(spark, sf_dir)
    return t.select("event_seq", X.default_override_reason(F.col("raw")).alias("value"))


@query
def history_limit(spark, sf_dir):
    t = fixtures.history_limit_texts(spark, sf_dir)
    # rejected texts have no limit: status says so, the value reads 0
    limit = X.history_limit(F.col("raw"))
    return t.select("event_seq", F.coalesce(limit, F.lit(0)).cast("bigint").alias("value"),
                    F.when(limit.isNull(), "rejected").otherwise("accepted").alias("status"))


@query
def round_price_2dp(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return p.priced.select("event_seq", X.round_price_2dp(F.col("new_price")).alias("value"))


@query
def base_seed_time(spark, sf_dir):
    p = _plan(spark, sf_dir)
    first = p.history_core.groupBy("product_id").agg(F.min("event_time").alias("t"))
    return first.select("product_id", X.base_seed_time(F.col("t")).alias("value"))


# --- 2.4 demand and price --------------------------------------------------

@query
def running_demand(spark, sf_dir):
    valid = ingest.valid_product_events(fixtures.product_events(spark, sf_dir))
    return demand.running_demand(valid).select("event_seq", "product_id", "demand")


@query
def demand_totals(spark, sf_dir):
    return _plan(spark, sf_dir).demand_totals


@query
def dynamic_price_events(spark, sf_dir):
    return _plan(spark, sf_dir, shared=False).priced.select("event_seq", "product_id", "demand", "new_price", "update_ts")


@query
def live_price(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return demand.live_price(p.priced, p.effective, p.catalog)


# --- 2.5 overrides -----------------------------------------------------------

def _first_half_snapshot(p: PricingPlan) -> DataFrame:
    return overrides.override_state(p.effective.where(F.col("cmd_ts") < F.lit(fixtures.SPLIT_TS).cast("timestamp")))


def _overrides_table(spark: SparkSession, p: PricingPlan):
    """The overrides of the first half of the command log, as a table by product."""
    from pricestream.streaming.product_table import ProductTable
    root = f"{checkpoint_dir(spark).rstrip('/')}/pricestream-overrides/{uuid.uuid4().hex}"
    table = ProductTable(spark, root, overrides.SNAPSHOT)
    table.create(_first_half_snapshot(p))
    return table


@query
def override_upsert(spark, sf_dir):
    p = _plan(spark, sf_dir)
    incoming = p.effective.where((F.col("op") == K.OP_SET)
                                 & (F.col("cmd_ts") >= F.lit(fixtures.SPLIT_TS).cast("timestamp")))
    table = _overrides_table(spark, p)
    table.commit(0, overrides.latest_sets(incoming))
    return table.read(0)


@query
def override_delete(spark, sf_dir):
    p = _plan(spark, sf_dir)
    valid = ingest.valid_override_commands(p.commands)
    requests = (valid.where((F.col("op") == K.OP_REMOVE)
                            & (F.col("cmd_ts") >= F.lit(fixtures.SPLIT_TS).cast("timestamp")))
                     .select("product_id").distinct())
    table = _overrides_table(spark, p)
    _, flags = overrides.override_delete(table.of(requests), requests)
    table.commit(0, table.read(buckets=[]), deleted=requests)
    survivors = table.read(0)
    return (flags.select("product_id", F.when(F.col("deleted"), "deleted").otherwise("absent").alias("outcome"))
            .unionByName(survivors.select("product_id", F.lit("survives").alias("outcome"))))


@query
def override_state(spark, sf_dir):
    return _plan(spark, sf_dir).overrides.select("product_id", "override_price", "set_time")


@query
def override_intervals(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return overrides.override_intervals(p.effective)


@query
def gate_override_active(spark, sf_dir):
    return (_plan(spark, sf_dir, shared=False).gated.where(F.col("gate") == "override_active")
            .select("event_seq", "product_id"))


@query
def gate_stale_after_removal(spark, sf_dir):
    return (_plan(spark, sf_dir, shared=False).gated.where(F.col("gate") == "stale_after_removal")
            .select("event_seq", "product_id"))


@query
def override_history_points(spark, sf_dir):
    return overrides.override_history_points(_plan(spark, sf_dir).effective).drop("seq")


# --- 2.6 baseline ------------------------------------------------------------

@query
def seed_live_state(spark, sf_dir):
    return _plan(spark, sf_dir).live_state_joined


@query
def base_price_history(spark, sf_dir):
    return _plan(spark, sf_dir).base_rows.drop("seq")


# --- 2.7 serving -------------------------------------------------------------

@query
def known_products(spark, sf_dir):
    """Operator 41 from the state that the stream keeps: no history and no pricing is read."""
    from pricestream.plans import replay as R
    from pricestream.streaming.microbatch import latest_state
    return serving.known_products(latest_state(spark, R.replayed(spark, sf_dir)))


@query
def price_history_topn(spark, sf_dir):
    return _plan(spark, sf_dir).topn


@query
def history_exists(spark, sf_dir):
    """Operator 43 from the stream's table of recent points, which has a row for each product with history."""
    from pricestream.plans import replay as R
    from pricestream.streaming.microbatch import recent_table
    recent = recent_table(spark, R.replayed(spark, sf_dir)).read()
    return serving.history_exists(fixtures.catalog(spark, sf_dir), recent)


@query
def current_price(spark, sf_dir):
    return _plan(spark, sf_dir).current


@query
def price_chart_series(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return serving.price_chart_series(p.topn, p.current)


@query
def history_source_flags(spark, sf_dir):
    return serving.history_source_flags(_plan(spark, sf_dir).topn)


@query
def changed_product_snapshot(spark, sf_dir):
    p = _plan(spark, sf_dir)
    since = F.unix_seconds(F.lit(fixtures.CHANGED_SINCE_TS).cast("timestamp"))
    ups = ingest.catalog_updates(_updates(spark, sf_dir, p), p.catalog)
    return serving.changed_product_snapshot(ups.where(F.col("timestamp") >= since), p.current)


# --- 2.4 streaming (operator 31), checked against operator 29 -------------------

@query
def stream_pricing(spark, sf_dir):
    """Operator 31, skew-safe engine: the batch plan per micro-batch with a
    versioned state table; four micro-batches and three restarts."""
    from pricestream.plans.replay import replay
    return replay(spark, sf_dir, "microbatch")


@query
def stream_pricing_stateful(spark, sf_dir):
    """Operator 31 with ``applyInPandasWithState`` keyed state; same input and result."""
    from pricestream.plans.replay import replay
    return replay(spark, sf_dir, "stateful")


# --- sources and sinks, through the stream ---------------------------------------

@query
def src_product_events(spark, sf_dir):
    """Operator 1: the event messages of the stream's inbox, read as a stream and decoded."""
    from pricestream.plans import replay as R
    out = R.replayed(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/pricestream-replay/src-{uuid.uuid4().hex}"
    rows = R.through_stream(S.product_event_stream(S.message_stream(spark, f"{out}/../inbox")), root)
    return ingest.decode_product_events(rows).select("event_seq", "event_type", "product_id", "user_id", "timestamp", "price")


@query
def src_price_updates(spark, sf_dir):
    """Operator 2: the published price updates, put on their topic, read as a stream and parsed."""
    from pricestream.plans import replay as R
    out = R.replayed(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/pricestream-replay/upd-{uuid.uuid4().hex}"
    sent = spark.read.schema("event_seq bigint, value string").json(f"{out}/price_updates")
    S.envelope(sent.withColumn("t", F.current_timestamp()), S.TOPIC_UPDATES, "event_seq", "t", "value") \
        .write.parquet(f"{root}/inbox")
    rows = R.through_stream(S.price_update_stream(S.message_stream(spark, f"{root}/inbox")), root)
    return ingest.parse_price_updates(rows)


@query
def sink_price_updates(spark, sf_dir):
    """Operator 5: the update messages that the stream wrote."""
    from pricestream.plans import replay as R
    sent = spark.read.schema("event_seq bigint, value string").json(f"{R.replayed(spark, sf_dir)}/price_updates")
    u = F.from_json("value", "product_id string, new_price double, timestamp bigint")
    return sent.select("event_seq", u.alias("u")).select("event_seq", "u.*")


@query
def sink_price_history(spark, sf_dir):
    """Operator 6: the history rows that the stream wrote."""
    from pricestream.plans import replay as R
    return spark.read.parquet(f"{R.replayed(spark, sf_dir)}/price_history").select(
        "product_id", "price", "price_source", "event_time")


@query
def sink_live_state(spark, sf_dir):
    """Operator 7: the live state (seeded from the catalog) that the stream wrote."""
    from pricestream.plans import replay as R
    from pricestream.streaming.microbatch import latest_state
    return latest_state(spark, R.replayed(spark, sf_dir)).select("product_id", "demand", "price")


@query
def stream_current_price(spark, sf_dir):
    """Operator 44 on the stream's state: overrides and live prices as the batch serves them."""
    from pricestream.plans import replay as R
    from pricestream.streaming.microbatch import current_prices, latest_state
    return current_prices(latest_state(spark, R.replayed(spark, sf_dir)))


@query
def stream_price_history_topn(spark, sf_dir):
    """Operator 42 on the stream: from the points that it keeps per product, without the history."""
    return serving.price_history_topn(_stream_history(spark, sf_dir))


@query
def stream_price_chart_series(spark, sf_dir):
    """Operator 45 on the stream."""
    return serving.price_chart_series(serving.price_history_topn(_stream_history(spark, sf_dir)),
                                      stream_current_price(spark, sf_dir))


def _stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricestream.plans import replay as R
    from pricestream.streaming.microbatch import recent_history, recent_table
    recent = recent_table(spark, R.replayed(spark, sf_dir)).read()
    return recent_history(recent, fixtures.catalog(spark, sf_dir), fixtures.RUN_TS)


@query
def stream_rejected_events(spark, sf_dir):
    """Operator 10 on the stream: event_seq and reason of the events that it refused."""
    from pricestream.plans import replay as R
    return spark.read.parquet(f"{R.replayed(spark, sf_dir)}/rejected").select("event_seq", "reason")


# --- the larger stream (lineitem) ------------------------------------------------------

def _lineitem(spark, sf_dir, **kw) -> PricingPlan:
    return PricingPlan.from_tables(spark, sf_dir, stream="lineitem", run_ts=fixtures.RUN_TS, **kw)


@query
def lineitem_dynamic_price_events(spark, sf_dir):
    return _lineitem(spark, sf_dir, shared=False).priced.select("event_seq", "product_id", "demand", "new_price", "update_ts")


@query
def lineitem_current_price(spark, sf_dir):
    return _lineitem(spark, sf_dir).current


@query
def lineitem_price_history_topn(spark, sf_dir):
    return _lineitem(spark, sf_dir).topn


@query
def lineitem_price_chart_series(spark, sf_dir):
    p = _lineitem(spark, sf_dir)
    return serving.price_chart_series(p.topn, p.current)


# --- encoding -----------------------------------------------------------------

@query
def encode_price_update(spark, sf_dir):
    """Operator 26: the JSON text of each price update, read back with a plain JSON reader."""
    p = _plan(spark, sf_dir)
    text = p.priced.select("event_seq", X.encode_price_update("product_id", "new_price", "update_ts").alias("value"))
    fields = F.from_json("value", "product_id string, new_price double, timestamp bigint")
    return text.select("event_seq", fields.alias("u")).select("event_seq", "u.*")
