"""Operator 31, skew-safe form: the batch plan run per micro-batch.

``foreachBatch`` decodes the micro-batch's messages and runs ``PricingPlan``
on them, so a hot product is cut into cells and split over many tasks. The state between
micro-batches is a ``ProductTable``, whose versions are the batch ids: demand, last written price, and the last
effective override command with its price and reason. It starts with the catalog (demand 0, base price). A
micro-batch reads the buckets of its own products and writes their rows, not the table. The state of the products in the
batch re-enters as seed rows before all real rows:

- one valid event per product at the earliest time carrying its demand as weight;
- one set command right after it when the product had an override, followed at once
  by the removal when it was removed; ``gate_ms`` keeps the real removal time, so an
  event that arrives late is judged by it, whenever it arrived.

Folding these seeds reproduces the carried state exactly, so the batch
operators need no streaming variant. Seed rows have negative sequence numbers
and are never written out. Outputs are written under the batch id with overwrite and the state as its version, so a
replayed batch replaces its own files.

A second table, ``recent``, holds the first history time and the latest ``MAX_HISTORY_LIMIT`` history points of
each product, merged batch by batch (the latest points of two sets of points are among the latest of each). The history
views and the question whether a product has any history read it instead of the history.

State fails closed: batch 0 refuses a folder that already holds later versions, and any
other batch needs the complete version before it. All intermediate tables are deleted once a batch is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.operators import baseline, demand, ingest, overrides, serving
from pricestream.plans.pricing import PricingPlan
from pricestream.session import materialize, temporary_tables
from pricestream.streaming import sources as S
from pricestream.streaming.product_table import ProductTable
from pricestream.streaming.sinks import publish_updates

EVENT_COLS = ("event_seq", "arrival_ts", "event_type", "product_id", "user_id", "timestamp", "price", "w")
CMD_COLS = ("cmd_seq", "cmd_ts", "product_id", "op", "override_price", "reason", "gate_ms")
STATE = ("product_id string, demand long, price double, last_op string, last_cmd_ts timestamp, override_price double, "
         "reason string")
STATE_COLS = tuple(f.split()[0] for f in STATE.split(", "))
POINT = "struct<event_time: timestamp, seq: bigint, price: double, price_source: string>"
RECENT = f"product_id string, first timestamp, points array<{POINT}>"
SEED_TS = overrides.NEVER


def batch_commands(messages: DataFrame) -> DataFrame:
    """Override commands of a micro-batch in command-log shape."""
    sets = ingest.decode_override_requests(
        messages.where(F.col("topic") == S.TOPIC_SET)
                .select(F.col("seq").alias("cmd_seq"), F.col("arrival_ts").alias("cmd_ts"), "value"))
    removes = (messages.where(F.col("topic") == S.TOPIC_REMOVE)
                       .select(F.col("seq").alias("cmd_seq"), F.col("arrival_ts").alias("cmd_ts"),
                               F.col("value").alias("product_id"), F.lit(K.OP_REMOVE).alias("op"),
                               F.lit(None).cast("double").alias("override_price"),
                               F.lit(None).cast("string").alias("reason")))
    return sets.unionByName(removes).withColumn("gate_ms", F.lit(None).cast("bigint")).select(*CMD_COLS)


def seed_rows(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State table -> (seed events, seed commands)."""
    t0 = F.lit(SEED_TS).cast("timestamp")
    ev = (state.where(F.col("demand").isNotNull())
               .select(F.lit(-1).cast("bigint").alias("event_seq"), t0.alias("arrival_ts"),
                       F.lit("view").alias("event_type"), "product_id", F.lit("").alias("user_id"),
                       F.lit(0).cast("bigint").alias("timestamp"), F.lit(1.0).alias("price"),
                       F.col("demand").alias("w")))
    has_cmd = state.where(F.col("last_op").isNotNull())

    def command(rows: DataFrame, seq: int, micros: int, op: str, gate_ms) -> DataFrame:
        price = F.lit(1.0) if op == K.OP_SET else F.lit(None).cast("double")
        return rows.select(F.lit(seq).cast("bigint").alias("cmd_seq"),
                           (t0 + F.expr(f"INTERVAL {micros} MICROSECOND")).alias("cmd_ts"), "product_id",
                           F.lit(op).alias("op"), price.alias("override_price"),
                           F.lit(None).cast("string").alias("reason"), gate_ms.cast("bigint").alias("gate_ms"))

    sets = command(has_cmd, -3, 1, K.OP_SET, F.lit(None))
    removes = command(has_cmd.where(F.col("last_op") == K.OP_REMOVE), -2, 2, K.OP_REMOVE, X.epoch_ms("last_cmd_ts"))
    return ev.select(*EVENT_COLS), sets.unionByName(removes)


def first_state(catalog: DataFrame) -> DataFrame:
    """The state before any message: catalog products with demand 0 and their base price."""
    return catalog.select("product_id", F.lit(0).cast("bigint").alias("demand"), F.col("base_price").alias("price"),
                          F.lit(None).cast("string").alias("last_op"), F.lit(None).cast("timestamp").alias("last_cmd_ts"),
                          F.lit(None).cast("double").alias("override_price"), F.lit(None).cast("string").alias("reason"))


def next_state(plan: PricingPlan, real_priced: DataFrame, real_effective: DataFrame,
               previous: DataFrame) -> DataFrame:
    """STATE_COLS after this micro-batch, for the products of ``previous`` and of the batch."""
    dem = plan.priced.groupBy("product_id").agg(F.max("demand").alias("__demand"))
    # the last effective command among this batch's real commands; products
    # without one keep their previous state (the seed commands only replay it)
    cmd = (real_effective.groupBy("product_id")
           .agg(F.max_by(F.struct("op", "cmd_ts", "override_price", "reason"), F.struct("cmd_ts", "cmd_seq")).alias("__c")))
    before = previous.where(F.col("price").isNotNull()).select("product_id", F.col("price").alias("base_price"))
    price = demand.live_price(real_priced, real_effective, before).withColumnRenamed("price", "__price")
    j = (previous.join(dem, "product_id", "full_outer").join(cmd, "product_id", "full_outer")
         .join(price, "product_id", "full_outer"))
    has = F.col("__c").isNotNull()
    pick = lambda new, old: F.when(has, F.col(f"__c.{new}")).otherwise(F.col(old)).alias(old)
    return j.select("product_id", F.coalesce("__demand", "demand").alias("demand"),
                    F.coalesce("__price", "price").alias("price"), pick("op", "last_op"), pick("cmd_ts", "last_cmd_ts"),
                    pick("override_price", "override_price"), pick("reason", "reason"))


def active_overrides(state: DataFrame) -> DataFrame:
    """Operators 34 and 4 on the stream: the overrides table that the state holds."""
    return state.where(F.col("last_op") == K.OP_SET).select(
        "product_id", "override_price", "reason", F.col("last_cmd_ts").alias("set_time"))


def current_prices(state: DataFrame) -> DataFrame:
    """Operator 44 on the stream's state."""
    return serving.current_price(state.select("product_id", "demand", "price"), active_overrides(state))


#: Buckets of the state tables.
BUCKETS = 16


def state_table(spark, out_dir: str, buckets: int = BUCKETS) -> ProductTable:
    return ProductTable(spark, f"{out_dir.rstrip('/')}/state", STATE, buckets)


def recent_table(spark, out_dir: str, buckets: int = BUCKETS) -> ProductTable:
    return ProductTable(spark, f"{out_dir.rstrip('/')}/recent", RECENT, buckets)


def prices_of(spark, out_dir: str, ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Current prices of some products: reads the files of their buckets."""
    return current_prices(state_table(spark, out_dir, buckets).of(ids))


def latest_state(spark, out_dir: str, version: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The newest state, or that of a version."""
    return state_table(spark, out_dir, buckets).read(version)


def next_recent(before: DataFrame, history: DataFrame) -> DataFrame:
    """RECENT of the products of ``history`` (the batch's rows), whose points so far are in ``before``. Each map task
    forwards at most the limit's number of points a product."""
    n = K.MAX_HISTORY_LIMIT
    w = Window.partitionBy("product_id").orderBy(F.col("event_time").desc(), F.col("seq").desc())
    top = history.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    points = top.groupBy("product_id").agg(
        F.collect_list(F.struct("event_time", "seq", "price", "price_source").cast(POINT)).alias("__new"))
    first = history.groupBy("product_id").agg(F.min("event_time").alias("__first"))
    j = points.join(first, "product_id").join(before, "product_id", "left")
    both = F.concat(F.coalesce("points", F.array().cast(f"array<{POINT}>")), "__new")
    return j.select("product_id", F.least("first", "__first").alias("first"),
                    F.slice(F.sort_array(both, asc=False), 1, n).alias("points"))


def recent_history(recent: DataFrame, catalog: DataFrame, run_ts: str) -> DataFrame:
    """The history rows that a view of the latest rows can show: the kept points and the base rows (operator 40)."""
    points = recent.select("product_id", F.inline("points")).select("product_id", "price", "price_source", "event_time", "seq")
    firsts = recent.select("product_id", F.lit(K.SOURCE_DYNAMIC).alias("price_source"), F.col("first").alias("event_time"))
    return points.unionByName(baseline.base_price_history(catalog, firsts, run_ts))


class MicroBatchPricing:
    """``foreachBatch`` target: price one micro-batch with the batch plan."""

    def __init__(self, out_dir: str, catalog: DataFrame, rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL,
                 kafka: dict | None = None, buckets: int = BUCKETS):
        """``kafka``: producer options (bootstrap servers, ``topic``) to publish the price
        updates to a topic too. ``buckets``: of the state tables (see ``ProductTable``)."""
        self.out_dir = out_dir.rstrip("/")
        self.catalog = catalog
        self.rows_per_cell = rows_per_cell
        self.kafka = kafka
        self.buckets = buckets

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        state, recent = (f(spark, self.out_dir, self.buckets) for f in (state_table, recent_table))
        if batch_id == 0:
            state.create(first_state(self.catalog))
            recent.create(spark.createDataFrame([], RECENT))
        state.manifest(batch_id - 1)  # raises rather than starting anew by mistake
        with temporary_tables(spark):
            bid = f"batch_id={batch_id}"
            # each message is parsed once
            decoded = materialize(ingest.decode_events(S.product_event_stream(messages)), "decoded")
            cm = materialize(batch_commands(messages), "commands")
            (ingest.rejected_product_events(decoded)
             .write.mode("overwrite").parquet(f"{self.out_dir}/rejected/{bid}"))
            ev = (decoded.where("decoded").withColumn("w", F.lit(None).cast("bigint")).select(*EVENT_COLS)
                  .where(ingest.valid_predicate()))
            tid = X.trim_unicode(F.col("product_id"))
            touched = materialize(ev.select(tid.alias("product_id")).union(cm.select(tid.alias("product_id"))).distinct(), "touched")
            own = materialize(state.of(touched, batch_id - 1), "own_state")
            sev, scm = seed_rows(own)
            plan = PricingPlan(sev.unionByName(ev), scm.unionByName(cm), self.catalog, rows_per_cell=self.rows_per_cell)
            real = plan.priced.where(F.col("event_seq") >= 0)
            real_eff = plan.effective.where(F.col("cmd_seq") >= 0)
            hist = demand.dynamic_history(real).unionByName(overrides.override_history_points(real_eff))
            hist.write.mode("overwrite").parquet(f"{self.out_dir}/price_history/{bid}")
            real.select("event_seq", "product_id", "demand", "new_price", "update_ts") \
                .write.mode("overwrite").parquet(f"{self.out_dir}/priced/{bid}")
            updates = real.select("event_seq", X.encode_price_update("product_id", "new_price", "update_ts").alias("value"))
            publish_updates(updates, self.out_dir, batch_id, self.kafka)
            written = spark.read.schema(hist.schema).parquet(f"{self.out_dir}/price_history/{bid}")
            recent.commit(batch_id, next_recent(recent.of(touched, batch_id - 1), written))
            state.commit(batch_id, next_state(plan, real, real_eff, own))


def start_microbatch_pricing(messages: DataFrame, catalog: DataFrame, out_dir: str, checkpoint: str,
                             available_now: bool = True, rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL,
                             kafka: dict | None = None, trigger: str = "10 seconds", buckets: int = BUCKETS):
    """Message stream -> per-micro-batch batch plan; returns the StreamingQuery."""
    w = (messages.writeStream.foreachBatch(MicroBatchPricing(out_dir, catalog, rows_per_cell, kafka, buckets))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
