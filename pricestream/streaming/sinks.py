"""Streaming sinks: operators 5 (price updates), 6 (price history), 7 (live state).

All three run inside one ``foreachBatch``; updates and history are written under a directory named
by the batch id with overwrite, the live state as the batch's version of a ``ProductTable`` (what changed, not the
table), so a batch replayed after a failure replaces its own output instead of duplicating it.

Price updates go through an outbox: the batch's files under ``price_updates`` are written first, and what is published to a
topic is read from them. A batch that is run again publishes the same messages again, with the same sequence numbers; the
reader drops these (``sources.price_update_stream`` with ``once_within``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.session import materialize, temporary_tables
from pricestream.streaming.product_table import ProductTable

LIVE_STATE = "product_id string, demand long, price double"


def price_update_messages(out: DataFrame) -> DataFrame:
    """Operator 5: {product_id, new_price, timestamp} JSON per accepted event."""
    return (out.where(F.col("kind") == K.SOURCE_DYNAMIC)
               .select(F.col("seq").alias("event_seq"), X.encode_price_update("product_id", "price", "update_ts").alias("value")))


def priced_rows(out: DataFrame) -> DataFrame:
    """Accepted events with their demand and price (the stream form of operator 29)."""
    return (out.where(F.col("kind") == K.SOURCE_DYNAMIC)
               .select(F.col("seq").alias("event_seq"), "product_id", "demand",
                       F.col("price").alias("new_price"), "update_ts"))


def history_rows(out: DataFrame) -> DataFrame:
    """Operator 6: one history row per accepted event ('dynamic') and effective set
    ('override'); a blank source would read back as 'dynamic'."""
    return out.select("product_id", "price",
                      X.default_price_source(F.col("kind")).alias("price_source"),
                      F.col("ts").alias("event_time"), "seq")


def live_state_changes(out: DataFrame) -> DataFrame:
    """Operator 7: per product in this batch, the last written demand and price."""
    dyn = out.where(F.col("kind") == K.SOURCE_DYNAMIC)
    d = dyn.groupBy("product_id").agg(F.max_by("demand", F.struct("ts", "seq")).alias("demand"))
    p = out.groupBy("product_id").agg(
        F.max_by("price", F.struct("ts", F.when(F.col("kind") == K.SOURCE_DYNAMIC, 1).otherwise(0),
                                   "seq")).alias("price"))
    return p.join(d, "product_id", "left")


def merge_live_state(previous: DataFrame, changes: DataFrame) -> DataFrame:
    """The changed products' rows: what a batch did not write stays as it was."""
    j = changes.join(previous.select("product_id", F.col("demand").alias("d0"), F.col("price").alias("p0")),
                     "product_id", "left")
    return j.select("product_id", F.coalesce(F.col("demand"), F.col("d0")).alias("demand"),
                    F.coalesce(F.col("price"), F.col("p0")).alias("price"))


def publish_updates(updates: DataFrame, out_dir: str, batch_id: int, kafka: dict | None = None) -> None:
    """Operator 5: the batch's update messages (event_seq, value) to the outbox, and from there to a topic if producer
    options are given; the key of a message is its sequence number."""
    path = f"{out_dir}/price_updates/batch_id={batch_id}"
    updates.write.mode("overwrite").json(path)
    if kafka:
        sent = updates.sparkSession.read.schema("event_seq bigint, value string").json(path)
        sent.select(F.col("event_seq").cast("string").alias("key"), "value").write.format("kafka").options(**kafka).save()


def live_state_table(spark, out_dir: str) -> ProductTable:
    return ProductTable(spark, f"{out_dir.rstrip('/')}/live_state", LIVE_STATE)


class PricingSinks:
    """``foreachBatch`` target writing updates, history and the live state."""

    def __init__(self, out_dir: str, kafka: dict | None = None):
        """``kafka``: producer options (``kafka.bootstrap.servers``, ``topic``) to
        publish the price updates to a topic too."""
        self.out_dir = out_dir.rstrip("/")
        self.kafka = kafka

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live = live_state_table(spark, self.out_dir)
        if batch_id == 0:
            live.create(spark.createDataFrame([], LIVE_STATE))
        live.manifest(batch_id - 1)  # raises rather than starting anew by mistake
        bid = f"batch_id={batch_id}"
        with temporary_tables(spark):
            out = materialize(batch, "priced_batch")
            publish_updates(price_update_messages(out), self.out_dir, batch_id, self.kafka)
            priced_rows(out).write.mode("overwrite").parquet(f"{self.out_dir}/priced/{bid}")
            history_rows(out).write.mode("overwrite").parquet(f"{self.out_dir}/price_history/{bid}")
            changes = materialize(live_state_changes(out), "live_state_changes")
            live.commit(batch_id, merge_live_state(live.of(changes, batch_id - 1), changes))


def start_pricing_stream(messages: DataFrame, catalog: DataFrame, out_dir: str, checkpoint: str,
                         available_now: bool = True, kafka: dict | None = None):
    """Wire source -> stateful fold -> sinks; returns the StreamingQuery. ``kafka``: see PricingSinks."""
    from pricestream.streaming.stateful import stream_pricing
    w = (stream_pricing(messages, catalog).writeStream
         .foreachBatch(PricingSinks(out_dir, kafka)).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


class ChangedProductSink:
    """``foreachBatch`` target of the price-update stream (operators 2 -> 12 -> 15 -> 47):
    per micro-batch, the current price of the catalog products that received an
    update, written under the batch id (replay-safe). Prices are asked for by id, so a batch reads the state's
    files of its own products."""

    def __init__(self, out_dir: str, catalog: DataFrame, current):
        self.out_dir = out_dir.rstrip("/")
        self.catalog = catalog
        self.current = current          # DataFrame of ids -> their current prices (operator 44)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from pricestream.operators import ingest, serving
        with temporary_tables(batch.sparkSession):
            ups = ingest.catalog_updates(ingest.parse_price_updates(batch), self.catalog)
            ids = materialize(ups.select("product_id").distinct(), "changed_ids")
            snap = serving.changed_product_snapshot(ids, self.current(ids))
            snap.write.mode("overwrite").parquet(f"{self.out_dir}/changed_products/batch_id={batch_id}")


def start_update_stream(messages: DataFrame, catalog: DataFrame, current, out_dir: str,
                        checkpoint: str, available_now: bool = True, once_within: str | None = None):
    """Price-update stream -> changed-product snapshots; returns the StreamingQuery."""
    from pricestream.streaming.sources import price_update_stream
    w = (price_update_stream(messages, once_within).writeStream
         .foreachBatch(ChangedProductSink(out_dir, catalog, current))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
