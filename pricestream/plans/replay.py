"""Run the streaming pricing engines over messages derived from the driver tables.

The product events and override commands of the fixtures are turned into one
message stream (``streaming/sources.py`` envelope) by Spark from an evenly spread copy of ``events``, appended to a
folder under the shared checkpoint directory in ``chunks`` consecutive time
slices, and the stream is run with ``availableNow`` after each slice: every
slice is a micro-batch and every run after the first resumes from the stream
checkpoint. What the sinks wrote is read back; it must equal the batch operators.
One replay per session, table folder and engine serves every query on its outputs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.session import checkpoint_dir, ensure_utc, materialize, temporary_tables
from pricestream.sources import fixtures
from pricestream.sources.tables import read_table
from pricestream.streaming import sources as S


#: Rows of ``events`` in a file of the spread copy.
ROWS_PER_FILE = 50_000


def table_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Envelope messages of every product event and override command, in one pass over ``events`` (the table's
    if not given)."""
    ensure_utc(spark)
    events = events if events is not None else read_table(spark, sf_dir, "events")
    e, c = F.col("e"), F.col("c")
    is_set = c["op"] == K.OP_SET
    fields = lambda s, *names: F.to_json(F.struct(*[s[n].alias(n) for n in names]))
    message = lambda topic, seq, ts, value: F.struct(
        topic.alias("topic"), seq.cast("bigint").alias("seq"), ts.cast("timestamp").alias("arrival_ts"),
        value.cast("string").alias("value"))
    of_event = message(F.lit(S.TOPIC_EVENTS), e["event_seq"], e["arrival_ts"],
                       fields(e, "event_type", "product_id", "user_id", "timestamp", "price"))
    of_command = F.when(c.isNotNull(), message(
        F.when(is_set, F.lit(S.TOPIC_SET)).otherwise(F.lit(S.TOPIC_REMOVE)), c["cmd_seq"], c["cmd_ts"],
        F.when(is_set, fields(c, "product_id", "override_price", "reason")).otherwise(c["product_id"])))
    rows = events.select(F.struct(*fixtures.event_columns()).alias("e"),
                         F.when(fixtures.is_command(), F.struct(*fixtures.command_columns())).alias("c"))
    return rows.select(F.inline(F.array(of_event, of_command))).where(F.col("topic").isNotNull())


def spread_events(spark: SparkSession, sf_dir: str, rows: int) -> DataFrame:
    """The rows of ``events`` in files of about equal numbers, however many row groups the table's file has: what is made
    of them is read by as many tasks as there are cores."""
    events = read_table(spark, sf_dir, "events")
    files = max(1, -(-rows // ROWS_PER_FILE))
    return materialize(events.repartition(files, "event_id", "ts", "user_id", "value"), "events-spread")


_DONE: dict[tuple, str] = {}


def replay(spark: SparkSession, sf_dir: str, engine: str = "microbatch", chunks: int = 4) -> DataFrame:
    """The accepted events with demand and price that the stream wrote."""
    out = replayed(spark, sf_dir, engine, chunks)
    return spark.read.parquet(f"{out}/priced").select("event_seq", "product_id", "demand", "new_price", "update_ts")


def replayed(spark: SparkSession, sf_dir: str, engine: str = "microbatch", chunks: int = 4) -> str:
    """Output folder of the replayed stream (its messages are in ``../inbox``)."""
    done = (spark.sparkContext.applicationId, sf_dir, engine, chunks)
    if done in _DONE:
        return _DONE[done]
    root = f"{checkpoint_dir(spark).rstrip('/')}/pricestream-replay/{engine}-{uuid.uuid4().hex}"
    inbox, out, ckpt = f"{root}/inbox", f"{root}/out", f"{root}/stream-checkpoint"
    ensure_utc(spark)
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    rows, lo, hi = read_table(spark, sf_dir, "events").agg(F.count(F.lit(1)), F.min(t), F.max(t)).first()
    step = (hi - lo) // chunks + 1
    catalog = fixtures.catalog(spark, sf_dir)
    with temporary_tables(spark):
        events = spread_events(spark, sf_dir, rows)
        for k in range(chunks):
            part = events.where((t >= lo + k * step) & (t < lo + (k + 1) * step))
            table_messages(spark, sf_dir, part).write.mode("append").parquet(inbox)
            stream = S.message_stream(spark, inbox)
            if engine == "microbatch":
                from pricestream.streaming.microbatch import start_microbatch_pricing
                q = start_microbatch_pricing(stream, catalog, out, ckpt)
            else:
                from pricestream.streaming.sinks import start_pricing_stream
                q = start_pricing_stream(stream, catalog, out, ckpt)
            q.awaitTermination()
    _DONE[done] = out
    return out


def through_stream(messages: DataFrame, root: str) -> DataFrame:
    """Runs a message stream's rows into a folder and reads them back."""
    q = (messages.writeStream.format("parquet").option("path", f"{root}/rows")
         .option("checkpointLocation", f"{root}/rows-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return messages.sparkSession.read.schema(messages.schema).parquet(f"{root}/rows")
