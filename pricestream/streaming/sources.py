"""Streaming sources: operators 1 (product events) and 2 (price updates).

Messages use one envelope ``(topic, seq, arrival_ts, value)``: ``value`` is the
message text, ``seq`` its offset, ``arrival_ts`` the broker time. With a Kafka
connector on the classpath the same envelope comes from ``format("kafka")``
(``startingOffsets=latest`` on a first start, the checkpoint afterwards); here
it is a file stream of Parquet files with that schema.

Topics: ``product-events`` (event JSON), ``override-set`` (override request
JSON), ``override-remove`` (the product id), ``price-updates`` (update JSON).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, seq bigint, arrival_ts timestamp, value string"

TOPIC_EVENTS = "product-events"
TOPIC_SET = "override-set"
TOPIC_REMOVE = "override-remove"
TOPIC_UPDATES = "price-updates"


def message_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                   max_files_per_trigger: int | None = None, topics: dict[str, str] | None = None) -> DataFrame:
    """Envelope stream from a file folder, or from Kafka when ``kafka`` options are given.

    ``topics`` names the topics in use for any of the four (e.g. {"product-events":
    "my-events"}); by default events and override commands are subscribed."""
    topics = topics or {}
    if kafka:
        names = [topics.get(t, t) for t in (TOPIC_EVENTS, TOPIC_SET, TOPIC_REMOVE)]
        opts = {"startingOffsets": "latest", "subscribe": ",".join(names), **kafka}
        raw = spark.readStream.format("kafka").options(**opts).load()
        # offsets repeat across partitions and topics; this number does not inside events or commands
        seq = (F.col("offset") * F.lit(1 << 17) + F.col("partition") * F.lit(2)
               + (F.col("topic") == topics.get(TOPIC_REMOVE, TOPIC_REMOVE)).cast("int"))
        messages = raw.select(F.col("topic"), seq.cast("bigint").alias("seq"), F.col("timestamp").alias("arrival_ts"),
                              F.col("value").cast("string").alias("value"))
    else:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        messages = reader.parquet(path)
    return with_own_names(messages, topics)


def with_own_names(messages: DataFrame, topics: dict[str, str]) -> DataFrame:
    """Renames the topics in use to this library's names."""
    name = F.col("topic")
    for own, used in topics.items():
        name = F.when(F.col("topic") == used, F.lit(own)).otherwise(name)
    return messages.withColumn("topic", name)


def product_event_stream(messages: DataFrame) -> DataFrame:
    """Operator 1: the product-event messages (event_seq, arrival_ts, value)."""
    return (messages.where(F.col("topic") == TOPIC_EVENTS)
                    .select(F.col("seq").alias("event_seq"), "arrival_ts", "value"))


def price_update_stream(messages: DataFrame, once_within: str | None = None) -> DataFrame:
    """Operator 2: the price-update messages (event_seq, arrival_ts, value).

    ``once_within``: a message with the sequence number of one that came up to so long before is dropped (a batch that
    was run again published it again); the state holds the numbers of that time span only."""
    updates = (messages.where(F.col("topic") == TOPIC_UPDATES)
                       .select(F.col("seq").alias("event_seq"), "arrival_ts", "value"))
    if once_within:
        updates = updates.withWatermark("arrival_ts", once_within).dropDuplicatesWithinWatermark(["event_seq"])
    return updates


def envelope(df: DataFrame, topic: str, seq: str, ts: str, value) -> DataFrame:
    """Rows -> message envelope (for writing fixtures or a replay folder)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.lit(topic).alias("topic"), F.col(seq).cast("bigint").alias("seq"),
                     F.col(ts).cast("timestamp").alias("arrival_ts"), v.cast("string").alias("value"))
