"""Command-line jobs (``spark-submit`` targets).

  python -m pricestream.plans.job batch   --events P --commands P --catalog P --out DIR [--run-ts T]
  python -m pricestream.plans.job batch   --tables DIR --out DIR [--stream events|lineitem]
  python -m pricestream.plans.job stream  --inbox DIR --catalog P --out DIR --checkpoint DIR
                                          [--kafka-bootstrap HOST:PORT --topic product-events=my-events ...
                                           --updates-topic T]
  python -m pricestream.plans.job updates --inbox DIR --catalog P --state DIR --out DIR --checkpoint DIR

``batch`` prices the whole input and writes price_history (by date), live_state,
price_overrides, current_price and rejected_events. Its inputs are Parquet tables:
events (event_seq, arrival_ts, event_type, product_id, user_id, timestamp, price), commands
(cmd_seq, cmd_ts, product_id, op, override_price, reason) and catalog (product_id,
base_price); or the driver's tables. ``stream`` runs the skew-safe micro-batch engine over the
message source until stopped (``--available-now`` processes what is there and exits).
``updates`` writes, per micro-batch of price updates, the current prices of the changed products.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pricestream.plans.pricing import PricingPlan
from pricestream.session import ensure_utc
from pricestream.sources import fixtures
from pricestream.streaming import microbatch, sinks
from pricestream.streaming import sources as S


def run_batch(spark: SparkSession, out: str, tables: str | None = None, stream: str = "events", events: str | None = None,
              commands: str | None = None, catalog: str | None = None, run_ts: str | None = None) -> None:
    ensure_utc(spark)
    if tables:
        plan = PricingPlan.from_tables(spark, tables, stream=stream, run_ts=run_ts)
    else:
        plan = PricingPlan(*(spark.read.parquet(p) for p in (events, commands, catalog)), run_ts=run_ts)
    plan.write(out)


def _catalog(spark: SparkSession, catalog: str | None, tables: str | None) -> DataFrame:
    return spark.read.parquet(catalog) if catalog else fixtures.catalog(spark, tables)


def run_stream(spark: SparkSession, inbox: str | None, out: str, checkpoint: str, tables: str | None = None,
               catalog: str | None = None, kafka: dict | None = None, topics: dict[str, str] | None = None,
               updates_topic: str | None = None, available_now: bool = False):
    ensure_utc(spark)
    messages = S.message_stream(spark, inbox, kafka=kafka, topics=topics)
    producer = {**kafka, "topic": updates_topic} if kafka and updates_topic else None
    q = microbatch.start_microbatch_pricing(messages, _catalog(spark, catalog, tables), out, checkpoint,
                                            available_now=available_now, kafka=producer)
    q.awaitTermination()
    return q


def run_updates(spark: SparkSession, inbox: str | None, state: str, out: str, checkpoint: str, tables: str | None = None,
                catalog: str | None = None, kafka: dict | None = None, topics: dict[str, str] | None = None,
                available_now: bool = False):
    """``state``: output folder of the pricing stream, whose newest state gives the prices."""
    ensure_utc(spark)
    topics = topics or {}
    if kafka:
        kafka = {"subscribe": topics.get(S.TOPIC_UPDATES, S.TOPIC_UPDATES), **kafka}
    messages = S.message_stream(spark, inbox, kafka=kafka, topics=topics)
    q = sinks.start_update_stream(messages, _catalog(spark, catalog, tables),
                                  lambda ids: microbatch.prices_of(spark, state, ids), out,
                                  checkpoint, available_now=available_now)
    q.awaitTermination()
    return q


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pricestream")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--tables")
    b.add_argument("--events")
    b.add_argument("--commands")
    b.add_argument("--catalog")
    b.add_argument("--run-ts")
    b.add_argument("--out", required=True)
    b.add_argument("--stream", default="events", choices=["events", "lineitem"])
    for name in ("stream", "updates"):
        s = sub.add_parser(name)
        s.add_argument("--inbox")
        s.add_argument("--tables")
        s.add_argument("--catalog")
        s.add_argument("--out", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--kafka-bootstrap")
        s.add_argument("--topic", action="append", default=[], metavar="OWN=USED")
        s.add_argument("--available-now", action="store_true")
        if name == "stream":
            s.add_argument("--updates-topic")
        else:
            s.add_argument("--state", required=True)
    a = ap.parse_args(argv)
    if a.cmd == "batch" and not a.tables and not (a.events and a.commands and a.catalog):
        ap.error("batch needs --tables, or --events, --commands and --catalog")
    if a.cmd != "batch" and not (a.tables or a.catalog):
        ap.error("a catalog is needed: --catalog or --tables")
    spark = SparkSession.builder.appName(f"pricestream-{a.cmd}").getOrCreate()
    if a.cmd == "batch":
        run_batch(spark, a.out, a.tables, a.stream, a.events, a.commands, a.catalog, a.run_ts)
        return
    kafka = {"kafka.bootstrap.servers": a.kafka_bootstrap} if a.kafka_bootstrap else None
    topics = dict(t.split("=", 1) for t in a.topic)
    if a.cmd == "stream":
        run_stream(spark, a.inbox, a.out, a.checkpoint, a.tables, a.catalog, kafka, topics, a.updates_topic, a.available_now)
    else:
        run_updates(spark, a.inbox, a.state, a.out, a.checkpoint, a.tables, a.catalog, kafka, topics, a.available_now)


if __name__ == "__main__":
    main()
