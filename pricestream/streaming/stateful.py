"""Operator 31: incremental pricing with keyed state that survives restarts.

``groupBy(trimmed product id).transformWithState``: the state of a key lives in RocksDB as a value
(known, active, removed_at_ms) and a map from raw id to demand. A micro-batch reads and writes the
values of its own keys and, of the map, the raw ids that its events name; nothing is
rewritten whole, and keys without messages cost nothing. Events and override commands of a key are
ordered by (arrival, commands first, seq). The Python step loops over the key's commands only (few); the
gate of the events is an as-of lookup by index and the demand a cumulative sum, both vectorised
in numpy. State never times out (the reference never expires it).

Demand is counted per raw id, as in the batch form. A key's events of one micro-batch meet in one task as
narrow numpy columns (about 60 bytes an event), so the trigger's size bounds them; streams in which a product has
more than that use the micro-batch engine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.operators import ingest
from pricestream.session import ship_package
from pricestream.streaming import sources as S

GATE_SCHEMA = "known boolean, active boolean, removed_at_ms long"
OUT_SCHEMA = ("kind string, product_id string, seq long, ts timestamp, price double, "
              "demand long")
_IN_COLS = ["tid", "kind", "ts", "seq", "product_id", "price", "w", "ev_ms", "op",
            "in_catalog", "cmd_ms"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state of streams started from now on lives in RocksDB (``transformWithState`` needs it)."""
    spark.conf.set(PROVIDER, ROCKSDB)


def pricing_inputs(messages: DataFrame, catalog: DataFrame) -> DataFrame:
    """Decode and validate the message stream into one row shape for the fold."""
    ev = ingest.valid_decoded_events(S.product_event_stream(messages))
    ev_rows = ev.select(
        X.trim_unicode(F.col("product_id")).alias("tid"), F.lit(K.KIND_EVENT).alias("kind"),
        F.col("arrival_ts").alias("ts"), F.col("event_seq").alias("seq"), "product_id", "price",
        X.demand_weight(F.col("event_type")).alias("w"),
        X.normalize_event_ms(F.col("timestamp")).alias("ev_ms"),
        F.lit(None).cast("string").alias("op"), F.lit(None).cast("boolean").alias("in_catalog"),
        F.lit(None).cast("bigint").alias("cmd_ms"))
    sets = ingest.decode_override_requests(
        messages.where(F.col("topic") == S.TOPIC_SET)
                .select(F.col("seq").alias("cmd_seq"), F.col("arrival_ts").alias("cmd_ts"), "value"))
    removes = (messages.where(F.col("topic") == S.TOPIC_REMOVE)
                       .select(F.col("seq").alias("cmd_seq"), F.col("arrival_ts").alias("cmd_ts"),
                               F.col("value").alias("product_id"), F.lit(K.OP_REMOVE).alias("op"),
                               F.lit(None).cast("double").alias("override_price"),
                               F.lit(None).cast("string").alias("reason")))
    cmds = ingest.valid_override_commands(sets.unionByName(removes))
    cat = catalog.select("product_id", F.lit(True).alias("in_catalog"))
    cmd_rows = cmds.join(cat, "product_id", "left").select(
        F.col("product_id").alias("tid"), F.lit(K.KIND_COMMAND).alias("kind"),
        F.col("cmd_ts").alias("ts"), F.col("cmd_seq").alias("seq"), "product_id",
        F.col("override_price").alias("price"), F.lit(None).cast("bigint").alias("w"),
        F.lit(None).cast("bigint").alias("ev_ms"), "op",
        F.coalesce(F.col("in_catalog"), F.lit(False)).alias("in_catalog"),
        X.epoch_ms(F.col("cmd_ts")).alias("cmd_ms"))
    return ev_rows.unionByName(cmd_rows)


class Gate(NamedTuple):
    known: bool = False
    active: bool = False
    removed_at_ms: int | None = None


def fold(tid: str, pdf: pd.DataFrame, gate: Gate, demand_of) -> tuple[pd.DataFrame, Gate, dict[str, int]]:
    """One key, one micro-batch: gate the events, count demand, price them. ``demand_of(raw id)``: demand before;
    returns the outputs, the gate after it and the demand of the raw ids that were counted."""
    known, active0, removed0 = gate
    pdf = pdf.sort_values(["ts", "kind", "seq"], kind="mergesort").reset_index(drop=True)
    n = len(pdf)
    kind = pdf["kind"].to_numpy()
    is_cmd = kind == K.KIND_COMMAND
    ev_idx = np.flatnonzero(~is_cmd)
    raw = pdf["product_id"].to_numpy()
    # a product is known by the events of its own id, not by padded forms of it
    own = ev_idx[raw[ev_idx] == tid]
    first_ev = own[0] if len(own) else n

    # Commands, in order: a set needs a known product; a remove needs an active override.
    eff = np.zeros(n, dtype=bool)
    is_set = np.zeros(n, dtype=bool)
    cmd_ms = pdf["cmd_ms"].to_numpy(dtype="float64", na_value=np.nan)
    active, removed = bool(active0), removed0
    ops, in_cat = pdf["op"].to_numpy(), pdf["in_catalog"].to_numpy()
    for i in np.flatnonzero(is_cmd):
        if ops[i] == K.OP_SET:
            if known or bool(in_cat[i]) or first_ev < i:
                eff[i] = is_set[i] = True
                active = True
        elif active:
            eff[i] = True
            active, removed = False, int(cmd_ms[i])

    # Events: the last effective command before each event decides (as-of by index).
    last = np.maximum.accumulate(np.where(eff, np.arange(n), -1))
    j = last[ev_idx]
    ev_ms = pdf["ev_ms"].to_numpy(dtype="float64", na_value=0)[ev_idx]
    init_gate = bool(active0) | ((removed0 is not None) & (ev_ms <= (removed0 if removed0 is not None else 0)))
    jj = np.maximum(j, 0)
    cmd_gate = is_set[jj] | (ev_ms <= cmd_ms[jj])
    gated = np.where(j >= 0, cmd_gate, init_gate)
    acc = ev_idx[~gated]

    w = pdf["w"].to_numpy(dtype="int64", na_value=0)[acc]
    codes, ids = pd.factorize(raw[acc])
    before = np.array([demand_of(i) for i in ids], np.int64)
    demand = pd.Series(w).groupby(codes).cumsum().to_numpy(dtype="int64") + (before[codes] if len(ids) else 0)
    last = dict(zip(ids.tolist(), (before + np.bincount(codes, w, len(ids)).astype(np.int64)).tolist()))
    price = pdf["price"].to_numpy(dtype="float64")[acc] + np.sqrt(demand.astype("float64")) * K.PRICE_DEMAND_FACTOR
    dyn = pd.DataFrame({"kind": K.SOURCE_DYNAMIC, "product_id": raw[acc], "seq": pdf["seq"].to_numpy()[acc],
                        "ts": pdf["ts"].to_numpy()[acc], "price": price, "demand": pd.array(demand, dtype="Int64")})
    sets = np.flatnonzero(is_set)
    ovr = pd.DataFrame({"kind": K.SOURCE_OVERRIDE, "product_id": pdf["tid"].to_numpy()[sets],
                        "seq": pdf["seq"].to_numpy()[sets], "ts": pdf["ts"].to_numpy()[sets],
                        "price": pdf["price"].to_numpy(dtype="float64")[sets],
                        "demand": pd.array([None] * len(sets), dtype="Int64")})
    out = pd.concat([x for x in (dyn, ovr) if len(x)] or [dyn], ignore_index=True)
    return out, Gate(bool(known or len(own) > 0), bool(active), removed), last


class PricingProcessor(StatefulProcessor):
    """The state of a trimmed product id: its gate, and the demand of each raw id."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gate = handle.getValueState("gate", GATE_SCHEMA)
        self.demand = handle.getMapState("demand", "raw string", "demand long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        gate = Gate(*self.gate.get()) if self.gate.exists() else Gate()
        out, after, counted = fold(key[0], pd.concat(list(rows), ignore_index=True), gate, self._demand)
        if after != gate or not self.gate.exists():
            self.gate.update(tuple(after))
        for raw, demand in counted.items():
            self.demand.updateValue((raw,), (demand,))
        if len(out):
            yield out

    def _demand(self, raw: str) -> int:
        return self.demand.getValue((raw,))[0] if self.demand.containsKey((raw,)) else 0

    def close(self) -> None:
        pass


def stream_pricing(messages: DataFrame, catalog: DataFrame) -> DataFrame:
    """Streaming DataFrame of price outputs: one 'dynamic' row per accepted event
    (product_id, seq, ts, price, demand, update_ts) and one 'override' row per
    effective set. Append mode; one shuffle by trimmed product id."""
    use_rocksdb(messages.sparkSession)
    ship_package(messages.sparkSession)
    rows = pricing_inputs(messages, catalog).select(*_IN_COLS)
    out = rows.groupBy("tid").transformWithStateInPandas(
        PricingProcessor(), outputStructType=OUT_SCHEMA, outputMode="append", timeMode="None")
    return out.withColumn("update_ts", F.when(F.col("kind") == K.SOURCE_DYNAMIC,
                                              X.update_timestamp_s(F.col("ts"))))
