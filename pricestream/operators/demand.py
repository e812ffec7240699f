"""Demand and price: operators 17, 27-30.

- ``running_demand``: per raw product id, the cumulative weight in arrival order
  including the current event (the counter is incremented before pricing);
- ``gated_demand``, ``priced``: validate -> gate -> running demand -> price;
- ``demand_totals``: final counter per product (partial + final aggregate);
- ``live_price``: last written price per product over seed, override sets and
  dynamic prices (``max_by`` on (time, kind, seq), pre-aggregated map-side);
- ``seeded_live_state``: demand and price per product after seeding, as one
  aggregation over the three writers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.operators import ingest, overrides
from pricestream.operators.scan import CELL, WHOLE, Running, carries, running_sum
from pricestream.session import materialize

EVENT_ORDER = ("arrival_ts", "event_seq")


def with_weight(events: DataFrame) -> DataFrame:
    """Adds ``w``; an existing non-null ``w`` (a carried-in demand seed) is kept."""
    w = X.demand_weight(F.col("event_type"))
    if "w" in events.columns:
        w = F.coalesce(F.col("w"), w)
    return events.withColumn("w", w)


def running_demand(valid_events: DataFrame, order: Sequence[str] = EVENT_ORDER,
                   rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL) -> DataFrame:
    """Operator 27 on valid events without the override gate: adds ``w`` and ``demand``
    (a skew-safe ordered scan)."""
    return running_sum(with_weight(valid_events), "product_id", list(order), "w", "demand", rows_per_cell)


def gated_demand(valid_events: DataFrame, effective: DataFrame, order: Sequence[str] = EVENT_ORDER,
                 rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL, keep: Sequence[str] | None = None,
                 first: DataFrame | None = None, shared: bool = True) -> DataFrame:
    """Every valid event with its ``gate`` and the ``demand`` after it (operators 27, 36, 37),
    counted over the accepted events of its raw id.

    The gate and the demand are windows over the same exchange. ``shared``: the result is written
    once for several readers; it always is where an id was cut into cells, because what the earlier
    cells counted is known only after the gate. ``keep``: columns to keep (default all). ``first``: see ``gate_events``.
    """
    assert tuple(order[:2]) == EVENT_ORDER, "order must start with arrival_ts, event_seq"
    gated, dealt = overrides.gate_events(with_weight(valid_events), effective, tuple(order[2:]), rows_per_cell, first)
    weight = F.when(F.col("gate").isNull(), F.col("w")).otherwise(F.lit(0).cast("bigint"))
    w = (Window.partitionBy(CELL, "__tid", "product_id").orderBy(*overrides.GATE_ORDER, *order[2:])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = gated.withColumn("__w", weight).withColumn("demand", F.sum("__w").over(w))
    names = list(keep) if keep else [*valid_events.columns, *(["w"] if "w" not in valid_events.columns else [])]
    if dealt.cut is None:
        local = local.select(*names, "gate", "demand")
        return materialize(local, "gated_demand") if shared else local
    local = materialize(local.select(*names, CELL, "__w", "gate", "demand"), "gated_demand")
    before = carries(local.where(F.col(CELL) != WHOLE), ["product_id"], (), __w=Running("sum", "__w"))
    return (local.join(before, [CELL, "product_id"], "left")
            .withColumn("demand", (F.col("demand") + F.coalesce(F.col("__from___w"), F.lit(0))).cast("bigint"))
            .select(*names, "gate", "demand"))


def priced(gated: DataFrame) -> DataFrame:
    """Operator 29 from ``gated_demand``: one row per accepted event with demand, new_price, update_ts."""
    return (gated.where(F.col("gate").isNull()).drop("gate")
            .withColumn("new_price", X.compute_price(F.col("price"), F.col("demand")))
            .withColumn("update_ts", X.update_timestamp_s(F.col("arrival_ts"))))


def demand_totals(accepted: DataFrame) -> DataFrame:
    """Operator 28: product_id, demand = sum of weights of accepted events."""
    return accepted.groupBy("product_id").agg(F.sum("w").cast("bigint").alias("demand"))


def dynamic_history(priced: DataFrame) -> DataFrame:
    """History rows of accepted events (source 'dynamic', time = arrival)."""
    return priced.select("product_id", F.col("new_price").alias("price"),
                         F.lit(K.SOURCE_DYNAMIC).alias("price_source"),
                         F.col("arrival_ts").alias("event_time"), F.col("event_seq").alias("seq"))


def live_price(priced: DataFrame, effective: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Operator 30: product_id, price = the last price written for the product.

    Writers: seed (catalog base price, before everything), override sets (at
    command time), dynamic prices (at arrival). Ties on time: seed, then
    commands, then events.

    The big input (accepted events) is reduced with fixed-width keys so Spark
    plans a partial+final hash aggregate: demand rises with every accepted event
    of a product, so its last event is the one with the highest demand. Only
    the per-product rows of the three writers meet in the struct-keyed max_by.
    """
    last_dyn = priced.groupBy("product_id").agg(
        F.max_by("new_price", "demand").alias("price"),
        F.max_by("arrival_ts", "demand").alias("t"),
        F.max_by("event_seq", "demand").alias("s"))
    w = [last_dyn.select("product_id", "price",
                         F.struct(F.col("t"), F.lit(K.KIND_EVENT).alias("k"), F.col("s")).alias("o")),
         effective.where(F.col("op") == K.OP_SET)
                  .select("product_id", F.col("override_price").alias("price"),
                          F.struct(F.col("cmd_ts").alias("t"), F.lit(K.KIND_COMMAND).alias("k"),
                                   F.col("cmd_seq").alias("s")).alias("o"))]
    if catalog is not None:
        w.append(catalog.select("product_id", F.col("base_price").alias("price"),
                                F.struct(F.lit(overrides.NEVER).cast("timestamp").alias("t"),
                                         F.lit(K.KIND_SEED).alias("k"),
                                         F.lit(-1).cast("bigint").alias("s")).alias("o")))
    u = w[0]
    for x in w[1:]:
        u = u.unionByName(x)
    return u.groupBy("product_id").agg(F.max_by("price", "o").alias("price"))


def seeded_live_state(priced: DataFrame, effective: DataFrame, catalog: DataFrame) -> DataFrame:
    """product_id, demand, price of the seeded live state (operators 28 + 30 + 39)
    as one aggregation over the union of the three writers.

    Same result as ``baseline.seed_live_state(catalog, totals full-outer live
    price)`` without joins: accepted events are first reduced per product by a
    hash aggregate (sum of weights, last price by demand), then meet the
    override sets and the catalog seed rows in one group-by per product.
    Catalog products get demand 0 when they have no events; a catalog row
    without a base price fails the job.
    """
    dyn = priced.groupBy("product_id").agg(
        F.sum("w").alias("d"), F.max_by("new_price", "demand").alias("price"),
        F.max_by("arrival_ts", "demand").alias("t"), F.max_by("event_seq", "demand").alias("s"))
    order = lambda t, k, s: F.struct(t.alias("t"), F.lit(k).alias("k"), s.alias("s"))
    base = F.when(F.col("base_price").isNull(),
                  F.raise_error(F.concat(F.lit("catalog base price missing for "), F.col("product_id")))) \
            .otherwise(F.col("base_price"))
    rows = [
        dyn.select("product_id", "d", "price", order(F.col("t"), K.KIND_EVENT, F.col("s")).alias("o"),
                   F.lit(False).alias("cat")),
        effective.where(F.col("op") == K.OP_SET).select(
            "product_id", F.lit(None).cast("bigint").alias("d"), F.col("override_price").alias("price"),
            order(F.col("cmd_ts"), K.KIND_COMMAND, F.col("cmd_seq")).alias("o"), F.lit(False).alias("cat")),
        catalog.select("product_id", F.lit(None).cast("bigint").alias("d"), base.alias("price"),
                       order(F.lit(overrides.NEVER).cast("timestamp"), K.KIND_SEED,
                             F.lit(-1).cast("bigint")).alias("o"), F.lit(True).alias("cat")),
    ]
    u = rows[0].unionByName(rows[1]).unionByName(rows[2])
    g = u.groupBy("product_id").agg(F.sum("d").alias("d"), F.max_by("price", "o").alias("price"),
                                    F.max("cat").alias("cat"))
    return g.select("product_id",
                    F.when(F.col("cat"), F.coalesce(F.col("d"), F.lit(0))).otherwise(F.col("d"))
                     .cast("bigint").alias("demand"),
                    "price")
