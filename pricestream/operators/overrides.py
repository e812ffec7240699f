"""Overrides: operators 14 and 32-38.

The command log ``(cmd_seq, cmd_ts, product_id, op, override_price, reason)`` is
the source of truth; the overrides table, the active flag and the removal time
are folds of it.

- a ``set`` is effective when valid (operator 13) and its product is known at
  command time (operator 14);
- a ``remove`` is effective when valid and the product's previous valid command
  is a set (deleting a missing row changes nothing);
- the gate drops an event when the last effective command of its trimmed id
  (as of its arrival) is a set, or is a remove with event ms <= removal ms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X
from pricestream.operators import ingest
from pricestream.operators.scan import CELL, Dealt, Running, deal, running_last, scan

NEVER = "0001-01-01 00:00:00"


def known_since(catalog: DataFrame, valid_events: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """product_id, since: the time a product got a demand or price key.

    Catalog products are seeded before any event (``since`` = minimum time);
    others become known with their first valid event (keyed by the raw id).
    A partial+final min aggregate: pre-aggregated before the shuffle.
    """
    seeded = catalog.select("product_id", F.lit(NEVER).cast("timestamp").alias("since"))
    first = first if first is not None else first_seen(valid_events)
    return seeded.unionByName(first.select("product_id", "since")).groupBy("product_id").agg(F.min("since").alias("since"))


def first_seen(valid_events: DataFrame) -> DataFrame:
    """product_id (raw), since = first valid arrival, n = valid events. One aggregate, added
    up before the shuffle, for the known-product check and for the keys that the gate has to cut."""
    return valid_events.groupBy("product_id").agg(F.min("arrival_ts").alias("since"),
                                                  F.count(F.lit(1)).alias("n"))


def known_product_commands(valid_commands: DataFrame, known: DataFrame) -> DataFrame:
    """Operator 14: valid sets whose product was known strictly before the command
    (commands sort before events that share their timestamp)."""
    sets = valid_commands.where(F.col("op") == K.OP_SET)
    k = known.select(F.col("product_id").alias("__kp"), F.col("since").alias("__since"))
    cond = (sets["product_id"] == k["__kp"]) & (k["__since"] < sets["cmd_ts"])
    return sets.join(k, cond, "left_semi")


def effective_commands(commands: DataFrame, catalog: DataFrame, valid_events: DataFrame,
                       first: DataFrame | None = None, rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL) -> DataFrame:
    """Valid sets of known products plus removes that directly follow a set.

    Output: cmd_seq, cmd_ts, product_id, op, override_price, reason.
    The "previous command" is a skew-safe ordered scan per product.
    """
    valid = ingest.valid_override_commands(commands)
    sets = known_product_commands(valid, known_since(catalog, valid_events, first))
    removes = valid.where(F.col("op") == K.OP_REMOVE)
    both = sets.unionByName(removes)
    counts = valid.groupBy("product_id").agg(F.count(F.lit(1)).alias("__n"))  # sets of unknown products too
    prev = running_last(both, "product_id", ["cmd_ts", "cmd_seq"], "op", "__prev_op", inclusive=False,
                        rows_per_cell=rows_per_cell, counts=counts)
    keep = (F.col("op") == K.OP_SET) | (F.col("__prev_op") == K.OP_SET)
    return prev.where(keep).drop("__prev_op")


def override_state(commands: DataFrame) -> DataFrame:
    """Operator 34: active overrides (product_id, override_price, reason, set_time).

    The last valid command per product decides: a set -> that row; a remove ->
    no row (whether or not it deleted one). ``max_by`` is a partial+final
    aggregate, so a product with many commands is pre-aggregated map-side.
    ``commands`` must already be valid (operator 13) and known (operator 14).
    """
    last = (commands.groupBy("product_id")
                    .agg(F.max_by(F.struct("op", "override_price", "reason", "cmd_ts"),
                                  F.struct("cmd_ts", "cmd_seq")).alias("l")))
    return (last.where(F.col("l.op") == K.OP_SET)
                .select("product_id", F.col("l.override_price").alias("override_price"),
                        F.col("l.reason").alias("reason"), F.col("l.cmd_ts").alias("set_time")))


def price_overrides_snapshot(overrides: DataFrame, product_id: str | None = None) -> DataFrame:
    """Operator 4: the overrides table as read (a null reason reads as ''); with
    ``product_id`` the single-row lookup, a filter pushed into the table scan."""
    o = overrides if product_id is None else overrides.where(F.col("product_id") == product_id)
    return o.select("product_id", "override_price",
                    F.coalesce(F.col("reason"), F.lit("")).alias("reason"), "set_time")


def override_upsert(snapshot: DataFrame, incoming_sets: DataFrame) -> DataFrame:
    """Operator 32: MERGE of the latest incoming set per product into the snapshot.

    Matched rows take the new price, reason and time; new products are inserted;
    others are kept. Full outer join of two per-product tables.
    """
    new = latest_sets(incoming_sets).select("product_id", F.struct("override_price", "reason", "set_time").alias("n"))
    j = snapshot.join(new, "product_id", "full_outer")
    pick = lambda c: F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(c)).alias(c)
    return j.select("product_id", pick("override_price"), pick("reason"), pick("set_time"))


#: Rows of the overrides table.
SNAPSHOT = "product_id string, override_price double, reason string, set_time timestamp"


def latest_sets(sets: DataFrame) -> DataFrame:
    """The row that each product's latest set writes. A ``ProductTable`` of overrides takes these as its changes, and the ids
    of removals as its deletions: only the files of their buckets are written."""
    last = sets.groupBy("product_id").agg(F.max_by(F.struct("override_price", "reason", "cmd_ts"),
                                                   F.struct("cmd_ts", "cmd_seq")).alias("n"))
    return last.select("product_id", F.col("n.override_price").alias("override_price"), F.col("n.reason").alias("reason"),
                       F.col("n.cmd_ts").alias("set_time"))


def override_delete(snapshot: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Operator 33: (survivors, per-request deleted flag).

    ``requests`` has product_id (distinct ids). deleted = a row existed.
    """
    survivors = snapshot.join(requests.select("product_id"), "product_id", "left_anti")
    hit = requests.select("product_id").distinct().join(
        snapshot.select("product_id").withColumn("__hit", F.lit(True)), "product_id", "left")
    flags = hit.select("product_id", F.coalesce(F.col("__hit"), F.lit(False)).alias("deleted"))
    return survivors, flags


def override_intervals(effective: DataFrame, rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL) -> DataFrame:
    """Operator 35: active episodes (product_id, set_at, removed_at; null = open).

    An episode starts at an effective set whose previous effective command is not
    a set, and ends at the next effective remove: both from one ordered scan.
    """
    marked = effective.withColumn("__end", F.when(F.col("op") == K.OP_REMOVE, F.col("cmd_ts")))
    done = scan(deal(marked, "product_id", ["cmd_ts", "cmd_seq"], rows_per_cell),
                __prev=Running("last", "op", inclusive=False), __next_end=Running("next", "__end"))
    is_start = (F.col("op") == K.OP_SET) & (F.coalesce(F.col("__prev"), F.lit("")) != K.OP_SET)
    return (done.where(is_start)
                .select("product_id", F.col("cmd_ts").alias("set_at"), F.col("__next_end").alias("removed_at")))


def override_history_points(effective: DataFrame) -> DataFrame:
    """Operator 38: one 'override' history row per effective set; none for removes."""
    return (effective.where(F.col("op") == K.OP_SET)
                     .select("product_id", F.col("override_price").alias("price"),
                             F.lit(K.SOURCE_OVERRIDE).alias("price_source"),
                             F.col("cmd_ts").alias("event_time"), F.col("cmd_seq").alias("seq")))


GATE_ORDER = ("__ts", "__kind", "__seq")


def gate_events(valid_events: DataFrame, effective: DataFrame, tie_break: tuple[str, ...] = (),
                rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL, first: DataFrame | None = None) -> tuple[DataFrame, Dealt]:
    """Operators 36 + 37: tag each valid event with ``gate`` in
    {null (accepted), 'override_active', 'stale_after_removal'}; also returns the dealt rows.

    As-of lookup by union + ordered scan over the trimmed id: events and commands are
    ordered by (time, commands first, seq, *tie_break), each event carries the last
    command before it. The output keeps ``__cell``, ``__tid`` and the order columns, and its
    partitioning by (cell, trimmed id), for the demand scan. ``first``: the table of ``first_seen``,
    whose counts say which ids have to be cut (else they are counted here).

    A command's ``gate_ms``, where it has one, is the removal time that counts
    (a removal carried over from an earlier micro-batch).
    """
    cols = list(valid_events.columns)
    order = [*GATE_ORDER, *tie_break]
    ev = valid_events.select(*cols, X.trim_unicode(F.col("product_id")).alias("__tid"),
                             F.col("arrival_ts").alias("__ts"), F.lit(K.KIND_EVENT).alias("__kind"),
                             F.col("event_seq").alias("__seq"),
                             F.lit(None).cast("struct<op:string,ms:bigint>").alias("__cmd"))
    ms = X.epoch_ms("cmd_ts")
    if "gate_ms" in effective.columns:
        ms = F.coalesce(F.col("gate_ms"), ms)
    cmd = effective.select(
        *(F.lit(None).cast(valid_events.schema[c].dataType).alias(c) for c in cols if c not in tie_break),
        *(F.lit(0).cast(valid_events.schema[c].dataType).alias(c) for c in tie_break),
        F.col("product_id").alias("__tid"), F.col("cmd_ts").alias("__ts"), F.lit(K.KIND_COMMAND).alias("__kind"),
        F.col("cmd_seq").alias("__seq"), F.struct(F.col("op").alias("op"), ms.alias("ms")).alias("__cmd"))
    per_id = first if first is not None else first_seen(valid_events)
    per_id = per_id.select(X.trim_unicode(F.col("product_id")).alias("__tid"), "n").unionByName(
        effective.select(F.col("product_id").alias("__tid"), F.lit(1).cast("bigint").alias("n")))
    counts = per_id.groupBy("__tid").agg(F.sum("n").alias("__n"))
    dealt = deal(ev.unionByName(cmd), "__tid", order, rows_per_cell, counts)
    scanned = scan(dealt, __last=Running("last", "__cmd")).where(F.col("__kind") == K.KIND_EVENT)
    ev_ms = X.normalize_event_ms(F.col("timestamp"))
    gate = (F.when(F.col("__last.op") == K.OP_SET, F.lit("override_active"))
            .when((F.col("__last.op") == K.OP_REMOVE) & (ev_ms <= F.col("__last.ms")),
                  F.lit("stale_after_removal")))
    return scanned.select(*cols, CELL, "__tid", *GATE_ORDER, gate.alias("gate")), dealt
