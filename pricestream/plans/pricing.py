"""The batch pricing plan: inputs -> accepted events -> state, history, views.

``PricingPlan`` wires DataFrames together. While it is built it writes what several
outputs read: the per-product table (first seen, number of events), the effective commands and the
gated events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricestream import constants as K
from pricestream.operators import baseline, demand, ingest, overrides, serving
from pricestream.session import materialize, path_exists
from pricestream.sources import fixtures


#: Files per date of the price history.
HISTORY_FILES = 8
EVENT_COLUMNS = ("event_seq", "arrival_ts", "event_type", "product_id", "price", "w")


class PricingPlan:
    """The batch job over product events, an override command log and a catalog.

    - ``order``: arrival order of events, (arrival_ts, event_seq, *tie-breaks);
    - ``rows_per_cell``: target rows per cell of the ordered scans;
    - ``run_ts``: time of base history rows for products without history (default: now);
    - ``shared``: gated events are written once for several outputs (False: one output only).

    Tables that several outputs read are written once under ``spark.checkpoint.dir``.
    """

    def __init__(self, events: DataFrame, commands: DataFrame, catalog: DataFrame,
                 run_ts: str | None = None, order: Sequence[str] = demand.EVENT_ORDER, history_limit=50,
                 rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL, shared: bool = True):
        self.events = events
        self.commands = commands
        self.catalog = catalog
        self.run_ts = run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        self.order = tuple(order)
        self.history_limit = history_limit
        self.rows_per_cell = rows_per_cell
        self.shared = shared

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, stream: str = "events", **kw) -> "PricingPlan":
        ev = (fixtures.product_events(spark, sf_dir) if stream == "events"
              else fixtures.bench_events(spark, sf_dir))
        order = demand.EVENT_ORDER if stream == "events" else (*demand.EVENT_ORDER, *fixtures.BENCH_TIES)
        kw.setdefault("order", order)
        return cls(ev, fixtures.override_commands(spark, sf_dir), fixtures.catalog(spark, sf_dir), **kw)

    @cached_property
    def valid(self) -> DataFrame:
        return ingest.valid_product_events(self.events)

    @cached_property
    def first_seen(self) -> DataFrame:
        """product_id, since, n: first valid arrival and number of valid events per raw id."""
        return materialize(overrides.first_seen(self.valid), "first_seen")

    @cached_property
    def effective(self) -> DataFrame:
        return materialize(overrides.effective_commands(self.commands, self.catalog, self.valid, self.first_seen,
                                                        self.rows_per_cell), "effective")

    @cached_property
    def gated(self) -> DataFrame:
        """Every valid event with gate and demand (what history, state and views read of it)."""
        return demand.gated_demand(self.valid, self.effective, self.order, self.rows_per_cell, EVENT_COLUMNS,
                                   self.first_seen, self.shared)

    @cached_property
    def priced(self) -> DataFrame:
        """Accepted events with demand and price."""
        return demand.priced(self.gated)

    @cached_property
    def demand_totals(self) -> DataFrame:
        return demand.demand_totals(self.priced)

    @cached_property
    def live_state(self) -> DataFrame:
        """product_id, demand, price after seeding (operators 28, 30, 39), as one
        aggregation over the writers (see ``demand.seeded_live_state``)."""
        return demand.seeded_live_state(self.priced, self.effective, self.catalog)

    @cached_property
    def live_state_joined(self) -> DataFrame:
        """The same table through operator 39 as specified: totals full-outer live
        price, then seeded from the catalog."""
        lp = demand.live_price(self.priced, self.effective)
        unseeded = self.demand_totals.join(lp, "product_id", "full_outer")
        return baseline.seed_live_state(self.catalog, unseeded)

    @cached_property
    def overrides(self) -> DataFrame:
        return overrides.override_state(self.effective)

    @cached_property
    def history_core(self) -> DataFrame:
        return demand.dynamic_history(self.priced).unionByName(
            overrides.override_history_points(self.effective))

    @cached_property
    def base_rows(self) -> DataFrame:
        return baseline.base_price_history(self.catalog, self.history_core, self.run_ts)

    @cached_property
    def history(self) -> DataFrame:
        """price_history: product_id, price, price_source, event_time, seq."""
        return self.history_core.unionByName(self.base_rows)

    @cached_property
    def topn(self) -> DataFrame:
        return serving.price_history_topn(self.history, self.history_limit)

    @cached_property
    def current(self) -> DataFrame:
        return serving.current_price(self.live_state, self.overrides)


    def write(self, out_dir: str) -> None:
        """The batch job's sinks: ``price_history`` (partitioned by event date),
        ``live_state``, ``price_overrides``, ``current_price`` and ``rejected_events`` as
        Parquet tables.

        History partitions are replaced with dynamic partition overwrite, so
        re-running the job over the same input rewrites its own dates and adds
        no duplicate rows; base rows of earlier runs stay and no product gets a second
        one. The per-product tables are rewritten whole, clustered by product for lookups.
        """
        out = out_dir.rstrip("/")
        spark = self.events.sparkSession
        history = f"{out}/price_history"
        known, old = self.history_core, None
        if path_exists(spark, history):
            old = spark.read.parquet(history).where(F.col("price_source") == K.SOURCE_BASE).drop("event_date")
            old = materialize(old, "base_history").select(known.columns)
            known = known.unionByName(old)
        base = baseline.base_price_history(self.catalog, known, self.run_ts)
        prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows = known.unionByName(base)
            # a few files per date: dates are dealt with a salt against a day with most rows
            (rows.withColumn("event_date", F.to_date("event_time"))
                 .withColumn("__salt", F.pmod(F.xxhash64("product_id"), F.lit(HISTORY_FILES)))
                 .repartition("event_date", "__salt").drop("__salt")
                 .sortWithinPartitions("event_date", "product_id", "event_time")
                 .write.mode("overwrite").partitionBy("event_date").parquet(history))
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
        write_by_product(self.live_state, f"{out}/live_state")
        write_by_product(overrides.price_overrides_snapshot(self.overrides), f"{out}/price_overrides")
        write_by_product(self.current, f"{out}/current_price")
        rejected = self.events.withColumn("reason", ingest.reject_reason()).where(F.col("reason").isNotNull())
        rejected.write.mode("overwrite").parquet(f"{out}/rejected_events")


def write_by_product(df: DataFrame, path: str, rows_per_group: int = 100_000) -> None:
    """A per-product table for lookups: files are ranges of ids, sorted, in row groups of bounded size with a bloom
    filter on the id. A lookup by id (a pushed filter) reads one row group or, for an id that is not there, none."""
    (df.repartitionByRange("product_id").sortWithinPartitions("product_id").write.mode("overwrite")
     .option("parquet.block.row.count.limit", rows_per_group)
     .option("parquet.bloom.filter.enabled#product_id", "true")
     .option("parquet.bloom.filter.expected.ndv#product_id", rows_per_group).parquet(path))


def normalize_output(df: DataFrame) -> DataFrame:
    """Result types the DuckDB oracle also produces: integers as bigint,
    timestamps as timestamp_ntz (the driver's Parquet type)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
