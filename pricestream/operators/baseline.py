"""Baseline seeding: operators 39 and 40.

Both are insert-if-missing per product and idempotent: running them again on
their own output adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X


def seed_live_state(catalog: DataFrame, live_state: DataFrame) -> DataFrame:
    """Operator 39: product_id, demand, price after seeding the catalog.

    Catalog products lacking demand get 0; lacking a price get the base price
    (independently). A catalog row without a base price fails the job, as the
    reference refuses to start. Full outer join of two per-product tables.
    """
    cat = catalog.select("product_id",
                         F.when(F.col("base_price").isNull(),
                                F.raise_error(F.concat(F.lit("catalog base price missing for "),
                                                       F.col("product_id"))))
                          .otherwise(F.col("base_price")).alias("base_price"),
                         F.lit(True).alias("__cat"))
    j = live_state.join(cat, "product_id", "full_outer")
    is_cat = F.coalesce(F.col("__cat"), F.lit(False))
    return j.select("product_id",
                    F.when(is_cat, F.coalesce(F.col("demand"), F.lit(0).cast("bigint")))
                     .otherwise(F.col("demand")).alias("demand"),
                    F.when(is_cat, F.coalesce(F.col("price"), F.col("base_price")))
                     .otherwise(F.col("price")).alias("price"))


def base_price_history(catalog: DataFrame, history: DataFrame, run_ts: str) -> DataFrame:
    """Operator 40: base history rows to insert (product_id, price, price_source,
    event_time, seq).

    None for a product that already has a base row (a null source counts as
    'dynamic'); otherwise at its earliest history time minus 1 ms, or at
    ``run_ts`` when it has no history.
    """
    src = X.default_price_source(F.col("price_source"))
    stats = history.groupBy("product_id").agg(
        F.min("event_time").alias("__first"),
        F.max((src == K.SOURCE_BASE).cast("int")).alias("__has_base"))
    j = catalog.join(stats, "product_id", "left")
    return (j.where(F.coalesce(F.col("__has_base"), F.lit(0)) == 0)
             .select("product_id", F.col("base_price").alias("price"),
                     F.lit(K.SOURCE_BASE).alias("price_source"),
                     F.coalesce(X.base_seed_time(F.col("__first")),
                                F.lit(run_ts).cast("timestamp")).alias("event_time"),
                     F.lit(-1).cast("bigint").alias("seq")))
