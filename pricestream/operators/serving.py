"""Serving views: operators 3, 41-47.

Whole-table DataFrames instead of per-request lookups; a single product is a
filter that Catalyst pushes into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X


def catalog_prices(catalog: DataFrame) -> DataFrame:
    """Operator 3: product_id, base_price (ordered by id when displayed)."""
    return catalog.select("product_id", "base_price")


def known_products(live_state: DataFrame) -> DataFrame:
    """Operator 41: products having a demand or a price entry."""
    return (live_state.where(F.col("demand").isNotNull() | F.col("price").isNotNull())
                      .select("product_id").distinct())


def price_history_topn(history: DataFrame, limit=K.DEFAULT_HISTORY_LIMIT,
                       product_id: str | None = None) -> DataFrame:
    """Operator 42: per product the latest N rows, newest first, rn = 1..N.

    Ties on event_time are broken by seq (newest command/event first). Spark
    plans ``row_number() <= N`` as WindowGroupLimit on both sides of the shuffle,
    so each map task forwards at most N rows per product (safe for hot products).
    """
    n = X.check_history_limit(limit)
    # only ids the history endpoint accepts (pattern on the untrimmed id)
    h = history.where(X.valid_product_id(F.col("product_id")))
    if product_id is not None:
        h = h.where(F.col("product_id") == product_id)
    w = Window.partitionBy("product_id").orderBy(F.col("event_time").desc(), F.col("seq").desc())
    return (h.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
             .select("product_id", "rn", "price",
                     X.default_price_source(F.col("price_source")).alias("price_source"),
                     "event_time"))


def history_exists(catalog: DataFrame, history: DataFrame) -> DataFrame:
    """Operator 43: product_id, has_history for every catalog product."""
    has = history.select("product_id").distinct().withColumn("__h", F.lit(True))
    return (catalog.select("product_id").join(has, "product_id", "left")
                   .select("product_id", F.coalesce(F.col("__h"), F.lit(False)).alias("has_history")))


def current_price(live_state: DataFrame, overrides: DataFrame, product_id: str | None = None) -> DataFrame:
    """Operator 44: product_id, price, demand, price_source.

    Needs a demand entry; an active override wins ('override'), else the live
    price ('dynamic'); no price at all -> no row. Only ids the price endpoint
    accepts (pattern on the untrimmed id) are served.
    """
    ls = live_state.where(F.col("demand").isNotNull() & X.valid_product_id(F.col("product_id")))
    if product_id is not None:
        ls = ls.where(F.col("product_id") == product_id)
        overrides = overrides.where(F.col("product_id") == product_id)
    j = ls.join(overrides.select("product_id", "override_price"), "product_id", "left")
    has_o = F.col("override_price").isNotNull()
    return (j.where(has_o | F.col("price").isNotNull())
             .select("product_id",
                     F.when(has_o, F.col("override_price")).otherwise(F.col("price")).alias("price"),
                     F.col("demand").cast("bigint").alias("demand"),
                     F.when(has_o, F.lit(K.SOURCE_OVERRIDE)).otherwise(F.lit(K.SOURCE_DYNAMIC))
                      .alias("price_source")))


def price_chart_series(topn: DataFrame, current: DataFrame) -> DataFrame:
    """Operator 45: product_id, pos, price (2 dp), price_source.

    The latest rows in ascending time; while the product's current price is an
    override, the series ends at its last override point.
    """
    n = F.max("rn").over(Window.partitionBy("product_id"))
    s = topn.withColumn("pos", (n - F.col("rn") + 1).cast("int"))
    last_o = F.max(F.when(F.col("price_source") == K.SOURCE_OVERRIDE, F.col("pos"))) \
              .over(Window.partitionBy("product_id"))
    active = current.where(F.col("price_source") == K.SOURCE_OVERRIDE) \
                    .select("product_id", F.lit(True).alias("__active"))
    s = s.withColumn("__last_o", last_o).join(active, "product_id", "left")
    cut = F.coalesce(F.col("__active"), F.lit(False)) & F.col("__last_o").isNotNull()
    return (s.where(~cut | (F.col("pos") <= F.col("__last_o")))
             .select("product_id", "pos", X.round_price_2dp(F.col("price")).alias("price"),
                     "price_source"))


def history_source_flags(topn: DataFrame) -> DataFrame:
    """Operator 46: product_id, has_base, has_override over the fetched rows."""
    return topn.groupBy("product_id").agg(
        F.bool_or(F.col("price_source") == K.SOURCE_BASE).alias("has_base"),
        F.bool_or(F.col("price_source") == K.SOURCE_OVERRIDE).alias("has_override"))


def changed_product_snapshot(updates: DataFrame, current: DataFrame) -> DataFrame:
    """Operator 47: current price of the products that received an update."""
    changed = updates.select("product_id").distinct()
    return current.join(changed, "product_id", "left_semi")
