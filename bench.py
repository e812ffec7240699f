"""Benchmark of the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced with a ``noop`` write (full computation, nothing collected).
Times are wall-clock seconds, the best of BENCH_REPEAT (default 3) runs, after one
warm-up run of every query on sf0.001. Each run builds its plan from scratch
(including the sample for the cell bounds and every written table).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricestream.operators import serving  # noqa: E402
from pricestream.plans import queries as Q  # noqa: E402
from pricestream.plans.pricing import PricingPlan  # noqa: E402
from pricestream.session import build_session  # noqa: E402
from pricestream.sources import fixtures  # noqa: E402


REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def headline(spark, sf_dir):
    """name -> zero-arg callable building the DataFrame."""
    def li(**kw):
        return PricingPlan.from_tables(spark, sf_dir, stream="lineitem", run_ts=fixtures.RUN_TS, **kw)
    return {
        # full chain over the lineitem stream: decode/validate -> gate -> demand -> price
        "lineitem_dynamic_price_events": lambda: li(shared=False).priced.select(
            "event_seq", "product_id", "demand", "new_price", "update_ts"),
        # history (base + dynamic + override) -> latest 50 per product
        "lineitem_price_history_topn": lambda: li().topn,
        # seeded live state + overrides -> current price per product
        "lineitem_current_price": lambda: li().current,
        # chart series on top of top-N and current price
        "lineitem_price_chart_series": lambda: (lambda p: serving.price_chart_series(p.topn, p.current))(li()),
        # the same chain over the events fixture
        "dynamic_price_events": lambda: Q.dynamic_price_events(spark, sf_dir),
        "price_history_topn": lambda: Q.price_history_topn(spark, sf_dir),
        "rejected_product_events": lambda: Q.rejected_product_events(spark, sf_dir),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="pricestream-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    warm = "/root/testdata/sf0.001"
    for name, build in headline(spark, warm).items():
        _run(build())
    times = {}
    for name, build in headline(spark, sf_dir).items():
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            _run(build())
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
