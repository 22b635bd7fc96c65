"""Wall-clock times of the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the driver tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the median counts (default 2, after one warm-up)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.bindings.registered import REGISTERED  # noqa: E402
from tradewind.session import local_session  # noqa: E402

HEADLINE = (
    "dedup_keep_last", "clean_orders", "clean_geolocation", "q07_conflicting_identity", "q10_payment_mismatch",
    "q11_mom_growth", "q12_top_products_per_category",
    "q13_clv_tiers", "q14_sales_rollup", "q15_top_category_per_month", "q16_customer_360", "q17_bought_a_never_b",
    "q18_best_product_per_seller_category", "q19_market_basket", "q20_shipping_delays", "q21_above_state_average",
    "q22_second_product", "q24_consecutive_months", "q25_moving_average", "q26_order_gap",
    "q27_top_sellers_per_state", "q28_running_total", "q29_discount", "q30_layout",
    "q30_layout_top_products", "q30_layout_bought_a_never_b",
)


def timed(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores))
    for name in names:  # warm-up of the whole set, so that no query pays for another's class loading
        timed(spark, REGISTERED[name], folder)
    seconds = {
        name: round(statistics.median(timed(spark, REGISTERED[name], folder) for _ in range(runs)), 3) for name in names
    }
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
