"""Skew probe: the same plan on the given items and on a copy where one order
holds a third of all rows.

Usage: python tools/skew_probe.py [sf_dir]

Runs dedup → items ⋈ orders → category aggregate into the noop sink, with
broadcast joins disabled (as for tables too large to broadcast) and AQE's
skew threshold scaled down to the data size, and prints seconds and whether
AQE split a skewed partition. The skewed copy is derived by Spark from the
given tables; nothing is written.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import gold as G  # noqa: E402
from strata.operators import silver as S  # noqa: E402
from strata.session import get_session  # noqa: E402
from strata.sources import testdata as D  # noqa: E402

HOT_ORDER = 7


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(**{"spark.sql.autoBroadcastJoinThreshold": "-1",
                           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                           "spark.sql.shuffle.partitions": "32",
                           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
                           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"})
    items = D.raw_order_items(spark, sf)
    # every third row (by a hash of its identity) moves to one order; the
    # line number is rewritten from the source row so keys stay distinct
    hot = F.pmod(F.hash("order_id", "order_item_id", "product_id"), F.lit(3)) == 0
    skewed = items.withColumns({
        "order_item_id": F.when(hot, F.abs(F.hash("order_id", "order_item_id", "product_id")))
        .otherwise(F.col("order_item_id")),
        "order_id": F.when(hot, F.lit(HOT_ORDER).cast("long")).otherwise(F.col("order_id")),
    })
    orders = S.clean_orders(D.raw_orders(spark, sf))
    products = S.clean_products(D.raw_products(spark, sf))
    for label, src in [("uniform", items), ("one order = 1/3 of rows", skewed)]:
        df = G.sales_by_category(S.clean_order_items(src), products, orders)
        times = []
        for _ in range(3):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        hot_rows = src.filter(F.col("order_id") == HOT_ORDER).count()
        print(f"{label}: median {statistics.median(times):.2f}s, rows in order {HOT_ORDER}: {hot_rows}, "
              f"skew split: {'SortMergeJoin(skew=true)' in plan}", flush=True)


if __name__ == "__main__":
    main()
