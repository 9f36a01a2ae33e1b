"""Registered queries for the brief's business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import brief as B
from ..streaming import speed
from . import oracle as O
from .layers import Layers
from .registry import query

_K = B.ANOMALY_LOOKBACK_HOURS
_Z = B.ANOMALY_Z
(_LOW, _LOW_NAME), (_MID, _MID_NAME) = B.DISCOUNT_BANDS


@query("top_products_per_category", O.sql("""
    WITH a AS (SELECT p.product_category_name, o.year, o.month, i.product_id, SUM(i.quantity) AS units,
                      CAST(SUM(i.price) AS DOUBLE) AS revenue
               FROM s_items i JOIN s_products p ON i.product_id = p.product_id
               JOIN unified o ON i.order_id = o.order_id GROUP BY 1, 2, 3, 4)
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_category_name, year, month
                                                ORDER BY units DESC, product_id ASC) AS "rank" FROM a) r
    WHERE "rank" <= 3""", "s_items", "s_products", "unified"))
def q_top_products(spark, sf):
    L = Layers(spark, sf)
    return B.top_products_per_category(L.items, L.products, L.unified_orders, k=3)


@query("demand_anomalies", O.sql(f"""
    WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start, order_status,
                      count(*) AS n_events FROM stream_orders GROUP BY 1, 2),
    ends AS (SELECT min(window_start) AS lo, max(window_start) AS hi FROM h),
    spine AS (SELECT s.order_status, t.ts AS window_start
              FROM (SELECT DISTINCT order_status FROM h) s, ends, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) t(ts)),
    full_h AS (SELECT p.window_start, p.order_status, COALESCE(h.n_events, 0) AS n, h.n_events IS NOT NULL AS present
               FROM spine p LEFT JOIN h ON h.window_start = p.window_start AND h.order_status IS NOT DISTINCT FROM p.order_status),
    s AS (SELECT window_start, order_status, n, AVG(CAST(n AS DOUBLE)) OVER w AS m, STDDEV_SAMP(CAST(n AS DOUBLE)) OVER w AS sd,
                 count(*) OVER w AS hours, MIN(n) OVER w AS least_n,
                 MAX(CASE WHEN present THEN window_start END) OVER (PARTITION BY order_status ORDER BY window_start) AS seen
          FROM full_h WINDOW w AS (PARTITION BY order_status ORDER BY window_start
                                   ROWS BETWEEN {_K} PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN sd > 1e-9 THEN (n - m) / sd END AS zs FROM s
          WHERE window_start <= seen + to_hours({_K}))
    SELECT window_start, order_status, CAST(n AS BIGINT) AS n_events, ROUND(m, 4) AS baseline_mean, ROUND(sd, 4) AS baseline_std,
           ROUND(zs, 4) AS z_score, COALESCE(zs > {_Z}, FALSE) AS is_spike,
           COALESCE(zs < -{_Z}, FALSE) OR (n = 0 AND hours * 2 >= {_K} AND COALESCE(least_n, 0) > 0) AS is_drop
    FROM z""", "stream_orders"))
def q_demand_anomalies(spark, sf):
    hourly = speed.hourly_counts(Layers(spark, sf).stream_orders)
    return B.demand_anomalies(hourly)


@query("discount_impact", O.sql(f"""
    SELECT CASE WHEN discount < {_LOW} THEN '{_LOW_NAME}' WHEN discount < {_MID} THEN '{_MID_NAME}'
                ELSE '{B.DISCOUNT_TOP_BAND}' END AS discount_band,
           count(*) AS n_items, SUM(quantity) AS units, CAST(SUM(price) AS DOUBLE) AS gross_revenue,
           CAST(CAST(SUM(price * (1 - discount)) AS DECIMAL(38,2)) AS DOUBLE) AS net_revenue,
           SUM(quantity) / count(*) AS units_per_item
    FROM s_items GROUP BY 1""", "s_items"))
def q_discount_impact(spark, sf):
    return B.discount_impact(Layers(spark, sf).items)


@query("co_purchase_pairs", O.sql("""
    WITH ip AS (SELECT i.order_id, i.product_id, p.product_category_name
                FROM s_items i JOIN s_products p ON i.product_id = p.product_id),
    oc AS (SELECT DISTINCT order_id, product_category_name AS co_category FROM ip)
    SELECT ip.product_id, oc.co_category, count(DISTINCT ip.order_id) AS n_orders
    FROM ip JOIN oc ON ip.order_id = oc.order_id
    WHERE oc.co_category <> ip.product_category_name
    GROUP BY 1, 2""", "s_items", "s_products"))
def q_co_purchase(spark, sf):
    L = Layers(spark, sf)
    return B.co_purchase_affinity(L.items, L.products)


_PAIRS = """
    ip AS (SELECT DISTINCT order_id, product_id FROM s_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL),
    one AS (SELECT product_id, count(*) AS n FROM ip GROUP BY 1),
    two AS (SELECT a.product_id AS x, b.product_id AS y, count(*) AS n
            FROM ip a JOIN ip b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2)"""
MIN_ORDERS = 2  # fixed value: orders that must hold a set


@query("frequent_itemsets", O.sql(f"""
    WITH {_PAIRS},
    three AS (SELECT a.product_id AS x, b.product_id AS y, c.product_id AS z, count(*) AS n
              FROM ip a JOIN ip b ON a.order_id = b.order_id AND a.product_id < b.product_id
              JOIN ip c ON a.order_id = c.order_id AND b.product_id < c.product_id GROUP BY 1, 2, 3)
    SELECT 1 AS size, x AS first_product, CAST(NULL AS BIGINT) AS second_product, CAST(NULL AS BIGINT) AS third_product, n AS n_orders
    FROM (SELECT product_id AS x, n FROM one WHERE n >= {MIN_ORDERS}) o
    UNION ALL SELECT 2, x, y, NULL, n FROM two WHERE n >= {MIN_ORDERS}
    UNION ALL SELECT 3, x, y, z, n FROM three WHERE n >= {MIN_ORDERS}""", "s_items"))
def q_frequent_itemsets(spark, sf):
    sets = B.frequent_itemsets(Layers(spark, sf).order_products, MIN_ORDERS)
    return sets.select(F.size("items").alias("size"), F.get("items", F.lit(0)).alias("first_product"),
                       F.get("items", F.lit(1)).alias("second_product"), F.get("items", F.lit(2)).alias("third_product"), "n_orders")


@query("product_candidates", O.sql(f"""
    WITH {_PAIRS},
    rules AS (SELECT x AS because, y AS candidate, n FROM two WHERE n >= {MIN_ORDERS}
              UNION ALL SELECT y, x, n FROM two WHERE n >= {MIN_ORDERS}),
    r AS (SELECT because, candidate, rules.n AS n_orders, rules.n / one.n AS confidence
          FROM rules JOIN one ON because = product_id),
    bought AS (SELECT DISTINCT o.customer_id, i.product_id FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
               WHERE o.customer_id IS NOT NULL),
    best AS (SELECT b.customer_id, r.candidate, r.because, r.n_orders, r.confidence,
                    row_number() OVER (PARTITION BY b.customer_id, r.candidate
                                       ORDER BY r.confidence DESC, r.n_orders DESC, r.because) AS k
             FROM bought b JOIN r ON b.product_id = r.because)
    SELECT customer_id, candidate, because, n_orders, confidence FROM best
    WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM bought x WHERE x.customer_id = best.customer_id AND x.product_id = best.candidate)""",
                                      "s_items", "s_orders"))
def q_product_candidates(spark, sf):
    L = Layers(spark, sf)
    return B.product_candidates(L.order_products, L.orders, MIN_ORDERS)
