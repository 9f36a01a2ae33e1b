"""Registered queries for the designed gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold_extra as GX
from ..sources import testdata as D
from . import oracle as O
from .layers import Layers
from .registry import query

_PERSON = "valued v JOIN cur_customers c ON v.customer_id = c.customer_id"


@query("gold_customer_frequency", O.sql(f"""
    SELECT c.customer_unique_id, count(v.order_id) AS n_orders,
           count(DISTINCT v.year * 100 + v.month) AS active_months,
           CAST(SUM(v.final_order_value) AS DOUBLE) / COUNT(v.final_order_value) AS avg_ticket,
           CAST(SUM(v.final_order_value) AS DOUBLE) AS monetary,
           CAST(SUM(v.final_order_value) AS DOUBLE) / count(DISTINCT v.year * 100 + v.month)
             AS monetary_per_active_month
    FROM {_PERSON} GROUP BY c.customer_unique_id""", "valued", "cur_customers"))
def q_customer_frequency(spark, sf):
    L = Layers(spark, sf)
    return GX.customer_frequency(L.unified_orders, L.order_values, L.customers)


@query("gold_revenue_by_region", O.sql(f"""
    SELECT customer_state, year, month, CAST(rev AS DOUBLE) AS revenue, n_orders,
           CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER (PARTITION BY customer_state, year) AS DOUBLE)
             AS month_share_of_year
    FROM (SELECT c.customer_state, v.year, v.month, SUM(v.final_order_value) AS rev, count(v.order_id) AS n_orders
          FROM {_PERSON} GROUP BY 1, 2, 3) a""", "valued", "cur_customers"))
def q_revenue_by_region(spark, sf):
    L = Layers(spark, sf)
    return GX.revenue_by_region(L.unified_orders, L.order_values, L.customers)


@query("gold_new_vs_returning", O.sql(f"""
    WITH t AS (
      SELECT v.*, ROW_NUMBER() OVER (PARTITION BY c.customer_unique_id
               ORDER BY v.order_purchase_timestamp ASC NULLS FIRST, v.order_id ASC NULLS FIRST) = 1 AS is_new
      FROM {_PERSON})
    SELECT year, month, count(*) FILTER (WHERE is_new) AS new_orders,
           count(*) FILTER (WHERE NOT is_new) AS returning_orders,
           CAST(COALESCE(SUM(final_order_value) FILTER (WHERE is_new), 0) AS DOUBLE) AS new_revenue,
           CAST(COALESCE(SUM(final_order_value) FILTER (WHERE NOT is_new), 0) AS DOUBLE) AS returning_revenue,
           CAST(COALESCE(SUM(final_order_value) FILTER (WHERE is_new), 0) AS DOUBLE)
             / CAST(SUM(final_order_value) AS DOUBLE) AS new_revenue_share
    FROM t GROUP BY year, month""", "valued", "cur_customers"))
def q_new_vs_returning(spark, sf):
    L = Layers(spark, sf)
    return GX.new_vs_returning(L.unified_orders, L.order_values, L.customers)


@query("gold_price_vs_volume", O.sql("""
    WITH pp AS (SELECT p.product_category_name, i.product_id, SUM(i.price) AS rev, COUNT(i.price) AS n,
                       SUM(i.quantity) AS units
                FROM s_items i JOIN s_products p ON i.product_id = p.product_id GROUP BY 1, 2)
    SELECT product_category_name, count(*) AS n_products, SUM(units) AS units,
           CAST(SUM(rev) AS DOUBLE) / SUM(n) AS avg_price,
           ROUND(corr(CAST(rev AS DOUBLE) / n, CAST(units AS DOUBLE)), 6) AS price_volume_corr
    FROM pp GROUP BY product_category_name""", "s_items", "s_products"))
def q_price_vs_volume(spark, sf):
    L = Layers(spark, sf)
    return GX.price_vs_volume(L.items, L.products)


@query("gold_payment_performance", O.sql("""
    SELECT payment_type, CAST(rev AS DOUBLE) AS revenue, transactions,
           CAST(rev AS DOUBLE) / transactions AS avg_ticket, avg_installments,
           CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) AS revenue_share
    FROM (SELECT payment_type, SUM(payment_value) AS rev, count(*) AS transactions,
                 CAST(SUM(payment_installments) AS DOUBLE) / COUNT(payment_installments) AS avg_installments
          FROM s_payments GROUP BY payment_type) a""", "s_payments"))
def q_payment_performance(spark, sf):
    return GX.payment_performance(Layers(spark, sf).payments)


@query("gold_product_profitability", O.sql("""
    SELECT a.product_id, p.product_category_name, a.units, CAST(rev AS DOUBLE) AS revenue,
           CAST(fr AS DOUBLE) AS freight, CAST(rev - fr AS DOUBLE) AS net_of_freight,
           CAST(rev - fr AS DOUBLE) / CAST(rev AS DOUBLE) AS net_ratio
    FROM (SELECT product_id, SUM(price) AS rev, SUM(freight_value) AS fr, SUM(quantity) AS units
          FROM s_items GROUP BY product_id) a
    LEFT JOIN s_products p ON a.product_id = p.product_id""", "s_items", "s_products"))
def q_product_profitability(spark, sf):
    L = Layers(spark, sf)
    return GX.product_profitability(L.items, L.products)


@query("gold_weather_impact", O.sql(f"""
    WITH w AS (SELECT month(ts) AS m, day(ts) AS d, hour(ts) AS h,
                      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS temperature
               FROM events GROUP BY 1, 2, 3),
    wb AS (SELECT m, d, h,
                  CASE WHEN temperature < {GX.BAND_COOL_BELOW} THEN 'cool'
                       WHEN temperature < {GX.BAND_MILD_BELOW} THEN 'mild' ELSE 'warm' END AS condition_band
           FROM w)
    SELECT v.year, v.month, COALESCE(wb.condition_band, '{GX.NO_WEATHER}') AS condition_band, count(v.order_id) AS n_orders,
           CAST(SUM(v.final_order_value) AS DOUBLE) AS revenue
    FROM valued v LEFT JOIN wb ON month(v.order_purchase_timestamp) = wb.m AND day(v.order_purchase_timestamp) = wb.d
                         AND hour(v.order_purchase_timestamp) = wb.h
    GROUP BY 1, 2, 3""", "valued"))
def q_weather_impact(spark, sf):
    L = Layers(spark, sf)
    return GX.weather_impact(L.unified_orders, L.order_values, D.weather_hourly(spark, sf))


@query("sales_obt", O.sql("""
    WITH ic AS (SELECT i.order_id, p.product_category_name, SUM(i.price) AS rev, count(*) AS n
                FROM s_items i LEFT JOIN s_products p ON i.product_id = p.product_id GROUP BY 1, 2),
    po AS (SELECT order_id, SUM(n) AS n_items, CAST(SUM(rev) AS DOUBLE) AS items_revenue,
                  max(product_category_name) FILTER (WHERE rk = 1) AS top_category
           FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                          ORDER BY rev DESC, product_category_name ASC NULLS FIRST) AS rk FROM ic) r
           GROUP BY order_id)
    SELECT v.order_id, v.customer_id, v.order_status, v.order_purchase_timestamp, v.year, v.month, v.origin,
           c.customer_state, c.customer_city, COALESCE(po.n_items, 0) AS n_items,
           COALESCE(po.items_revenue, 0.0) AS items_revenue, po.top_category,
           CAST(v.final_order_value AS DOUBLE) AS final_order_value
    FROM valued v LEFT JOIN po ON v.order_id = po.order_id
    LEFT JOIN cur_customers c ON v.customer_id = c.customer_id""", "valued", "s_items", "s_products",
                          "cur_customers"))
def q_sales_obt(spark, sf):
    L = Layers(spark, sf)
    return GX.sales_obt(L.unified_orders, L.order_values, L.items, L.products, L.customers)


# Stations report every few hours, and a reading stands for so long.
READING_EACH_HOURS = 6
READING_HOLDS = 3 * 3600


@query("orders_weather_asof", O.sql(f"""
    WITH w AS (SELECT date_trunc('hour', ts) AS obs_hour,
                      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS temperature
               FROM events WHERE hour(ts) % {READING_EACH_HOURS} = 0 GROUP BY 1)
    SELECT u.order_id, u.order_purchase_timestamp,
           CASE WHEN u.order_purchase_timestamp <= w.obs_hour + to_seconds({READING_HOLDS}) THEN w.obs_hour END AS obs_hour,
           CASE WHEN u.order_purchase_timestamp <= w.obs_hour + to_seconds({READING_HOLDS}) THEN w.temperature END AS temperature
    FROM unified u ASOF LEFT JOIN w ON u.order_purchase_timestamp >= w.obs_hour""", "unified"))
def q_orders_weather_asof(spark, sf):
    """Every order with the nearest earlier weather reading, at most three hours old."""
    from ..operators.asof import asof_join
    from ..sources import testdata as D
    readings = D.weather_hourly(spark, sf).where(F.hour("obs_hour") % READING_EACH_HOURS == 0)
    orders = Layers(spark, sf).unified_orders.select("order_id", "order_purchase_timestamp")
    return asof_join(orders, readings, "order_purchase_timestamp", "obs_hour", ["obs_hour", "temperature"], READING_HOLDS)
