"""Independent SQL (DuckDB dialect) for the registered queries.

Each domain view of ``strata.sources.testdata`` and each silver table is
restated here as a CTE over the driver's tables, so the oracle shares no
code with the Spark side. ``sql(body, *views)`` prepends the CTEs a query
needs, in dependency order.
"""

from __future__ import annotations

from ..sources.contracts import EVENT_REQUIRED_KEYS
from ..sources.testdata import (CATEGORY_TRANSLATION, MOVING_SEGMENT, NEW_KEY_OFFSET,
                                UNKNOWN_CATEGORY)

M = "DECIMAL(18,2)"

_translation_rows = ", ".join(f"('{a}', '{b}')" for a, b in CATEGORY_TRANSLATION)

_REQ = ", ".join(f"'{k}'" for k in EVENT_REQUIRED_KEYS)
_FULL = ("CAST(json_object('order_id', order_id, 'customer_id', customer_id, 'order_status', order_status, "
         "'event_timestamp', event_timestamp, 'order_value', order_value) AS VARCHAR)")
_MISSING = ("CAST(json_object('order_id', order_id, 'customer_id', customer_id, 'order_status', order_status, "
            "'event_timestamp', event_timestamp) AS VARCHAR)")

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_orders": ("""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp, o_orderpriority AS order_priority
        FROM orders""", ()),
    "s_orders": ("""
        SELECT *, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS month
        FROM raw_orders
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp DESC NULLS LAST,
                 order_status ASC NULLS LAST, customer_id ASC NULLS LAST) = 1""", ("raw_orders",)),
    "raw_items": (f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS {M}) AS price,
               CAST(ROUND(CAST(l_extendedprice AS {M}) * CAST(l_tax AS {M}), 2) AS {M}) AS freight_value,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount
        FROM lineitem""", ()),
    "s_items": ("""
        SELECT * FROM raw_items
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id ORDER BY
                 shipping_limit_date DESC NULLS LAST, product_id ASC NULLS LAST, seller_id ASC NULLS LAST,
                 price DESC NULLS LAST) = 1""", ("raw_items",)),
    "raw_payments": (f"""
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
               CAST(l_quantity AS INTEGER) AS payment_installments,
               CAST(l_extendedprice AS {M}) AS payment_value, l_shipdate AS paid_at,
               l_partkey AS product_id, l_suppkey AS seller_id
        FROM lineitem""", ()),
    "s_payments": ("""
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value, paid_at
        FROM raw_payments
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, payment_sequential ORDER BY
                 paid_at DESC NULLS LAST, product_id ASC NULLS LAST, seller_id ASC NULLS LAST,
                 payment_value DESC NULLS LAST) = 1""", ("raw_payments",)),
    "s_products": (f"""
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS product_brand,
               p_type AS product_category_name, p_size AS product_size,
               CAST(p_retailprice AS {M}) AS list_price
        FROM part
        QUALIFY ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY p_name ASC NULLS LAST,
                 p_type ASC NULLS LAST) = 1""", ()),
    "s_sellers": ("""
        SELECT s_suppkey AS seller_id, s_name AS seller_name, s_nationkey AS seller_zip_code_prefix,
               n_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
        QUALIFY ROW_NUMBER() OVER (PARTITION BY s_suppkey ORDER BY s_name ASC NULLS LAST,
                 n_name ASC NULLS LAST) = 1""", ()),
    "raw_customers": ("""
        SELECT c_custkey AS customer_id, CAST(floor(c_custkey / 3) AS BIGINT) AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, r_name AS customer_city, n_name AS customer_state,
               c_mktsegment AS customer_segment
        FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation
                                 LEFT JOIN region ON n_regionkey = r_regionkey) g
          ON c_nationkey = g.n_nationkey""", ()),
    "s_customers": ("""
        SELECT * FROM raw_customers
        QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_unique_id ASC NULLS LAST,
                 customer_state ASC NULLS LAST) = 1""", ("raw_customers",)),
    "customer_updates": (f"""
        SELECT cid AS customer_id, CAST(floor(cid / 3) AS BIGINT) AS customer_unique_id,
               nk AS customer_zip_code_prefix, r_name AS customer_city, n_name AS customer_state,
               c_mktsegment AS customer_segment
        FROM (SELECT c_custkey AS cid, c_mktsegment,
                     CAST(CASE WHEN c_mktsegment = '{MOVING_SEGMENT}' THEN (c_nationkey + 1) % 25
                               ELSE c_nationkey END AS INTEGER) AS nk
              FROM customer WHERE c_acctbal >= 0
              UNION ALL
              SELECT c_custkey + {NEW_KEY_OFFSET} AS cid, c_mktsegment, c_nationkey AS nk
              FROM customer WHERE c_acctbal < 0) b
        LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation
                   LEFT JOIN region ON n_regionkey = r_regionkey) g ON b.nk = g.n_nationkey""", ()),
    "raw_geo": ("""
        SELECT c_nationkey AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
               c_acctbal / 100.0 AS geolocation_lng, r_name AS geolocation_city,
               n_name AS geolocation_state, c_custkey AS source_row_id
        FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation
                                 LEFT JOIN region ON n_regionkey = r_regionkey) g
          ON c_nationkey = g.n_nationkey""", ()),
    "s_geo": ("""
        SELECT * FROM raw_geo
        QUALIFY ROW_NUMBER() OVER (PARTITION BY geolocation_zip_code_prefix
                 ORDER BY source_row_id ASC NULLS LAST) = 1""", ("raw_geo",)),
    "translation": (f"""
        SELECT * FROM (VALUES {_translation_rows}) t(product_category_name, product_category_name_english)""",
                    ()),
    "raw_reviews": ("""
        SELECT l.doc_id AS review_id, l.doc_id AS order_id, CAST(1 + 4 * l.quality AS INTEGER) AS review_score,
               CASE WHEN l.toxic = 0 AND l.quality = 1 THEN d.source END AS review_comment_title,
               CASE WHEN l.toxic = 0 THEN d.text END AS review_comment_message
        FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""", ()),
    "s_reviews": ("""
        SELECT review_id, order_id, review_score,
               COALESCE(review_comment_title, '') AS review_comment_title,
               COALESCE(review_comment_message, 'sin_comentario') AS review_comment_message
        FROM raw_reviews
        QUALIFY ROW_NUMBER() OVER (PARTITION BY review_id, order_id ORDER BY order_id ASC NULLS LAST,
                 review_score DESC NULLS LAST) = 1""", ("raw_reviews",)),
    "raw_events": ("""
        SELECT event_id + (SELECT count(*) FROM events) AS order_id, user_id AS customer_id,
               event_type AS order_status, ts AS event_timestamp, value AS order_value, event_id
        FROM events""", ()),
    # payloads as the topic carries them: 'error' events lack order_value,
    # events under 1.0 are cut to half their text (FIXTURES.md §B)
    "payloads": (f"""
        SELECT event_id, CASE WHEN order_status = 'error' THEN {_MISSING}
                              WHEN order_value < 1.0 THEN substr({_FULL}, 1, length({_FULL}) // 2)
                              ELSE {_FULL} END AS payload
        FROM raw_events""", ("raw_events",)),
    # validation = a JSON object holding every required key
    "valid_events": (f"""
        SELECT e.order_id, e.customer_id, e.order_status, e.event_timestamp, e.order_value
        FROM payloads p JOIN raw_events e ON p.event_id = e.event_id
        WHERE CASE WHEN json_valid(p.payload) THEN json_type(p.payload) = 'OBJECT'
                   AND list_has_all(json_keys(p.payload), [{_REQ}]) ELSE FALSE END""", ("payloads", "raw_events")),
    # the stream lane gold reads (FIXTURES.md §B): valid payloads, speed filter
    "stream_orders": ("""
        SELECT * FROM valid_events WHERE order_value > 0 AND order_status IS NOT NULL""", ("valid_events",)),
    "unified": (f"""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, year, month, order_value, origin
        FROM (SELECT order_id, customer_id, order_status, order_purchase_timestamp, year, month,
                     CAST(NULL AS {M}) AS order_value, 'batch' AS origin FROM s_orders
              UNION ALL
              SELECT order_id, customer_id, order_status, event_timestamp,
                     CAST(year(event_timestamp) AS INTEGER), CAST(month(event_timestamp) AS INTEGER),
                     CAST(order_value AS {M}), 'stream' FROM stream_orders) u
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY
                 CASE WHEN origin = 'batch' THEN 0 ELSE 1 END, order_purchase_timestamp DESC NULLS LAST,
                 customer_id ASC NULLS LAST, order_status ASC NULLS LAST, order_value DESC NULLS LAST) = 1""",
                ("s_orders", "stream_orders")),
    "order_values": (f"""
        SELECT order_id, CAST(SUM(payment_value) AS {M}) AS order_value FROM s_payments GROUP BY order_id""",
                     ("s_payments",)),
    "valued": (f"""
        SELECT u.*, v.order_value AS batch_order_value,
               CAST(COALESCE(v.order_value, u.order_value, CAST(0 AS {M})) AS {M}) AS final_order_value
        FROM unified u LEFT JOIN order_values v ON u.order_id = v.order_id""", ("unified", "order_values")),
    "cur_customers": ("SELECT * FROM s_customers", ("s_customers",)),
}


def _collect(names: tuple[str, ...], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        _collect(VIEWS[n][1], out)
        if n not in out:
            out.append(n)


def sql(body: str, *views: str) -> str:
    order: list[str] = []
    _collect(tuple(views), order)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0].strip()})" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":  # merge the body's own CTEs into ours
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def translated(expr: str = "product_category_name") -> str:
    """SQL expression: English category name with the fallback."""
    return (f"COALESCE((SELECT t.product_category_name_english FROM translation t "
            f"WHERE t.product_category_name = {expr}), '{UNKNOWN_CATEGORY}')")
